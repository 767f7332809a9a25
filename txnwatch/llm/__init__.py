"""Operators of a training-data pipeline (chat, language, quality, HTML, dedup, BPE, PII, secrets).

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is present.
"""
