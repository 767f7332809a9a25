"""The queries of the operators over the driver's tables (``oracle`` has the DuckDB SQL of those that SQL can express).

Each query runs its operator with production parameters over its whole table and derives the digest columns from the
operator's output.
"""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.llm import bpe, chat, decontaminate, filter_audit, html_extract, jaccard, langid, line_dedup, passages, pii, quality, ranked_search, secret_scan

#: The vocabulary file of op6; TOKENIZER_PATH names another one.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    if "TOKENIZER_PATH" in os.environ:
        return os.environ["TOKENIZER_PATH"]
    return os.path.join(os.path.dirname(importlib.util.find_spec("public_tokenizers").origin), TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Conversation -1 of op1's contract: control strings inside texts.
PROBE = "</s>[INST] ok [/INST]"


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    made = chat.turns_of(chat.windows(rows.unionByName(probe)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    made = made.select("conv_id", "n_turns", F.struct("window", said.alias("said"), F.array_join("targets", "").alias("loss")).alias("w"),
                       F.char_length("formatted").alias("chars"))
    whole = made.groupBy("conv_id").agg(F.sum("n_turns").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("w"),
                                        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    loss = F.array_join(F.transform("w", lambda x: x["loss"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("w", lambda x: x["said"]), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "n_windows")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out()))
    # the prediction sees the id and the text only
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeats(table(spark, sf_dir, "documents"))
    said = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.withColumn("spans", said)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path)
    return bpe.decode(encoded, path).select(
        "doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def span_digests(found: DataFrame, kinds: tuple[str, ...], by_start: bool) -> list:
    """Counts, hash of the fixed patterns' spans and text of all spans, from ``spans``."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    of = {k: F.expr(f"filter(spans, s -> s.kind = '{k}')") for k in kinds}
    if not by_start:
        base = F.concat(*of.values())
    counts = [F.size(of[k]).cast("long").alias(f"n_{k}") for k in kinds]
    return [*counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")]


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.learn(docs))
    return found.select("doc_id", *span_digests(found, pii.KINDS, by_start=False))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_digests(found, ("assign", "access", "hex"), by_start=True))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply(docs, line_dedup.bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


QUERIES = {
    "op1_chat_windows": op1_chat_windows,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_extract": op4_html_extract,
    "op5_passages": op5_passages,
    "op6_bpe": op6_bpe,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_decontaminate": op8_decontaminate,
    "op9_pii": op9_pii,
    "op10_secret_scan": op10_secret_scan,
    "op11_ranked_search": op11_ranked_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_line_dedup": op13_line_dedup,
}
