"""From raw documents to tokens: quality rules, near-duplicate removal, decontamination, PII redaction, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each result is written as Parquet into the shared folder
of ``spark.checkpoint.dir`` and read again as the next stage's documents, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.llm import bpe, decontaminate, jaccard, pii, quality
from txnwatch.llm.queries import table, tokenizer_path
from txnwatch.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs keep."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of linked documents the one with the smallest id. Rows without an id all stay. Of rows that share
    an id, copies with the same text stay once and different texts all, if one of them is its component's first."""
    found = jaccard.join(docs.select("doc_id", "text"))
    first = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(first, "doc_id", "left_semi")
    # the two hashes stand for the text, so that only they are compared
    marks = {"_pipeline_a": F.xxhash64("text"), "_pipeline_b": F.xxhash64(F.lit(1), "text")}
    kept = kept.withColumns(marks).dropDuplicates(["doc_id", *marks]).drop(*marks)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; ``n_chars``, where there is one, is that of the new text."""
    done = pii.redact(docs, pii.learn(docs.select("doc_id", "text")))
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, text): the ids and the text that they decode to."""
    decoded = bpe.round_trip(docs, tokenizer_path())
    return decoded.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids",
                          F.col("decoded").alias("text"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", redaction),
    ("BPE encoding and decoding", encoding),
]

#: The fitted cutoffs, the trained network and the tokenizer have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus_pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
