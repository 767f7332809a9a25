"""Load metadata: the per-source watermark of incremental reads.

One row per (schema_name, table_name) with ``max_update_dt``. A missing row
is seeded; after a load the value moves to the latest staged change time, or
stays when nothing was staged.

Beside it the tie set holds the rows that were read at exactly the watermark's second (the key as text, a digest of key and
attributes, the second). It is as large as the rows of that one second, is joined and never collected. A set of another
second than the watermark's takes nothing away, so that a load that died between the two writes reads rows twice and
loses none; merging a row twice changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch import schemas
from txnwatch.functions import scalars as X

SCHEMA_NAME = "public"


def _tie(key: str, attrs: list[str], ts: str) -> list[str]:
    """The tie set's columns of staged rows. The digest tells NULL from every value and one column's NULL from another's."""
    cols = [X.q(c) for c in (key, *attrs)]
    marks = ", ".join([*cols, *[f"isnull({c})" for c in cols]])
    return [f"CAST({X.q(key)} AS STRING) AS tie_key", f"xxhash64({marks}) AS tie_digest", f"{X.q(ts)} AS tie_second"]


def unseen(staged: DataFrame, seen: DataFrame, key: str, attrs: list[str], ts: str = "update_dt") -> DataFrame:
    """The staged rows that the tie set does not hold. NULL keys compare as equal."""
    s = staged.selectExpr("*", *_tie(key, attrs, ts)).alias("s")
    k = seen.select("tie_key", "tie_digest", "tie_second").alias("k")
    same = "s.tie_second = k.tie_second AND s.tie_digest = k.tie_digest AND s.tie_key <=> k.tie_key"
    return s.join(k, F.expr(same), "left_anti").select(*[F.col(X.q(c)) for c in staged.columns])


def tie_set(staged: DataFrame, seen: DataFrame, key: str, attrs: list[str], watermark: dt.datetime,
            ts: str = "update_dt") -> DataFrame:
    """The tie set after a load that moved (or left) the watermark at ``watermark``: the rows of that second staged now or
    seen before. NULL change times are in none."""
    rows = staged.selectExpr(*_tie(key, attrs, ts)).unionByName(seen.select("tie_key", "tie_digest", "tie_second"))
    return rows.where(F.col("tie_second") == X.ntz(watermark)).distinct()


def read_watermark(meta: DataFrame, table_name: str, schema_name: str = SCHEMA_NAME,
                   default: dt.datetime = X.DEFAULT_WATERMARK) -> dt.datetime:
    """The stored watermark as a Python value (one row), so it can become a literal
    that Catalyst pushes into the source scan."""
    row = (meta.where((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
           .agg(F.max("max_update_dt").alias("w")).first())
    return row["w"] if row is not None and row["w"] is not None else default


def advance_watermark(meta: DataFrame, table_name: str, staged: DataFrame, ts: str = "update_dt",
                      schema_name: str = SCHEMA_NAME, seed: dt.datetime = X.SEED_WATERMARK) -> DataFrame:
    """Metadata after a load: seed the row if absent, then
    ``max_update_dt = coalesce(max(staged ts), old value)``. Other rows unchanged."""
    spark = meta.sparkSession
    me = (F.col("schema_name") == schema_name) & (F.col("table_name") == table_name)
    seed_row = spark.createDataFrame([(schema_name, table_name)], "schema_name string, table_name string") \
        .select("schema_name", "table_name", X.ntz(seed).alias("max_update_dt"))
    cur = meta.where(me)
    cur = cur.unionByName(seed_row.join(cur.select("schema_name", "table_name"),
                                        on=["schema_name", "table_name"], how="left_anti"))
    mx = staged.agg(F.max(ts).alias("_mx")).select(
        F.lit(schema_name).alias("schema_name"), F.lit(table_name).alias("table_name"), "_mx")
    new = cur.join(mx, on=["schema_name", "table_name"], how="left").select(
        "schema_name", "table_name", F.coalesce("_mx", "max_update_dt").alias("max_update_dt"))
    return meta.where(~me).unionByName(new)


def empty_meta(spark: SparkSession) -> DataFrame:
    return schemas.empty(spark, schemas.META_LOAD)
