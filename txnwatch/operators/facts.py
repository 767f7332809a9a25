"""Staging and append of fact rows (transactions, passport blacklist).

Facts are append only with a unique key. ``on_duplicate="fail"`` keeps the
reference's behaviour (a duplicate key fails the whole load);
``"skip"`` drops in-batch duplicates and keys already stored, which an
at-least-once stream (``foreachBatch``) needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.functions import scalars as X

TRANSACTION_RENAMES = {"transaction_id": "trans_id", "transaction_date": "trans_date", "amount": "amt"}
BLACKLIST_RENAMES = {"passport": "passport_num", "date": "entry_dt"}
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
DATE_TEXT = "yyyy-MM-dd"


class DuplicateKeyError(ValueError):
    pass


def stage_transactions(raw: DataFrame, file_name: str | Column = "file_name",
                       strict_amount: bool = True) -> DataFrame:
    """Raw text rows of a transactions file → typed staged rows.

    Renames to warehouse names, reads the decimal comma, stores the time at
    one-second precision and adds the file's business date as ``update_dt``.
    """
    r = raw.withColumnsRenamed(TRANSACTION_RENAMES)
    return r.select(
        "trans_id",
        X.round_second(F.to_timestamp_ntz(F.trim("trans_date"), F.lit(TIMESTAMP_TEXT))).alias("trans_date"),
        "card_num", "oper_type",
        X.parse_amount("amt", strict_amount).alias("amt"),
        "oper_result", "terminal",
        X.date_as_ts(X.file_date(file_name)).alias("update_dt"))


def stage_blacklist(raw: DataFrame, file_name: str | Column = "file_name") -> DataFrame:
    """Raw blacklist sheet rows (date, passport) → passport_num, entry_dt, update_dt."""
    r = raw.withColumnsRenamed(BLACKLIST_RENAMES)
    entry = F.coalesce(F.to_date(F.trim("entry_dt"), DATE_TEXT),
                       F.to_date(F.to_timestamp_ntz(F.trim("entry_dt"), F.lit(TIMESTAMP_TEXT))))
    return r.select("passport_num", entry.alias("entry_dt"),
                    X.date_as_ts(X.file_date(file_name)).alias("update_dt"))


def daily_slice(staged: DataFrame, day_col: str = "entry_dt", file_day: str | Column = "update_dt") -> DataFrame:
    """Keep only rows dated the file's day (a cumulative extract becomes a daily delta)."""
    fd = F.col(file_day) if isinstance(file_day, str) else file_day
    return staged.where(F.col(day_col) == F.to_date(fd))


def duplicate_keys(staged: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Keys that would violate uniqueness: repeated in the batch or already stored. NULL keys never do. The stored keys
    are the large side: they are filtered by the batch's, which Spark broadcasts if its measured size allows."""
    batch = staged.where(F.col(key).isNotNull()).groupBy(key).count()
    rep = batch.where(F.col("count") > 1).select(key)
    if existing is None:
        return rep
    stored = existing.select(key).join(batch.select(key), on=key, how="left_semi").distinct()
    return rep.unionByName(stored).distinct()


def append_facts(staged: DataFrame, existing: DataFrame | None, key: str, columns: list[str],
                 on_duplicate: str = "fail", order: list[str] | None = None) -> DataFrame:
    """Rows to append to a fact table with unique ``key``.

    ``fail``: raise ``DuplicateKeyError`` if any key repeats or exists (one
    small action: a count of offending keys). ``skip``: keep the first row per
    key in the batch (by ``order``, else the smallest row) and drop stored keys.
    Rows without a key conflict with nothing, as in a UNIQUE constraint: both ways keep all of them.
    """
    rows = staged.select(*columns)
    if on_duplicate == "fail":
        bad = duplicate_keys(rows, existing, key).limit(1).count()
        if bad:
            raise DuplicateKeyError(f"duplicate {key} in load")
        return rows
    if on_duplicate != "skip":
        raise ValueError(on_duplicate)
    rest = [c for c in columns if c != key]
    order = list(order or [])
    keyless = rows.where(F.col(key).isNull())
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*[F.col(c).alias(f"_o_{c}") for c in order],
                                                 *[F.col(c).alias(c) for c in rest])).alias("_v"))
    first = first.select(key, *[F.col(f"_v.{c}").alias(c) for c in rest]).select(*columns)
    if existing is None:
        return first.unionByName(keyless)
    stored = existing.select(key).join(first.select(key), on=key, how="left_semi")
    return first.join(stored, on=key, how="left_anti").select(*columns).unionByName(keyless)


def file_dates(df: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Distinct file names with their business date."""
    return df.select(file_name).distinct().select(file_name, X.file_date(file_name).alias("file_date"))

