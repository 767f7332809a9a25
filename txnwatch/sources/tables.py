"""Incremental reads of source tables (accounts, cards, clients).

``source_changes`` stages rows whose change time is later than the stored
watermark. The exact test is on ``greatest(coalesce(create, d), coalesce(update, d))``,
which no scan can use; an implied disjunction on the raw columns is added so
Catalyst pushes it into the Parquet / JDBC scan (``PushedFilters``).

Change times are whole seconds, so a row can change in the watermark's own second after that second was read. With ``seen``
(``watermark.tie_set``: the rows read at exactly the watermark) such a late row is taken, and none of the others again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions import scalars as X
from txnwatch.operators.watermark import unseen


def source_changes(source: DataFrame, key: str, attrs: list[str], watermark: dt.datetime | None,
                   create_col: str = "create_dt", update_col: str = "update_dt",
                   default: dt.datetime = X.DEFAULT_CHANGE_TS, rename: dict[str, str] | None = None,
                   out_ts: str = "update_dt", seen: DataFrame | None = None) -> DataFrame:
    """Staged rows: key, attrs and the change time ``out_ts`` for rows changed after ``watermark``; with ``seen`` also those
    changed at it that ``seen`` does not hold."""
    w = X.DEFAULT_WATERMARK if watermark is None else watermark
    if seen is not None:
        w -= dt.timedelta(seconds=1)  # change times are whole seconds: at the watermark or later
    ct = X.change_time(create_col, update_col, default)
    s = source.where(X.change_time_after(create_col, update_col, default, w)) \
              .select(key, *attrs, ct.alias("_ct")).where(F.col("_ct") > X.ntz(w))
    s = s.withColumnRenamed("_ct", out_ts)
    if seen is not None:
        s = unseen(s, seen, key, attrs, out_ts)
    for a, b in (rename or {}).items():
        s = s.withColumnRenamed(a, b)
    return s


def key_slice(source: DataFrame, key: str, out: str | None = None) -> DataFrame:
    """Every key now in the source (for soft deletes)."""
    return source.select(F.col(key).alias(out or key)).where(F.col(out or key).isNotNull()).distinct()
