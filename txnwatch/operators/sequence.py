"""Previous/next row per key in time order, without one task per hot key.

A plain ``Window.partitionBy(key)`` puts all rows of a key into one task; a
key holding a third of the data would stall the job. Both operators here
partition the window by ``(key, time bucket)`` instead:

* ``neighbours``: exact ``lag(1)`` / ``lead(1)`` for any gap. Rows at a bucket
  edge take their neighbour from a small per-(key, bucket) edge table (first
  and last row of each bucket), linked by a window over buckets only.
* ``lag_chain``: ``lag(1..n)`` that is exact whenever the rule using it
  requires ``ts - lag_n(ts) <= max_span``. Rows in the last ``max_span`` of a
  bucket are copied into the next bucket as context, so the whole look-back
  of every row is inside its window partition; context rows are dropped
  after the window. Only ``max_span / bucket`` of the rows are copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.functions import scalars as X

DEFAULT_BUCKET_SECONDS = 86400


def _bucket(ts: str, bucket_seconds: int) -> Column:
    return F.floor(X.epoch_seconds(ts) / F.lit(bucket_seconds)).cast("bigint")


def neighbours(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str] | None = None,
               prev_cols: list[str] | None = None, next_cols: list[str] | None = None,
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS, keep_bucket: bool = False) -> DataFrame:
    """Add ``prev_<c>`` (c in ``ts`` + prev_cols) and ``next_<c>`` (c in ``ts`` + next_cols).

    Order is ``ts`` then ``tiebreak``; the neighbour of the first/last row of a
    key is NULL. Result equals ``lag``/``lead`` over ``partitionBy(keys)``.
    With ``keep_bucket`` the bucket column stays, so a second call on the
    result reuses its partitioning instead of shuffling again.
    """
    tiebreak = list(tiebreak or [])
    prev_cols = [ts] + [c for c in (prev_cols or []) if c != ts]
    next_cols = [ts] + [c for c in (next_cols or []) if c != ts]
    order = [ts] + tiebreak
    b = "_nb_bucket"
    d = df if b in df.columns else df.withColumn(b, _bucket(ts, bucket_seconds))
    base_cols = [c for c in df.columns if c != b] + ([b] if keep_bucket else [])
    w = Window.partitionBy(*keys, b).orderBy(*order)
    pstruct = F.struct(*[F.col(c).alias(c) for c in prev_cols])
    nstruct = F.struct(*[F.col(c).alias(c) for c in next_cols])
    d = (d.withColumn("_nb_prev", F.lag(pstruct, 1).over(w))
          .withColumn("_nb_next", F.lead(nstruct, 1).over(w)))
    # Edge table: first and last row of every (key, bucket); linked across buckets.
    okey = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    edges = d.groupBy(*keys, b).agg(
        F.max(F.struct(*okey, pstruct.alias("v"))).alias("_last"),
        F.min(F.struct(*okey, nstruct.alias("v"))).alias("_first"))
    we = Window.partitionBy(*keys).orderBy(b)
    edges = edges.select(*keys, b,
                         F.lag(F.col("_last.v"), 1).over(we).alias("_nb_prev_edge"),
                         F.lead(F.col("_first.v"), 1).over(we).alias("_nb_next_edge"))
    d = d.join(edges, on=[*keys, b], how="left")
    prev = F.coalesce(F.col("_nb_prev"), F.col("_nb_prev_edge"))
    nxt = F.coalesce(F.col("_nb_next"), F.col("_nb_next_edge"))
    out = d.select(
        *[F.col(c) for c in base_cols],
        *[prev.getField(c).alias(f"prev_{c}") for c in prev_cols],
        *[nxt.getField(c).alias(f"next_{c}") for c in next_cols])
    return out


def lag_chain(df: DataFrame, key: str | list[str], ts: str, tiebreak: list[str], cols: list[str], n: int,
              max_span_seconds: int, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Add ``lag<k>_<c>`` for k = 1..n and c in ``ts`` + cols, per ``key`` by ``ts, tiebreak``.

    A lag value is the true one whenever ``ts - lag<k>_<ts> <= max_span``;
    farther rows may come back NULL, which a span-bounded rule treats the same.
    """
    keys = [key] if isinstance(key, str) else list(key)
    bucket_seconds = max(bucket_seconds, max_span_seconds)
    t = X.q(ts)
    sec = X.epoch_seconds_sql(t)
    own = f"CAST(floor({sec} / {int(bucket_seconds)}) AS BIGINT)"
    # Copy the tail of each bucket into the next one, marked as context.
    copies = (f"CASE WHEN {sec} >= ({own} + 1) * {int(bucket_seconds)} - {int(max_span_seconds)} "
              f"THEN array({own}, {own} + 1) ELSE array({own}) END")
    d = df.selectExpr("*", f"{own} AS _lc_own").selectExpr("*", f"explode({copies}) AS _lc_bucket")
    d = d.repartition(*keys, "_lc_bucket")
    w = (f"PARTITION BY {', '.join(X.q(k) for k in keys)}, _lc_bucket "
         f"ORDER BY {', '.join(X.q(c) for c in [ts, *tiebreak])}")
    lagged = [f"lag({X.q(c)}, {k}) OVER ({w}) AS {X.q(f'lag{k}_{c}')}"
              for k in range(1, n + 1) for c in [ts] + [c for c in cols if c != ts]]
    d = d.selectExpr("*", *lagged)
    return d.where("_lc_bucket = _lc_own").drop("_lc_bucket", "_lc_own")
