"""Previous operations of a key on a stream, and rules 3 and 4 on them.

``lag_stream`` is ``operators.sequence.lag_chain`` for a stream: the same columns with the same values, whatever the order in
which rows arrive within the delay. The state of a key holds the rows that wait for the watermark and, of those that have gone
out, the ones that a later row can still look back to. When the watermark passes waiting rows, an event-time timer puts them in
order and lets them go, each with the ``n`` before it. A state that nothing can look back to any more is dropped by a timer too.

Like the batch form it works per time bucket with the last ``max_span`` of a bucket copied into the next one, so that a
key with very many rows is dealt out over its buckets when days of files are taken in, and no state outlives its bucket.
Keys are dealt to slots by hash, and a slot's keys share a state and its timers within a bucket: calls to the state store
grow with slots and buckets, not with the keys.

The rules are evaluated on the result by the expressions of ``operators.rules``. A row is in the output once the
watermark (latest time seen less the delay) has reached it; rows that arrive after that are dropped by Spark, which counts them
in the query's progress (``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from txnwatch.functions import scalars as X
from txnwatch.operators import rules, temporal
from txnwatch.operators.sequence import DEFAULT_BUCKET_SECONDS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows are packed as JSON while they wait; times with all their digits.
PACKED = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "true"}
HOUR = "1 hour"
#: States of a bucket; a state holds the rows of the keys dealt to it.
SLOTS = 256


def _micros_sql(t: str) -> str:
    return (f"({X.epoch_seconds_sql(t)} * 1000000L + "
            f"CAST((date_part('SECOND', {t}) - second({t})) * 1000000 AS BIGINT))")


class _Lags(StatefulProcessor):
    """State of a (slot, bucket): rows (key, micros, tie, own, packed, gone), the waiting ones and those still in reach."""

    def __init__(self, n: int, span_micros: int):
        self.n, self.span = n, span_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "k string, t bigint, tie string, own boolean, v string, gone boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        least = None
        for part in rows:
            if len(part):
                part = part.astype({"k": object, "tie": object, "v": object})
                part = part.where(part.notna(), None)
                self.rows.appendList([(k, int(t), tie, bool(own), v, False) for k, t, tie, own, v in zip(
                    part["k"], part["t"], part["tie"], part["own"], part["v"], strict=True)])
                first = int(part["t"].min())
                least = first if least is None else min(least, first)
        if least is not None:
            # a timer fires when the watermark is later than its time
            self.handle.registerTimer(least // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000  # nothing at or before it can arrive any more
        held = sorted((tuple(r) for r in self.rows.get()),
                      key=lambda r: (r[0], r[1], r[2] is not None, r[2] or "", not r[5], r[4]))
        if not any(r[1] <= upto and not r[5] for r in held) and all(r[1] >= upto - self.span for r in held):
            kept, out = held, []  # another timer has been here
        else:
            out, first = [], 0
            for i, r in enumerate(held):
                if r[0] != held[first][0]:
                    first = i
                if r[3] and not r[5] and r[1] <= upto:
                    out.append((r[4], [held[i - k][4] if i - k >= first else None for k in range(1, self.n + 1)]))
            kept = [(*r[:5], True) if r[1] <= upto else r for r in held if r[1] >= upto - self.span]
            if kept:
                self.rows.put(kept)
            else:
                self.rows.clear()
        if kept:
            wake = min(r[1] + self.span if r[5] else r[1] for r in kept)
            self.handle.registerTimer(max(wake, upto) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=["v", "l"])

    def close(self) -> None:
        pass


def lag_stream(df: DataFrame, key: str | list[str], ts: str, tiebreak: str, cols: list[str], n: int, max_span_seconds: int,
               delay: str = HOUR, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Add ``lag<k>_<c>`` for k = 1..n and c in ``ts`` + cols, per ``key`` by ``ts, tiebreak`` (compared as text), to a stream.

    Equal to ``lag_chain``, whose values count within ``max_span`` only, for all rows up to the watermark. Rows without ``ts`` have no place in the order and are left
    out; a NULL key is a key. ``delay`` is how late a row may be.
    """
    keys = [key] if isinstance(key, str) else list(key)
    bucket_seconds = max(bucket_seconds, max_span_seconds)
    t = X.q(ts)
    sec = X.epoch_seconds_sql(t)
    own = f"CAST(floor({sec} / {int(bucket_seconds)}) AS BIGINT)"
    # one second more than the batch form copies, for the fractions of a second
    copies = (f"CASE WHEN {sec} >= ({own} + 1) * {int(bucket_seconds)} - {int(max_span_seconds) + 1} "
              f"THEN array({own}, {own} + 1) ELSE array({own}) END")
    options = ", ".join(f"'{k}', {_text(v)}" for k, v in PACKED.items())
    d = df.where(f"{t} IS NOT NULL").selectExpr(
        f"pmod(xxhash64({', '.join(X.q(k) for k in keys)}), {SLOTS}) AS slot",
        f"to_json(struct({', '.join(f'{X.q(k)} AS k{i}' for i, k in enumerate(keys))}), map({options})) AS k", f"{_micros_sql(t)} AS t", f"CAST({X.q(tiebreak)} AS STRING) AS tie",
        f"to_json(struct({', '.join(X.q(c) for c in df.columns)}), map({options})) AS v", f"{own} AS of", f"{copies} AS b")
    d = d.withColumn("et", F.expr("timestamp_micros(t)")).withWatermark("et", delay)
    d = d.selectExpr("*", "explode(b) AS bucket").selectExpr("slot", "bucket", "et", "k", "t", "tie", "v", "bucket = of AS own")
    lagged = d.groupBy("slot", "bucket").transformWithStateInPandas(
        _Lags(n, int(max_span_seconds) * 1000000), "v string, l array<string>", "append", "eventtime")
    back = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]).simpleString()
    read = lambda x: f"from_json({x}, '{back}', map({options}))"
    named = [ts] + [c for c in cols if c != ts]
    d = lagged.selectExpr(f"{read('v')} AS r", f"transform(l, x -> {read('x')}) AS p")
    return d.selectExpr("r.*", *[f"get(p, {k - 1}).{X.q(c)} AS {X.q(f'lag{k}_{c}')}" for k in range(1, n + 1) for c in named])


def _text(v: str) -> str:
    return "'" + v.replace("'", "\\'") + "'"


def card_rule_stream(transactions: DataFrame, owners: DataFrame, terminals: DataFrame, gap: dt.timedelta = rules.CITY_GAP,
                     n: int = rules.PROBE_REJECTS, span: dt.timedelta = rules.PROBE_SPAN, delay: str = HOUR,
                     honour_deleted: bool = True, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Hits of rules 3 and 4 (``event_dt, passport, fio, phone, event_type``) on a stream of staged transactions, as
    ``rules.card_rules`` gives them for stored ones. The histories are read as they are when a batch runs."""
    e = temporal.enrich_terminals(temporal.enrich(transactions, owners), terminals, honour_deleted)
    e = e.select("trans_id", "trans_date", "card_num", "terminal_city", "amt", "oper_result", "oper_type", "passport", "fio", "phone")
    lagged = lag_stream(e, "card_num", "trans_date", "trans_id", ["terminal_city", "amt", "oper_result", "oper_type"], max(n, 1),
                        int(max(gap, span).total_seconds()), delay, bucket_seconds)
    return rules.card_hits(lagged, gap, n, span)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which keyed state needs; the session's own setting comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def start_card_rules(hits: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the hits of ``card_rule_stream`` to Parquet files, each once, restarts included."""
    w = hits.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    with rocksdb(hits.sparkSession):
        return w.start()
