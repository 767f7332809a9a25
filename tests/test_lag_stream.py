"""Rules 3 and 4 on a stream: equal to the batch form for rows in any order, over restarts; state and late rows."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from txnwatch.operators import rules
from txnwatch.operators.sequence import lag_chain
from txnwatch.streaming import lags

SCHEMA = ("trans_id string, trans_date timestamp_ntz, card_num string, terminal_city string, amt decimal(18,2), "
          "oper_result string, oper_type string, passport string, fio string, phone string")
T0 = dt.datetime(2024, 1, 1, 20)
COLS = ["terminal_city", "amt", "oper_result", "oper_type"]


def operations(seed, n=400):
    rng, out = random.Random(seed), []
    at = T0
    for i in range(n):
        # equal times, fractions of a second, gaps of hours; past two midnights
        at += rng.choice([dt.timedelta(0), dt.timedelta(microseconds=250001), dt.timedelta(seconds=90), dt.timedelta(minutes=9), dt.timedelta(hours=1)])
        out.append((f"X{i * 7919 % 1000:04d}", at, rng.choice(["hot", "hot", "A", "B", None]), rng.choice(["Oslo", "Riga", None]),
                    rng.choice([None, *(Decimal(k) / 4 for k in range(8, 0, -1))]), rng.choice(["REJECT", "REJECT", "SUCCESS"]),
                    rng.choice(["WITHDRAW", "WITHDRAW", "WITHDRAW", "PAYMENT"]), "P'1\\\"", None, "+7 "))
    return out


def drive(spark, tmp_path, batches, make):
    """Each batch is one start of the query on the same checkpoint."""
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        with lags.rocksdb(spark):
            query = make(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")).writeStream.format("parquet").option(
                "path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
        last = query
    return spark.read.parquet(f"{tmp_path}/out"), last


def end(days):
    return ("end", T0 + dt.timedelta(days=days), "end", None, None, None, None, None, None, None)


def test_lag_stream_equals_lag_chain(spark, tmp_path):
    bucket = 3 * 3600
    ops = operations(5)
    rng = random.Random(6)
    # rows up to two hours out of order, in files of 200
    mixed = sorted(ops, key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(7200)))
    batches = [mixed[i:i + 200] for i in range(0, len(mixed), 200)] + [[end(60)]]
    got, _ = drive(spark, tmp_path, batches, lambda s: lags.lag_stream(s, "card_num", "trans_date", "trans_id", COLS, 3, 3600, "3 hours", bucket))
    want = lag_chain(spark.createDataFrame(ops, SCHEMA), "card_num", "trans_date", ["trans_id"], COLS, 3, 3600, bucket)
    assert got.columns == want.columns and got.dtypes == want.dtypes

    def near(d):  # lags count within the span only
        for k in range(1, 4):
            far = F.expr(f"coalesce(trans_date - lag{k}_trans_date > INTERVAL '1' HOUR, true)")
            for c in ["trans_date", *COLS]:
                d = d.withColumn(f"lag{k}_{c}", F.when(~far, F.col(f"lag{k}_{c}")))
        return rows(d.where("card_num IS NULL OR card_num <> 'end'"))

    assert near(got) == near(want) and got.count() == len(ops)
    hits = rules.card_hits(got, n=2, span=dt.timedelta(hours=1))
    expected = rules.card_hits(want, n=2, span=dt.timedelta(hours=1))
    assert rows(hits) == rows(expected)
    assert {r.event_type for r in hits.collect()} == {3, 4}


def test_rows_wait_for_the_watermark_and_state_ends(spark, tmp_path):
    row = lambda i, minutes, card="A": (f"X{i}", T0 + dt.timedelta(minutes=minutes), card, "Oslo", Decimal(1), "REJECT", "WITHDRAW", "P", "F", "1")
    make = lambda s: lags.lag_stream(s, "card_num", "trans_date", "trans_id", ["amt"], 1, 600, "30 minutes")
    got, _ = drive(spark, tmp_path, [[row(1, 0), row(2, 40)]], make)
    assert rows(got, "trans_id") == [("X1",)]  # the watermark is at minute 10
    # minute 20 is in time, minute 5 is too late and goes
    got, q = drive(spark, tmp_path, [[row(3, 20), row(4, 5), row(5, 100)]], make)
    assert rows(got, "trans_id") == [("X1",), ("X2",), ("X3",)]
    got, q = drive(spark, tmp_path, [[row(6, 5000, "B")], [row(7, 9000, "B")], [row(8, 9001, "B")]], make)
    assert rows(got, "trans_id") == [(f"X{i}",) for i in (1, 2, 3, 5, 6)]
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert state[-1] <= 8  # the rows of card B and their timers; card A has none left


def test_states_and_timers_do_not_grow_with_the_keys(spark, tmp_path):
    ops = [(f"X{i}", T0 + dt.timedelta(seconds=i % 600), f"C{i % 1500}", "Oslo", Decimal(1), "REJECT", "WITHDRAW", "P", "F", "1") for i in range(3000)]
    make = lambda d: lags.lag_stream(d, "card_num", "trans_date", "trans_id", ["amt"], 1, 600, "30 minutes")
    _, q = drive(spark, tmp_path, [ops], make)
    timers = max(s["customMetrics"]["numRegisteredTimers"] for p in q.recentProgress for s in p["stateOperators"])
    assert 0 < timers <= 256  # with a state for each card 1,500
    got, _ = drive(spark, tmp_path, [[end(9)]], make)
    want = lag_chain(spark.createDataFrame(ops, SCHEMA), "card_num", "trans_date", ["trans_id"], ["amt"], 1, 600)
    assert rows(got) == rows(want)
