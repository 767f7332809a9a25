"""Rule golden cases (FIXTURES §3) and the bucketed look-back."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txnwatch.operators import report, rules
from txnwatch.operators.sequence import lag_chain, neighbours

from conftest import rows, ts

E = ("trans_id string, trans_date timestamp_ntz, card_num string, oper_type string, amt decimal(38,10), "
     "oper_result string, terminal string, passport string, passport_valid_to date, valid_to date, "
     "fio string, phone string")
BL = "passport_num string, entry_dt date"
TH = ("terminal_id string, terminal_type string, terminal_city string, terminal_address string, "
      "effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flag int")


def op(i, t, card="C1", typ="WITHDRAW", amt=10, res="SUCCESS", term="T1", passport="P1",
       pvt=None, vt=None):
    return (f"X{i}", ts(t), card, typ, Decimal(amt), res, term, passport, pvt, vt, "F I O", "+7")


def test_rule_passport(spark):
    d = dt.date
    data = [op(1, "2024-01-05 00:00:00", passport="P1", pvt=d(2024, 1, 5)),
            op(2, "2024-01-05 00:00:01", passport="P1", pvt=d(2024, 1, 5)),
            op(3, "2024-01-05 12:00:00", passport="P2"),
            op(4, "2024-01-05 12:00:00", passport="P3"),
            op(5, "2024-01-05 12:00:00", passport="P4")]
    e = spark.createDataFrame(data, E)
    bl = spark.createDataFrame([("P3", d(2024, 1, 5)), ("P4", d(2024, 1, 6))], BL)
    got = rows(rules.rule_passport(e, bl), "event_dt", "passport")
    assert got == [(ts("2024-01-05 00:00:01"), "P1"), (ts("2024-01-05 12:00:00"), "P3")]


def test_rule_agreement(spark):
    d = dt.date
    data = [op(1, "2024-01-05 12:00:00", passport="A", vt=d(2024, 1, 4)),
            op(2, "2024-01-05 12:00:00", passport="B", vt=d(2024, 1, 5)),
            op(3, "2024-01-05 12:00:00", passport="C", vt=None)]
    got = rows(rules.rule_agreement(spark.createDataFrame(data, E)), "passport")
    assert got == [("A",), ("B",)]


def with_city(spark, data, cities):
    e = spark.createDataFrame(data, E)
    c = spark.createDataFrame(list(cities.items()), "terminal string, terminal_city string")
    return e.join(c, "terminal", "left")


def test_rule_city_jump(spark):
    cities = {"T1": "A", "T2": "B", "T3": None}
    data = [op(1, "2024-01-05 10:00:00", card="C1", term="T1"),
            op(2, "2024-01-05 11:00:00", card="C1", term="T2"),          # 60 min, other city: yes
            op(3, "2024-01-05 10:00:00", card="C2", term="T1"),
            op(4, "2024-01-05 11:00:01", card="C2", term="T2"),          # 60 min + 1 s: no
            op(5, "2024-01-05 10:00:00", card="C3", term="T1"),
            op(6, "2024-01-05 10:30:00", card="C3", term="T1"),          # same city: no
            op(7, "2024-01-05 10:40:00", card="C3", term="T3"),          # NULL city: no
            op(8, "2024-01-05 10:00:00", card="C4", term="T2", res="REJECT"),
            op(9, "2024-01-05 10:10:00", card="C4", term="T1")]          # previous rejected still counts
    got = rows(rules.rule_city_jump(with_city(spark, data, cities)), "event_dt", "event_type")
    assert got == [(ts("2024-01-05 10:10:00"), 3), (ts("2024-01-05 11:00:00"), 3)]


def probe(card, start, step_s, amts, results, types=None):
    t0 = ts(start)
    types = types or ["WITHDRAW"] * len(amts)
    return [op(f"{card}{i}", (t0 + dt.timedelta(seconds=i * step_s)).isoformat(sep=" "), card=card,
               typ=types[i], amt=a, res=results[i]) for i, a in enumerate(amts)]


R3S = ["REJECT", "REJECT", "REJECT", "SUCCESS"]


@pytest.mark.parametrize("rows_,hit", [
    (probe("P", "2024-01-05 10:00:00", 400, [100, 90, 80, 70], R3S), True),        # 20 min exactly
    (probe("P", "2024-01-05 10:00:00", 401, [100, 90, 80, 70], R3S), False),       # 20 min + 3 s
    (probe("P", "2024-01-05 10:00:00", 60, [100, 90, 90, 70], R3S), False),        # equal amounts
    (probe("P", "2024-01-05 10:00:00", 60, [90, 80, 70], R3S[1:]), False),         # 2 rejects only
    (probe("P", "2024-01-05 10:00:00", 60, [100, 90, 80, 70], R3S,
           ["WITHDRAW", "PAYMENT", "WITHDRAW", "WITHDRAW"]), False),                # one PAYMENT
    (probe("P", "2024-01-05 10:00:00", 60, [100, 90, 80, 70], ["REJECT"] * 4), False),
])
def test_rule_amount_probe(spark, rows_, hit):
    e = with_city(spark, rows_, {"T1": "A"})
    got = rows(rules.rule_amount_probe(e), "event_type")
    assert got == ([(4,)] if hit else [])


def test_span_edge_exact_seconds(spark):
    rows_ = probe("Q", "2024-01-05 23:50:00", 400, [100, 90, 80, 70], R3S)   # crosses midnight
    assert rows(rules.rule_amount_probe(with_city(spark, rows_, {"T1": "A"})), "event_type") == [(4,)]


def test_rule_hits_equals_separate_rules(spark):
    data = (probe("P", "2024-01-05 10:00:00", 60, [100, 90, 80, 70], R3S)
            + [op(1, "2024-01-05 10:00:00", card="C1", term="T1", vt=dt.date(2024, 1, 1)),
               op(2, "2024-01-05 10:30:00", card="C1", term="T2"),
               op(3, "2024-01-05 10:40:00", card="C1", term="T9", passport="BL")])
    e = spark.createDataFrame(data, E)
    bl = spark.createDataFrame([("BL", dt.date(2024, 1, 1))], BL)
    th = spark.createDataFrame([("T1", "ATM", "A", "x", ts("2024-01-01"), ts("2990-12-31"), 0),
                                ("T2", "ATM", "B", "x", ts("2024-01-01"), ts("2990-12-31"), 0)], TH)
    from txnwatch.operators import temporal
    et = temporal.enrich_terminals(e, th)
    separate = [rules.rule_passport(e, bl), rules.rule_agreement(e), rules.rule_city_jump(et),
                rules.rule_amount_probe(et)]
    from functools import reduce
    want = rows(reduce(lambda a, b: a.unionByName(b), separate))
    got = rows(rules.rule_hits(e, bl, th))
    assert got == want and {r[4] for r in got} == {1, 2, 3, 4}
    both = rows(rules.card_rules(et))
    assert both == rows(separate[2].unionByName(separate[3]))


def test_lag_chain_and_neighbours_match_plain_window(spark):
    rnd = random.Random(3)
    base = ts("2024-01-01")
    data = [(f"K{rnd.randrange(3)}", base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400)), i, rnd.randrange(100))
            for i in range(300)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id long, x long")
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.select("id", *[F.lag(c, n).over(w).alias(f"lag{n}_{c}") for n in (1, 2, 3) for c in ("t", "x")],
                      F.lead("t").over(w).alias("next_t"))
    span = 3 * 3600
    got = {r["id"]: r for r in lag_chain(df, "k", "t", ["id"], ["x"], 3, span, bucket_seconds=4 * 3600).collect()}
    for r in plain.collect():
        g = got[r["id"]]
        for n in (1, 2, 3):
            lt = r[f"lag{n}_t"]
            t = next(x[1] for x in data if x[2] == r["id"])
            if lt is not None and (t - lt).total_seconds() <= span:
                assert g[f"lag{n}_t"] == lt and g[f"lag{n}_x"] == r[f"lag{n}_x"]
    nb = {r["id"]: r for r in neighbours(df, ["k"], "t", ["id"], prev_cols=["x"], bucket_seconds=3600).collect()}
    for r in plain.collect():
        assert nb[r["id"]]["prev_t"] == r["lag1_t"] and nb[r["id"]]["prev_x"] == r["lag1_x"]
        assert nb[r["id"]]["next_t"] == r["next_t"]


def test_report_priority_rerun_and_null_passport(spark):
    data = [op(1, "2024-01-05 12:00:00", passport="P1", pvt=dt.date(2024, 1, 1), vt=dt.date(2024, 1, 1)),
            op(2, "2024-01-05 12:00:00", passport=None, vt=dt.date(2024, 1, 1), card="C7"),
            op(3, "2024-01-05 12:00:00", passport=None, vt=dt.date(2024, 1, 1), card="C8")]
    e = spark.createDataFrame(data, E)
    bl = spark.createDataFrame([], BL)
    rr = [rules.rule_passport(e, bl), rules.rule_agreement(e)]
    first = report.fraud_report(rr, dt.date(2024, 2, 1))
    got = rows(first, "passport", "event_type")
    assert got == sorted([(None, "2"), (None, "2"), ("P1", "1")], key=repr)  # P1 once, type 1; NULLs kept
    first = spark.createDataFrame(first.collect(), first.schema)
    second = report.append_report(first, report.fraud_report(rr, dt.date(2024, 2, 2)))
    assert rows(second) == rows(first)                        # rerun: nothing new, first report_dt stays
