import datetime as dt

from pyspark.sql import functions as F

from txnwatch.operators import temporal
from txnwatch.plans import catalog as C
from txnwatch.sources import mapping as M

from conftest import rows, ts

H = "k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flag int"


def test_valid_at_edges_and_deleted(spark):
    hist = spark.createDataFrame([("K", "a", ts("2024-01-02"), ts("2024-01-03 23:59:59"), 0),
                                  ("D", "d", ts("2024-01-01"), ts("2024-01-09"), 1)], H)
    ev = spark.createDataFrame([("e1", "K", ts("2024-01-02")), ("e2", "K", ts("2024-01-03 23:59:59")),
                                ("e3", "K", ts("2024-01-01 23:59:59")), ("e4", "D", ts("2024-01-05"))],
                               "id string, k string, t timestamp_ntz")
    got = rows(temporal.valid_at(ev, hist, "k", "k", "t", hist_cols=["v"]), "id")
    assert got == [("e1",), ("e2",)]
    kept = rows(temporal.valid_at(ev, hist, "k", "k", "t", hist_cols=["v"], honour_deleted=False), "id")
    assert ("e4",) in kept


def test_owner_history_equals_three_hop(spark):
    d = "/root/testdata/sf0.001"
    tx = M.transactions(spark, d)
    cards, accs, clis = C.card_history(spark, d), C.account_history(spark, d), M.client_history(spark, d)
    one = rows(temporal.enrich(tx, temporal.owner_history(cards, accs, clis)), "trans_id", "passport")
    hop = temporal.valid_at(tx, cards, "card_num", "card_num", "trans_date", ["account_num"], "c_")
    hop = temporal.valid_at(hop, accs, "c_account_num", "account_num", "trans_date", ["client"], "a_")
    hop = temporal.valid_at(hop, clis, "a_client", "client_id", "trans_date", ["passport_num"], "k_")
    assert one == rows(hop, "trans_id", "k_passport_num") and len(one) > 0


def test_sweep_strategy_equals_join(spark):
    d = "/root/testdata/sf0.001"
    tx = M.transactions(spark, d)
    for hist, ekey, hkey, cols in [(C.card_history(spark, d), "card_num", "card_num", ["account_num"]),
                                   (C.terminal_history(spark, d), "terminal", "terminal_id", ["terminal_city"])]:
        for how in ("inner", "left"):
            for bucket in (3600, 86400):
                a = temporal.valid_at(tx, hist, ekey, hkey, "trans_date", cols, "h_", how=how)
                b = temporal.valid_at(tx, hist, ekey, hkey, "trans_date", cols, "h_", how=how,
                                      strategy="sweep", bucket_seconds=bucket)
                assert rows(a) == rows(b) and len(rows(a)) > 0


def test_sweep_edges(spark):
    hist = spark.createDataFrame([("K", "a", ts("2024-01-02"), ts("2024-01-03 23:59:59"), 0),
                                  ("K", "b", ts("2024-01-05"), ts("2990-12-31"), 0)], H)
    ev = spark.createDataFrame([("e1", "K", ts("2024-01-02")), ("e2", "K", ts("2024-01-03 23:59:59")),
                                ("e3", "K", ts("2024-01-01 23:59:59")), ("e4", "K", ts("2024-01-04 12:00:00")),
                                ("e5", "K", ts("2024-01-09")), ("e6", "Z", ts("2024-01-09"))],
                               "id string, k string, t timestamp_ntz")
    got = rows(temporal.valid_at(ev, hist, "k", "k", "t", ["v"], strategy="sweep", bucket_seconds=3600), "id", "v")
    assert got == [("e1", "a"), ("e2", "a"), ("e5", "b")]


def test_slots_equal_the_other_strategies_and_split_a_hot_key(spark):
    import random
    rng = random.Random(8)
    at = lambda h: ts("2021-01-01") + dt.timedelta(hours=h)
    hist, h0 = [], 0
    for k in ["hot", "b", "c", None]:
        h0 = 0
        while h0 < 2000:
            h1 = h0 + rng.choice([1, 5, 40, 700])
            hist.append((k, f"{k}{h0}", at(h0), ts("2990-12-31") if h1 >= 2000 else at(h1) - dt.timedelta(seconds=1), rng.choice([0, 0, 0, 1])))
            h0 = h1 + rng.choice([0, 0, 7])
    hist.append(("hot", "backwards", at(50), at(40), 0))
    ev = [("hot" if rng.random() < .7 else rng.choice(["b", "c", "z", None]), at(rng.randrange(-5, 2400)) if rng.random() < .97 else None, i) for i in range(1500)]
    e = spark.createDataFrame(ev, "k string, t timestamp_ntz, n int")
    h = spark.createDataFrame(hist, "k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flag int")
    for how in ("inner", "left"):
        got = [rows(temporal.valid_at(e, h, "k", "k", "t", ["v"], how=how, strategy=s, **more))
               for s, more in (("join", {}), ("slots", dict(hot_rows=100, slots=16)), ("slots", dict(hot_rows=0, slots=5)), ("slots", {}))]
        assert got[0] == got[1] == got[2] == got[3]
    # the join's key splits the hot key's rows evenly, with nothing left to the planner
    joined = temporal.valid_at_slots(e, h, "k", "k", "t", ["v"], hot_rows=100, slots=16)
    assert "_slot" not in joined.columns
    share = e.where("k = 'hot' AND t IS NOT NULL").selectExpr(f"pmod(CAST(floor({temporal.X.epoch_seconds_sql('t')} / 86400) AS BIGINT), 16) AS s").groupBy("s").count()
    counts = sorted(r["count"] for r in share.collect())
    assert len(counts) == 16 and counts[-1] < 3 * counts[8]
