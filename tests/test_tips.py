"""A load on tips alone equals the merge of the whole history."""

import random

import pytest
from pyspark.sql import functions as F

from txnwatch.operators import scd2

from conftest import rows, ts

HIST = "k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flag int"
COLS = ["k", "v", "effective_from", "effective_to", "deleted_flag"]


def load(rng, n):
    staged = [(f"K{rng.randrange(12)}" if rng.random() < .95 else None, rng.choice(["a", "b", None]), ts(f"2021-01-{rng.randrange(1, 28):02d}"))
              for _ in range(rng.randrange(0, 12))]
    keys = [(f"K{i}",) for i in range(12) if rng.random() < .7] + [(None,)]
    return staged, keys


@pytest.mark.parametrize("restamp,reopen", [(False, False), (True, False), (False, True), (True, True)])
def test_steps_equal_merges(spark, restamp, reopen):
    rng = random.Random(7 + 2 * restamp + reopen)
    whole = spark.createDataFrame([], HIST)
    parts = spark.createDataFrame([], HIST + ", state string")
    for n in range(5):
        staged, keys = load(rng, n)
        s, k = spark.createDataFrame(staged, "k string, v string, update_dt timestamp_ntz"), spark.createDataFrame(keys, "k string")
        stamp = ts(f"2021-{n + 3:02d}-01")
        want = rows(scd2.scd2_merge(whole, s, k, "k", ["v"], stamp, restamp_deleted=restamp, reopen_returning=reopen), *COLS)
        step = scd2.scd2_step(parts.where("state = 'tip'").drop("state"), s, k, "k", ["v"], stamp, restamp_deleted=restamp, reopen_returning=reopen)
        parts = spark.createDataFrame(parts.where("state = 'past'").unionByName(step.select(*parts.columns)).collect(), HIST + ", state string")
        assert rows(parts, *COLS) == want
        whole = spark.createDataFrame([tuple(r) for r in want], HIST)
        assert rows(scd2.split_tips(whole, "k", ["v"]), *COLS, "state") == rows(parts, *COLS, "state")


def test_step_without_slice_labels_and_since(spark):
    tips = spark.createDataFrame([("A", "x", ts("2021-01-01"), ts("2990-12-31"), 0), ("B", "x", ts("2021-01-01"), ts("2021-02-01"), 1),
                                  ("C", "x", ts("2021-03-01"), ts("2990-12-31"), 0), ("D", "x", ts("2021-01-05"), ts("2990-12-31"), 0)], HIST)
    staged = spark.createDataFrame([("A", "y", ts("2021-02-01")), ("B", "y", ts("2021-03-01")), ("C", "y", ts("2021-02-01")), ("E", None, ts("2021-02-02"))],
                                   "k string, v string, update_dt timestamp_ntz")
    got = rows(scd2.scd2_step(tips, staged, None, "k", ["v"], ts("2021-04-01")), "k", "act", "state", "since", "effective_to")
    assert got == sorted([("A", "changed", "past", ts("2021-02-01"), ts("2021-01-31 23:59:59")), ("A", "changed", "tip", ts("2021-02-01"), ts("2990-12-31")),
                          ("B", "returning", "tip", None, ts("2021-02-01")), ("C", "stale", "tip", None, ts("2990-12-31")),
                          ("D", "same", "tip", None, ts("2990-12-31")), ("E", "new", "tip", ts("2021-02-02"), ts("2990-12-31"))], key=repr)
    keys = spark.createDataFrame([("A",), ("C",), ("E",)], "k string")
    got = rows(scd2.scd2_step(tips, staged, keys, "k", ["v"], ts("2021-04-01")).where("act = 'deleted'"), "k", "since", "effective_to", "deleted_flag")
    assert got == [("D", ts("2021-01-05"), ts("2021-04-01"), 1)]


def test_digest_tells_key_sets_apart(spark):
    b = F.pmod(F.xxhash64("k"), F.lit(4)).cast("int")
    of = lambda ks: rows(scd2.key_digest(spark.createDataFrame([(k,) for k in ks], "k string"), "k", b))
    base = [f"K{i}" for i in range(200)]
    assert of(base) == of(base[::-1] + base[:5] + [None])
    for other in (base[1:], base + ["X"], base[1:] + ["Y"]):
        assert len(set(of(base)) ^ set(of(other))) in (1, 2, 3, 4) and of(base) != of(other)
