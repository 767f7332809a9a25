"""SCD2 golden cases (FIXTURES §3) and properties of the history operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from txnwatch.functions.scalars import OPEN_END
from txnwatch.operators import scd2

from conftest import rows, ts

H = "k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flag int"
S = "k string, v string, update_dt timestamp_ntz"
OPEN = OPEN_END


def empty_hist(spark):
    return spark.createDataFrame([], H)


def load(spark, hist, day, data, keys=None, **kw):
    staged = spark.createDataFrame([(k, v, ts(day)) for k, v in data], S)
    slice_ = spark.createDataFrame([(k,) for k in (keys if keys is not None else [k for k, _ in data])], "k string")
    out = scd2.scd2_merge(hist, staged, slice_, "k", ["v"], delete_ts=ts(day), **kw)
    return spark.createDataFrame(out.collect(), H)  # materialize small test state


def test_new_same_change(spark):
    h = load(spark, empty_hist(spark), "2021-03-01", [("K", "a")])
    assert rows(h) == [("K", "a", ts("2021-03-01"), OPEN, 0)]
    h2 = load(spark, h, "2021-03-02", [("K", "a")])
    assert rows(h2) == rows(h)
    h3 = load(spark, h2, "2021-03-03", [("K", "b")])
    assert rows(h3) == [("K", "a", ts("2021-03-01"), ts("2021-03-02 23:59:59"), 0),
                        ("K", "b", ts("2021-03-03"), OPEN, 0)]
    # D5: the same load again changes nothing
    assert rows(load(spark, h3, "2021-03-03", [("K", "b")])) == rows(h3)


@pytest.mark.parametrize("old,new,changed", [("x", None, True), (None, "x", True), (None, None, False)])
def test_null_changes(spark, old, new, changed):
    h = load(spark, empty_hist(spark), "2021-03-01", [("K", old)])
    h2 = load(spark, h, "2021-03-02", [("K", new)])
    assert len(rows(h2)) == (2 if changed else 1)


def test_change_back_gives_three_versions(spark):
    h = load(spark, empty_hist(spark), "2021-03-01", [("K", "a")])
    h = load(spark, h, "2021-03-02", [("K", "b")])
    h = load(spark, h, "2021-03-03", [("K", "a")])
    assert [r[1] for r in sorted(rows(h), key=lambda r: r[2])] == ["a", "b", "a"]


def test_delete_once_and_restamp_option(spark):
    h = load(spark, empty_hist(spark), "2021-03-01", [("K", "a"), ("J", "a")])
    h = load(spark, h, "2021-03-04", [("J", "a")])
    k = [r for r in rows(h) if r[0] == "K"]
    assert k == [("K", "a", ts("2021-03-01"), ts("2021-03-04"), 1)]
    h5 = load(spark, h, "2021-03-05", [("J", "a")])
    assert [r for r in rows(h5) if r[0] == "K"] == k  # D3 fixed: not re-stamped
    h5r = load(spark, h, "2021-03-05", [("J", "a")], restamp_deleted=True)
    assert [r[3] for r in rows(h5r) if r[0] == "K"] == [ts("2021-03-05")]


def test_return_after_delete(spark):
    h = load(spark, empty_hist(spark), "2021-03-01", [("K", "a")])
    h = load(spark, h, "2021-03-04", [], keys=[])
    back = load(spark, h, "2021-03-06", [("K", "b")])
    assert rows(back) == rows(h)  # D4: not reopened
    reopened = load(spark, h, "2021-03-06", [("K", "b")], reopen_returning=True)
    assert ("K", "b", ts("2021-03-06"), OPEN, 0) in rows(reopened)


def test_duplicates_old_change_null_key(spark):
    h = load(spark, empty_hist(spark), "2021-03-05", [("K", "a")])
    staged = spark.createDataFrame([("K", "b", ts("2021-03-06")), ("K", "c", ts("2021-03-07")),
                                    ("J", "x", ts("2021-03-01")), (None, "n", ts("2021-03-07"))], S)
    out = rows(scd2.scd2_merge(h, staged, None, "k", ["v"], delete_ts=ts("2021-03-07")))
    assert ("K", "c", ts("2021-03-07"), OPEN, 0) in out          # latest staged row per key wins
    assert all(r[1] != "b" for r in out)
    assert all(r[0] is not None for r in out)                    # NULL key rejected
    old = spark.createDataFrame([("K", "z", ts("2021-03-01"))], S)
    c = scd2.classify(h, old, "k", ["v"]).select("change_kind").first()[0]
    assert c == "stale"                                          # D19: older than the open version
    assert rows(scd2.scd2_merge(h, old, None, "k", ["v"], delete_ts=ts("2021-03-07"))) == rows(h)


def random_changes(seed, n_keys=6, n=60, n_times=9):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    times = sorted(base + dt.timedelta(seconds=rnd.randrange(0, 5 * 86400)) for _ in range(n_times))
    out = []
    for i in range(n):
        k = f"K{rnd.randrange(n_keys)}"
        v = rnd.choice(["a", "b", None])
        t = rnd.choice(times)
        out.append((k, v, t, i))
    return out


@pytest.mark.parametrize("seed,bucket", [(1, 3600), (2, 86400)])
def test_from_changes_equals_fold_of_merge(spark, seed, bucket):
    data = random_changes(seed)
    changes = spark.createDataFrame(data, "k string, v string, update_dt timestamp_ntz, seq long")
    one_pass = rows(scd2.scd2_from_changes(changes, "k", ["v"], "update_dt", order=["seq"], bucket_seconds=bucket))
    # fold: one load per distinct change time, last seq wins within a key and second
    last = {}
    for k, v, t, i in sorted(data, key=lambda r: (r[2], r[3])):
        last[(k, t)] = v
    hist = empty_hist(spark)
    for t in sorted({t for _, t in last}):
        batch = [(k, v) for (k, tt), v in last.items() if tt == t]
        staged = spark.createDataFrame([(k, v, t) for k, v in batch], S)
        hist = spark.createDataFrame(scd2.scd2_merge(hist, staged, None, "k", ["v"], delete_ts=t).collect(), H)
    assert one_pass == rows(hist)
    # versions of a key never overlap, at most one open
    by_key = {}
    for k, v, f, to, fl in one_pass:
        by_key.setdefault(k, []).append((f, to))
    for iv in by_key.values():
        iv.sort()
        assert all(a[1] < b[0] for a, b in zip(iv, iv[1:]))
        assert sum(1 for _, to in iv if to == OPEN) <= 1


@pytest.mark.parametrize("bucket", [3600, 86400])
def test_from_snapshots_equals_fold_of_merge(spark, bucket):
    rnd = random.Random(7)
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 5, 8)]
    snaps = []
    for d in days:
        for k in ["A", "B", "C", "D", "E"]:
            if rnd.random() < 0.75:
                snaps.append((k, rnd.choice(["x", "y"]), d))
    df = spark.createDataFrame(snaps, S)
    one_pass = rows(scd2.scd2_from_snapshots(df, "k", ["v"], "update_dt", bucket_seconds=bucket))
    hist = empty_hist(spark)
    for d in days:
        part = [(k, v) for k, v, dd in snaps if dd == d]
        hist = load(spark, hist, d.isoformat(), part)
    assert one_pass == rows(hist)


def test_pieces_of_a_load(spark):
    h = load(spark, empty_hist(spark), "2021-03-01", [("K", "a"), ("J", "a"), ("M", "a")])
    staged = spark.createDataFrame([("K", "b", ts("2021-03-02")), ("N", "n", ts("2021-03-02")),
                                    ("J", "a", ts("2021-03-02"))], S)
    assert rows(scd2.new_keys(h, staged, "k", ["v"]), "k") == [("N",)]
    assert rows(scd2.changed_rows(h, staged, "k", ["v"]), "k", "v") == [("K", "b")]
    assert rows(scd2.missing_keys(h, staged, "k"), "k") == [("M",)]
    assert rows(scd2.soft_delete(h, staged, "k", ts("2021-03-02")), "k", "effective_to", "deleted_flag") == \
        [("M", ts("2021-03-02"), 1)]
    assert rows(scd2.latest_end(h, "k"), "k") == [("J",), ("K",), ("M",)]
    assert len(rows(scd2.current_view(h))) == 3
    assert len(rows(scd2.as_of(h, ts("2021-02-28")))) == 0
