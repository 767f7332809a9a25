import datetime as dt
from decimal import Decimal

import pytest

from txnwatch.operators import facts, watermark
from txnwatch.operators.facts import DuplicateKeyError

from conftest import rows, ts

T = "trans_id string, trans_date timestamp_ntz, amt decimal(38,10)"


def test_duplicates_fail_and_skip(spark):
    existing = spark.createDataFrame([("X1", ts("2024-01-01"), Decimal(1))], T)
    staged = spark.createDataFrame([("X1", ts("2024-01-01"), Decimal(1)), ("X2", ts("2024-01-02"), Decimal(2)),
                                    ("X2", ts("2024-01-02"), Decimal(2))], T)
    with pytest.raises(DuplicateKeyError):
        facts.append_facts(staged, existing, "trans_id", ["trans_id", "trans_date", "amt"], "fail")
    got = facts.append_facts(staged, existing, "trans_id", ["trans_id", "trans_date", "amt"], "skip")
    assert rows(got, "trans_id") == [("X2",)]


def test_blacklist_daily_slice(spark):
    raw = spark.createDataFrame([("2024-03-01", "P1", "passport_blacklist_03032024.csv"),
                                 ("2024-03-03", "P2", "passport_blacklist_03032024.csv"),
                                 (None, "P3", "passport_blacklist_03032024.csv")],
                                "date string, passport string, file_name string")
    got = facts.daily_slice(facts.stage_blacklist(raw))
    assert rows(got, "passport_num", "entry_dt") == [("P2", dt.date(2024, 3, 3))]


def test_watermark(spark):
    w = ts("2024-01-01 00:00:00")
    meta = spark.createDataFrame([("public", "src", w)], "schema_name string, table_name string, max_update_dt timestamp_ntz")
    from txnwatch.sources.tables import source_changes
    src = spark.createDataFrame([("K1", "a", w, None), ("K2", "b", w + dt.timedelta(seconds=1), None)],
                                "k string, v string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    staged = source_changes(src, "k", ["v"], watermark.read_watermark(meta, "src"))
    assert rows(staged, "k") == [("K2",)]
    new = watermark.advance_watermark(meta, "src", staged)
    assert rows(new, "max_update_dt") == [(w + dt.timedelta(seconds=1),)]
    kept = watermark.advance_watermark(meta, "src", staged.limit(0))
    assert rows(kept, "max_update_dt") == [(w,)]
    seeded = watermark.advance_watermark(watermark.empty_meta(spark), "other", staged.limit(0))
    assert rows(seeded, "table_name", "max_update_dt") == [("other", dt.datetime(1800, 1, 1))]


def test_tie_set_takes_late_rows_of_the_watermarks_second_once(spark):
    from txnwatch import schemas
    from txnwatch.sources.tables import source_changes
    w = ts("2024-01-01 00:00:05")
    shape = "k string, v string, u string, create_dt timestamp_ntz, update_dt timestamp_ntz"
    at = lambda seconds: w + dt.timedelta(seconds=seconds)
    none = spark.createDataFrame([], schemas.TIES)

    def load(source, mark, seen):
        """One load as the daily run does it; the keys staged, the new watermark and tie set."""
        meta = spark.createDataFrame([("public", "src", mark)], schemas.META_LOAD)
        staged = source_changes(spark.createDataFrame(source, shape), "k", ["v", "u"], mark, seen=seen)
        mark = watermark.read_watermark(watermark.advance_watermark(meta, "src", staged), "src")
        return rows(staged, "k", "v"), mark, watermark.tie_set(staged, seen, "k", ["v", "u"], mark)

    one = [("K1", "a", None, at(-0.5), None), ("K2", "b", None, at(-9), None), (None, "n", None, at(0.2), None)]
    got, mark, seen = load(one, at(-5), none)
    assert got == [("K1", "a"), (None, "n")] and mark == w  # both round to the watermark's second
    # the same second again: a late key, half a second before and 0.4 after; K1 with its value moved to the other column
    two = [*one[1:], ("K1", None, "a", at(0), None), ("K3", "c", None, at(-0.5), None), ("K4", "d", None, None, at(0.4))]
    got, mark, seen = load(two, mark, seen)
    assert got == [("K1", None), ("K3", "c"), ("K4", "d")] and mark == w
    # nothing new, then a later second
    got, mark, seen = load(two, mark, seen)
    assert got == [] and mark == w and seen.count() == 5
    got, mark, seen = load([*two, ("K5", "e", None, at(1), None)], mark, seen)
    assert got == [("K5", "e")] and mark == at(1) and rows(seen, "tie_key") == [("K5",)]
    # a set left behind by a load that died takes nothing away
    got, mark, _ = load([("K6", "f", None, at(3), None)], at(3), seen)
    assert got == [("K6", "f")]
    # strict, as without a tie set
    assert source_changes(spark.createDataFrame(two, shape), "k", ["v", "u"], w).count() == 0
