"""Physical plan checks: look-back windows are bucketed, anti joins stay anti joins,
filters and projections reach the scan."""

import datetime as dt

from txnwatch.functions import scalars as X
from txnwatch.operators import rules, scd2, temporal
from txnwatch.plans import catalog as C
from txnwatch.sources import mapping as M
from txnwatch.sources.tables import source_changes

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rule_window_is_bucketed_and_facts_shuffled_once(spark, tmp_path):
    tx_path = str(tmp_path / "tx")
    M.transactions(spark, SF).write.parquet(tx_path)
    owners = C.owners(spark, SF)
    own_path = str(tmp_path / "own")
    owners.write.parquet(own_path)
    tx = spark.read.parquet(tx_path)
    e = temporal.enrich(tx, spark.read.parquet(own_path))
    p = plan(rules.rule_hits(e, M.blacklist(spark, SF), C.terminal_history(spark, SF)))
    assert "_lc_bucket" in p and "Window" in p
    # the fact scan feeds exactly one hash exchange (dimensions are small and broadcast here)
    fact_side = [ln for ln in p.splitlines() if "Exchange hashpartitioning(card_num" in ln]
    assert len(fact_side) == 1, p


def test_anti_joins(spark):
    h, s = C._hist0_snap1(spark, SF)
    assert "LeftAnti" in plan(scd2.new_keys(h, s, "terminal_id", C.TERMINAL_ATTRS))


def test_incremental_read_pushes_filter_and_prunes(spark, tmp_path):
    M.incremental_source(spark, SF).write.parquet(str(tmp_path / "src"))   # a stored source table
    src = spark.read.parquet(str(tmp_path / "src"))
    p = plan(source_changes(src, "account", ["client"], dt.datetime(2001, 1, 1)))
    assert "PushedFilters: [Or(" in p
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "valid_to" not in scan   # projection pruned to key, attrs and the two times
