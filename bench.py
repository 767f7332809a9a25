"""Benchmark of the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line: {"metric", "value" (sum of query seconds, without the
one-time warehouse load), "unit", "queries": {name: seconds}, "sf", ...}. Each query is executed in full with
the ``noop`` sink (no collect to the driver); the time is the median of
``$BENCH_REPEATS`` warm runs (default 3) after one warm-up pass.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Timed but not summed: writing the warehouse tables once is a load, not a query.
ONE_TIME = {"load_warehouse"}

HEADLINE = [
    "stage_transactions", "source_changes", "scd2_from_changes", "scd2_from_changes_cards",
    "scd2_from_snapshots", "scd2_merge_snapshot", "scd2_merge_incremental", "owner_history",
    "enriched", "rule_passport", "rule_agreement", "rule_city_jump", "rule_amount_probe",
    "fraud_report", "report_incremental",
]


def stored_flow(spark, sf_dir: str, repeats: int) -> dict[str, float]:
    """The production path: histories and facts written once as warehouse tables
    (timed as ``load_warehouse``), then the report over the stored tables
    (``report_from_stored``, median of warm runs)."""
    import datetime as dt
    import tempfile

    from pyspark.sql import functions as F

    from txnwatch.plans import catalog as C
    from txnwatch.plans import pipeline
    from txnwatch.plans.warehouse import Warehouse
    from txnwatch.sources import mapping as M

    root = tempfile.mkdtemp(prefix="txnwatch-bench-wh-", dir="/tmp")
    wh = Warehouse(spark, root)
    t0 = time.perf_counter()
    wh.replace("dim_cards_hist", C.card_history(spark, sf_dir))
    wh.replace("dim_accounts_hist", C.account_history(spark, sf_dir))
    wh.replace("dim_clients_hist", M.client_history(spark, sf_dir))
    wh.replace("dim_terminals_hist", C.terminal_history(spark, sf_dir))
    wh.append("fact_transactions", M.transactions(spark, sf_dir).withColumn("day", F.to_date("trans_date")), ["day"])
    wh.append("fact_blacklist", M.blacklist(spark, sf_dir))
    load = time.perf_counter() - t0
    opt = pipeline.RunOptions(report_dt=dt.date(2024, 2, 1))
    pipeline.build_report(spark, wh, opt).write.format("noop").mode("overwrite").save()  # warm-up
    runs = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        pipeline.build_report(spark, wh, opt).write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t0)
    return {"load_warehouse": round(load, 3), "report_from_stored": round(statistics.median(runs), 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from txnwatch.plans.catalog import QUERIES
    from txnwatch.session import local_session
    spark = local_session(cpus, max(cpus, 8))
    names = only or HEADLINE
    # Warm-up: JVM code paths and parquet footers.
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    if not only:
        times.update(stored_flow(spark, sf_dir, repeats))
    for name in names:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(v for k, v in times.items() if k not in ONE_TIME), 3),
        "value_excludes": sorted(ONE_TIME & set(times)),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
