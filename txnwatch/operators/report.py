"""Fraud report: union of the rules with rule priority, and incremental append.

The report keeps one row per ``(event_dt, passport)``: the rule listed first
wins (the reference inserts rules in order and ignores conflicts). Rows with
a NULL passport never conflict, so all of them are kept within a run; across
runs a row equal in every column but ``report_dt`` is not added again.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["event_dt", "passport"]


def _report_dt(report_dt: dt.date | Column | None) -> Column:
    if report_dt is None:
        return F.current_date()
    return report_dt if isinstance(report_dt, Column) else F.lit(report_dt)


def fraud_report(rule_rows: list[DataFrame] | DataFrame, report_dt: dt.date | Column | None = None) -> DataFrame:
    """Rule outputs (event_dt, passport, fio, phone, event_type int) → report rows.

    Priority is the smallest event_type per key, computed with a partial
    aggregation (``min`` of a struct), so no key is gathered into one task.
    A NULL passport never conflicts: such a row gets a group of its own (a
    per-row id joins the grouping key), so all of them are kept and they do
    not pile up in one NULL group. The rule rows are read once.
    """
    u = rule_rows if isinstance(rule_rows, DataFrame) else reduce(DataFrame.unionByName, rule_rows)
    own = F.when(F.col("passport").isNull(), F.monotonically_increasing_id())
    best = (u.groupBy(*KEY, own.alias("_own"))
            .agg(F.min(F.struct("event_type", "fio", "phone")).alias("_w")))
    return best.select(*KEY, F.col("_w.fio").alias("fio"), F.col("_w.phone").alias("phone"),
                       F.col("_w.event_type").cast("string").alias("event_type"),
                       _report_dt(report_dt).alias("report_dt"))


def new_report_rows(existing: DataFrame, candidate: DataFrame) -> DataFrame:
    """Candidate rows not yet reported, as one anti join.

    Equi keys ``event_dt`` and ``coalesce(passport, '')``; a NULL passport only
    matches a stored row equal in every column but report_dt (NULL-safe).
    """
    e = existing.select(*[F.col(c).alias(f"_e_{c}") for c in ["event_dt", "passport", "fio", "phone", "event_type"]])
    same = lambda c: F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    cond = ((F.col("event_dt") == F.col("_e_event_dt"))
            & (F.coalesce(F.col("passport"), F.lit("")) == F.coalesce(F.col("_e_passport"), F.lit("")))
            & same("passport")
            & (F.col("passport").isNotNull() | (same("fio") & same("phone") & same("event_type"))))
    return candidate.join(e, cond, "left_anti")


def append_report(existing: DataFrame, candidate: DataFrame) -> DataFrame:
    """Report after the run: existing rows (first report_dt kept) plus new ones."""
    return existing.unionByName(new_report_rows(existing, candidate))
