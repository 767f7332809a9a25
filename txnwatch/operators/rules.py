"""The four fraud rules over enriched transactions.

Input of rules 1-2: ``enriched`` (transactions with the owner valid at their
time). Input of rules 3-4: ``enriched_t`` (also with a terminal version).
Each rule returns ``event_dt, passport, fio, phone, event_type`` (int; the
report stores it as text).

Rules 3 and 4 look at the previous operations of the same card. Both bound
the look-back in time (1 hour, 20 minutes), so they use ``lag_chain``, which
partitions by (card, time bucket): a card with a third of all operations is
spread over its buckets instead of one task. ``card_rules`` evaluates both
in one window pass; ``rule_hits`` evaluates all four rules in one pass over
the enriched rows (the report's plan).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.functions import scalars as X
from txnwatch.operators import temporal
from txnwatch.operators.sequence import DEFAULT_BUCKET_SECONDS, lag_chain

OUT = ["event_dt", "passport", "fio", "phone", "event_type"]
CITY_GAP = dt.timedelta(hours=1)
PROBE_SPAN = dt.timedelta(minutes=20)
PROBE_REJECTS = 3


def _out(df: DataFrame, event_type: int | str) -> DataFrame:
    return df.selectExpr("trans_date AS event_dt", "passport", "fio", "phone", f"{event_type} AS event_type")


def _within_sql(ts: str, earlier: str, span: dt.timedelta) -> str:
    """``earlier`` exists and ``ts - earlier <= span`` (inclusive)."""
    return (f"({earlier} IS NOT NULL AND ({ts} - {earlier}) <= "
            f"make_dt_interval(0, 0, 0, {span.total_seconds()}))")


def _within(ts: str, earlier: str, span: dt.timedelta) -> Column:
    return F.expr(_within_sql(ts, earlier, span))


def blacklist_since(blacklist: DataFrame) -> DataFrame:
    """First blacklisting day per passport (the fact table holds one row per passport)."""
    return blacklist.groupBy("passport_num").agg(F.min("entry_dt").alias("_bl_since"))


PASSPORT_SQL = ("((passport_valid_to IS NOT NULL AND CAST(passport_valid_to AS TIMESTAMP_NTZ) < trans_date) "
                "OR (_bl_since IS NOT NULL AND trans_date >= CAST(_bl_since AS TIMESTAMP_NTZ)))")
AGREEMENT_SQL = "(CAST(valid_to AS TIMESTAMP_NTZ) < trans_date)"


def passport_condition() -> Column:
    return F.expr(PASSPORT_SQL)


def rule_passport(enriched: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Rule 1: operation with an expired passport (valid_to before the operation;
    a date counts as its midnight) or a passport blacklisted on or before it."""
    bl = blacklist_since(blacklist)
    j = enriched.join(bl, enriched["passport"] == bl["passport_num"], "left")
    return _out(j.where(passport_condition()), 1)


def agreement_condition() -> Column:
    return F.expr(AGREEMENT_SQL)


def rule_agreement(enriched: DataFrame) -> DataFrame:
    """Rule 2: operation after the account agreement ended."""
    return _out(enriched.where(agreement_condition()), 2)


def city_jump_sql(gap: dt.timedelta = CITY_GAP) -> str:
    return f"({_within_sql('trans_date', 'lag1_trans_date', gap)} AND lag1_terminal_city <> terminal_city)"


def city_jump_condition(gap: dt.timedelta = CITY_GAP) -> Column:
    return F.expr(city_jump_sql(gap))


def amount_probe_sql(n: int = PROBE_REJECTS, span: dt.timedelta = PROBE_SPAN) -> str:
    """Chain of ``n`` rejected withdrawals with falling amounts, then a smaller successful one."""
    amts = ["amt"] + [f"lag{k}_amt" for k in range(1, n + 1)]
    parts = [_within_sql("trans_date", f"lag{n}_trans_date", span)]
    parts += [f"{amts[i]} < {amts[i + 1]}" for i in range(n)]
    parts += [f"oper_result = '{X.OPER_SUCCESS}'"]
    parts += [f"lag{k}_oper_result = '{X.OPER_REJECT}'" for k in range(1, n + 1)]
    parts += [f"{c} = '{X.OPER_WITHDRAW}'" for c in ["oper_type"] + [f"lag{k}_oper_type" for k in range(1, n + 1)]]
    return "(" + " AND ".join(parts) + ")"


def amount_probe_condition(n: int = PROBE_REJECTS, span: dt.timedelta = PROBE_SPAN) -> Column:
    return F.expr(amount_probe_sql(n, span))


def with_card_lags(enriched_t: DataFrame, n: int, span: dt.timedelta,
                   bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Previous ``n`` operations of the same card (by time, then trans_id)."""
    return lag_chain(enriched_t, "card_num", "trans_date", ["trans_id"],
                     ["terminal_city", "amt", "oper_result", "oper_type"], n,
                     int(span.total_seconds()), bucket_seconds)


def rule_city_jump(enriched_t: DataFrame, gap: dt.timedelta = CITY_GAP,
                   bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Rule 3: the previous operation of the card was in another city at most ``gap`` earlier."""
    lagged = with_card_lags(enriched_t, 1, gap, bucket_seconds)
    return _out(lagged.where(city_jump_condition(gap)), 3)


def rule_amount_probe(enriched_t: DataFrame, n: int = PROBE_REJECTS, span: dt.timedelta = PROBE_SPAN,
                      bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Rule 4: amount probing (``n`` falling rejected withdrawals then a success, within ``span``)."""
    lagged = with_card_lags(enriched_t, n, span, bucket_seconds)
    return _out(lagged.where(amount_probe_condition(n, span)), 4)


def card_rules(enriched_t: DataFrame, gap: dt.timedelta = CITY_GAP, n: int = PROBE_REJECTS,
               span: dt.timedelta = PROBE_SPAN, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Rules 3 and 4 from one window pass; a row hitting both yields two rows."""
    lagged = with_card_lags(enriched_t, max(n, 1), max(gap, span), bucket_seconds)
    return card_hits(lagged, gap, n, span)


def card_hits(lagged: DataFrame, gap: dt.timedelta = CITY_GAP, n: int = PROBE_REJECTS, span: dt.timedelta = PROBE_SPAN) -> DataFrame:
    """Hits of rules 3 and 4 among operations that have their lags, batch or stream."""
    hits = (f"filter(array(CASE WHEN {city_jump_sql(gap)} THEN 3 END, "
            f"CASE WHEN {amount_probe_sql(n, span)} THEN 4 END), x -> x IS NOT NULL)")
    return _out(lagged.selectExpr("*", f"explode({hits}) AS _hit"), "_hit")


def rule_hits(enriched: DataFrame, blacklist: DataFrame, terminals: DataFrame,
              gap: dt.timedelta = CITY_GAP, n: int = PROBE_REJECTS, span: dt.timedelta = PROBE_SPAN,
              bucket_seconds: int = DEFAULT_BUCKET_SECONDS, honour_deleted: bool = True) -> DataFrame:
    """All four rules from one pass over ``enriched``; one output row per (operation, rule hit).

    The terminal version is a left valid-at join, so rules 1-2 still see every
    operation; the card window is partitioned by (card, has terminal, time
    bucket), so rules 3-4 only see operations with a terminal version, exactly
    as an inner join before ``LAG`` would. The enriched rows are planned and
    shuffled once instead of once per rule.
    """
    bl = blacklist_since(blacklist)
    e = enriched.join(bl, enriched["passport"] == bl["passport_num"], "left").drop("passport_num")
    et = temporal.valid_at(e, terminals, "terminal", "terminal_id", "trans_date",
                           hist_cols=["terminal_city"], prefix="_t_", honour_deleted=honour_deleted, how="left")
    et = et.selectExpr("trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result",
                       "passport", "passport_valid_to", "valid_to", "fio", "phone", "_bl_since",
                       "_t_terminal_city AS terminal_city", "_t_effective_from IS NOT NULL AS _has_t")
    lagged = lag_chain(et, ["card_num", "_has_t"], "trans_date", ["trans_id"],
                       ["terminal_city", "amt", "oper_result", "oper_type"], max(n, 1),
                       int(max(gap, span).total_seconds()), bucket_seconds)
    hits = (f"filter(array(CASE WHEN {PASSPORT_SQL} THEN 1 END, CASE WHEN {AGREEMENT_SQL} THEN 2 END, "
            f"CASE WHEN _has_t AND {city_jump_sql(gap)} THEN 3 END, "
            f"CASE WHEN _has_t AND {amount_probe_sql(n, span)} THEN 4 END), x -> x IS NOT NULL)")
    return _out(lagged.selectExpr("*", f"explode({hits}) AS _hit"), "_hit")
