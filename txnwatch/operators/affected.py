"""Which cards a load can have given another result, and since when.

The report has one row per rule hit, and a row once reported stays. So a run needs to look only at operations whose
hits may be others than at the last run: the new ones, and those whose owner, terminal version or passport entry was
changed by a load. A change note is a key and the time from which on its valid version may be another one
(``scd2_step``'s ``since``). Notes are carried to cards through the current histories: an older link from a card to a changed
account is a change of the card itself and has a note of its own.

Every result is a superset kept exact by the report's anti join: looking at more operations only costs time.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions import scalars as X

FROM, TO = "effective_from", "effective_to"
OUT = "card_num string, since timestamp_ntz, until timestamp_ntz"


def _earliest(df: DataFrame, key: str) -> DataFrame:
    return df.where(f"{key} IS NOT NULL AND since IS NOT NULL").groupBy(key).agg(F.min("since").alias("since"))


def _carried(notes: DataFrame, hist: DataFrame, on: str, to: str) -> DataFrame:
    """Notes of ``on`` as notes of the key ``to`` of the versions that name it at that time or later."""
    n = _earliest(notes, on).withColumnRenamed(on, "_on")
    j = hist.where(f"{to} IS NOT NULL").join(n, F.expr(f"{on} = _on AND {TO} >= since"), "inner")
    return _earliest(j.selectExpr(to, f"greatest(since, {FROM}) AS since"), to)


def affected_cards(cards: DataFrame, accounts: DataFrame, clients: DataFrame, facts: DataFrame, lookback: dt.timedelta,
                   card_notes: DataFrame | None = None, account_notes: DataFrame | None = None, client_notes: DataFrame | None = None,
                   terminal_notes: DataFrame | None = None, passport_notes: DataFrame | None = None,
                   fact_notes: DataFrame | None = None, owners_only: bool = False) -> DataFrame:
    """(card_num, since, until), one row a card.

    ``cards``, ``accounts``, ``clients``: the histories after the load. ``*_notes``: (key, since); ``passport_notes`` (passport_num,
    since) are new blacklist entries; ``fact_notes`` (card_num, since, until) the new operations' first and last times.
    Operations later than the noted ones by up to ``lookback`` see them as predecessors. ``facts`` is read only for
    ``terminal_notes``. ``owners_only`` leaves out what changes no owner.
    """
    open_end = X.ntz_sql(X.OPEN_END)
    by_client = [n for n in (client_notes,) if n is not None]
    if passport_notes is not None and not owners_only:
        by_client.append(_carried(passport_notes, clients, "passport_num", "client_id"))
    by_account = [n for n in (account_notes,) if n is not None]
    if by_client:
        named = accounts.withColumnRenamed("client", "client_id")
        by_account.append(_carried(reduce(DataFrame.unionByName, by_client), named, "client_id", "account_num"))
    by_card = [n for n in (card_notes,) if n is not None]
    if by_account:
        by_card.append(_carried(reduce(DataFrame.unionByName, by_account), cards, "account_num", "card_num"))
    found = [n.selectExpr("card_num", "since", f"{open_end} AS until") for n in by_card]
    late = f"make_dt_interval(0, 0, 0, {lookback.total_seconds()})"
    if not owners_only:
        if terminal_notes is not None:
            n = _earliest(terminal_notes, "terminal_id")
            at = facts.select("card_num", "terminal", "trans_date").join(n, F.expr("terminal = terminal_id AND trans_date >= since"), "inner")
            found.append(at.groupBy("card_num").agg(F.min("trans_date").alias("since"), F.max("trans_date").alias("until"))
                         .selectExpr("card_num", "since", f"until + {late} AS until"))
        if fact_notes is not None:
            found.append(fact_notes.selectExpr("card_num", "since", f"until + {late} AS until"))
    if not found:
        return cards.sparkSession.createDataFrame([], OUT)
    return reduce(DataFrame.unionByName, found).where("card_num IS NOT NULL AND since IS NOT NULL").groupBy("card_num").agg(
        F.min("since").alias("since"), F.max("until").alias("until"))


def affected_days(affected: DataFrame, days: list[str], lookback: dt.timedelta) -> list[str]:
    """Those of the stored days that hold operations of affected cards in their time, or within ``lookback`` before. The driver
    gets days, not cards."""
    if not days:
        return []
    low, high = f"DATE '{days[0]}'", f"DATE '{days[-1]}'"
    first = f"greatest(to_date(since - make_dt_interval(0, 0, 0, {lookback.total_seconds()})), {low})"
    spans = affected.selectExpr(f"{first} AS a", f"least(to_date(until), {high}) AS z").where("a <= z").distinct()
    met = {r.d.isoformat() for r in spans.selectExpr("explode(sequence(a, z)) AS d").distinct().collect()}
    return [d for d in days if d in met]


def operations_of(facts: DataFrame, affected: DataFrame, lookback: dt.timedelta) -> DataFrame:
    """The operations of affected cards in their time and the ``lookback`` before it: of a card one unbroken run, so that
    every predecessor among them is the true one."""
    a = affected.selectExpr("card_num AS _card", f"since - make_dt_interval(0, 0, 0, {lookback.total_seconds()}) AS _since", "until AS _until")
    return facts.join(a, F.expr("card_num = _card AND trans_date BETWEEN _since AND _until"), "left_semi")
