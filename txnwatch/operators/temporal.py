"""Valid-at (temporal) joins and interval intersection of SCD2 histories.

``valid_at`` joins events to the dimension version valid at the event time:
an equi join on the key plus ``ts BETWEEN effective_from AND effective_to`` as
a residual condition. Catalyst plans it as a sort-merge join on the key (AQE
splits hot keys, or switches to a broadcast join when the dimension side is
measured small at run time) — no hint, so nothing of unchecked size is
broadcast.

``owner_history`` replaces the reference's three-hop chain card → account →
client (joined once per transaction) by the intersection of the three
histories, built once on dimension data only. A transaction time lies in all
three intervals iff it lies in their intersection, so one valid-at join on
``card_num`` gives the same rows, and facts are shuffled once instead of
three times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions import scalars as X
from txnwatch.functions.scalars import q

FROM, TO, FLAG = "effective_from", "effective_to", "deleted_flag"


#: Slots that a hot key is dealt to, and the events from which a key is hot.
SLOTS, HOT_ROWS = 32, 1_000_000


def live(hist: DataFrame, honour_deleted: bool = True) -> DataFrame:
    """Versions a join may use: with ``honour_deleted`` (the reference's rule) a
    soft-deleted version is excluded for all its time."""
    return hist.where(f"{FLAG} = 0") if honour_deleted else hist


def valid_at(events: DataFrame, hist: DataFrame, event_key: str, hist_key: str, ts: str,
             hist_cols: list[str] | None = None, prefix: str = "",
             honour_deleted: bool = True, how: str = "inner", strategy: str = "join",
             bucket_seconds: int = 86400, slots: int = SLOTS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Events joined to the version valid at ``events[ts]`` (closed interval).

    ``hist_cols`` picks the dimension columns to carry (renamed with ``prefix``);
    the version bounds come along as ``<prefix>effective_from/_to``.

    ``strategy="join"``: equi join on the key with the interval as a residual
    condition; its cost per key is events × versions. ``strategy="sweep"``: for
    keys with many versions, a linear pass (see ``valid_at_sweep``); exact when
    the versions of a key do not overlap, which the SCD2 operators guarantee.
    """
    if strategy == "sweep":
        return valid_at_sweep(events, hist, event_key, hist_key, ts, hist_cols, prefix,
                              honour_deleted, how, bucket_seconds)
    keep = [c for c in (hist_cols or []) if c not in (hist_key, FROM, TO)]
    h = live(hist, honour_deleted).selectExpr(
        f"{q(hist_key)} AS _va_key", *[f"{q(c)} AS {q(prefix + c)}" for c in keep],
        f"{FROM} AS {q(prefix + FROM)}", f"{TO} AS {q(prefix + TO)}")
    cond = F.expr(f"{q(event_key)} = _va_key AND {q(ts)} BETWEEN {q(prefix + FROM)} AND {q(prefix + TO)}")
    return events.join(h, cond, how).drop("_va_key")


def valid_at_slots(events: DataFrame, hist: DataFrame, event_key: str, hist_key: str, ts: str,
                   hist_cols: list[str] | None = None, prefix: str = "", honour_deleted: bool = True, how: str = "inner",
                   bucket_seconds: int = 86400, slots: int = SLOTS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Valid-at join that deals a hot key's events to ``slots`` by their time bucket.

    Time buckets go to slots in turn. A hot key's version is copied to the slots of the buckets it covers, to all ``slots`` at
    most, however long it is open, and an event meets only the versions of its own slot, so that events and
    versions of a hot key are both dealt out, whatever the planner does about skew. Keys with ``hot_rows`` events or fewer stay as they are. Keys are counted first;
    there are fewer hot ones than a ``hot_rows``-th of the events, so their list is small enough to be sent to all tasks.
    """
    keep = [c for c in (hist_cols or []) if c not in (hist_key, FROM, TO)]
    hot = F.broadcast(events.where(f"{q(event_key)} IS NOT NULL").groupBy(F.col(event_key).alias("_hot")).count()
                      .where(F.col("count") > hot_rows).select("_hot"))
    bucket = lambda t: f"CAST(floor({X.epoch_seconds_sql(t)} / {int(bucket_seconds)}) AS BIGINT)"
    e = events.join(hot, F.col(event_key) == F.col("_hot"), "left").selectExpr(
        *[q(c) for c in events.columns], f"CASE WHEN _hot IS NULL OR {q(ts)} IS NULL THEN 0 ELSE pmod({bucket(q(ts))}, {slots}) END AS _slot")
    h = live(hist, honour_deleted).selectExpr(
        f"{q(hist_key)} AS _va_key", *[f"{q(c)} AS {q(prefix + c)}" for c in keep],
        f"{FROM} AS {q(prefix + FROM)}", f"{TO} AS {q(prefix + TO)}")
    first, last = bucket(q(prefix + FROM)), bucket(q(prefix + TO))
    # a slot once: from the first bucket on, as many buckets as it covers, but one for each slot at most
    places = (f"CASE WHEN _hot IS NULL OR {q(prefix + FROM)} > {q(prefix + TO)} THEN array(0L) "
              f"ELSE transform(sequence(0L, least({last} - {first}, {slots - 1}L)), i -> pmod({first} + i, {slots})) END")
    h = h.join(hot, F.col("_va_key") == F.col("_hot"), "left").selectExpr("*", f"explode({places}) AS _va_slot").drop("_hot")
    cond = F.expr(f"{q(event_key)} = _va_key AND _slot = _va_slot AND {q(ts)} BETWEEN {q(prefix + FROM)} AND {q(prefix + TO)}")
    return e.join(h, cond, how).drop("_va_key", "_va_slot", "_slot")


def valid_at_sweep(events: DataFrame, hist: DataFrame, event_key: str, hist_key: str, ts: str,
                   hist_cols: list[str] | None = None, prefix: str = "", honour_deleted: bool = True,
                   how: str = "inner", bucket_seconds: int = 86400) -> DataFrame:
    """Valid-at join as a sweep: events and version starts in one time order per key.

    Versions are unioned with the events. A window per (key, time bucket)
    carries the latest version started at or before each event. A small
    per-(key, bucket) edge table carries it across buckets, so no window is
    partitioned by the key alone. Events whose carried version has ended
    (``effective_to < ts``) get none, and so do events without a key or time, which
    ``how="left"`` keeps. Cost is linear in events + versions.
    """
    keep = [c for c in (hist_cols or []) if c not in (hist_key, FROM, TO)]
    vfields = ", ".join([f"'f', {FROM}", f"'t', {TO}"] + [f"'{c}', {q(c)}" for c in keep])
    ev_cols = events.columns
    e = events.selectExpr(f"{q(event_key)} AS _sw_key", f"{q(ts)} AS _sw_ts", "1 AS _sw_kind",
                          f"struct({', '.join(q(c) for c in ev_cols)}) AS _sw_ev",
                          "CAST(NULL AS STRUCT<" + "f: TIMESTAMP_NTZ, t: TIMESTAMP_NTZ"
                          + "".join(f", {c}: {dict(hist.dtypes)[c]}" for c in keep) + ">) AS _sw_v")
    v = live(hist, honour_deleted).selectExpr(
        f"{q(hist_key)} AS _sw_key", f"{FROM} AS _sw_ts", "0 AS _sw_kind",
        f"CAST(NULL AS {e.schema['_sw_ev'].dataType.simpleString()}) AS _sw_ev", f"named_struct({vfields}) AS _sw_v")
    u = e.unionByName(v).where("_sw_key IS NOT NULL AND _sw_ts IS NOT NULL")
    sec = X.epoch_seconds_sql("_sw_ts")
    u = u.selectExpr("*", f"CAST(floor({sec} / {int(bucket_seconds)}) AS BIGINT) AS _b")
    # A version starting at the event's second is valid for it: versions sort first.
    w = "PARTITION BY _sw_key, _b ORDER BY _sw_ts, _sw_kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    u = u.selectExpr("*", f"last(_sw_v, true) OVER ({w}) AS _sw_in").where("_sw_key IS NOT NULL AND _b IS NOT NULL")
    # One edge row for every (key, bucket), also those with events only.
    edges = u.groupBy("_sw_key", "_b").agg(
        F.expr("max_by(_sw_v, _sw_ts) FILTER (WHERE _sw_kind = 0) AS _sw_last"))
    edges = edges.selectExpr("_sw_key", "_b", "last(_sw_last, true) OVER (PARTITION BY _sw_key ORDER BY _b "
                                              "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _sw_carry")
    j = u.where("_sw_kind = 1").join(edges, on=["_sw_key", "_b"], how="left")
    j = j.selectExpr("_sw_ev", "_sw_ts", "coalesce(_sw_in, _sw_carry) AS _sw_hit")
    found = "(_sw_hit IS NOT NULL AND _sw_hit.t >= _sw_ts)"
    if how == "inner":
        j = j.where(found)
    elif how != "left":
        raise ValueError(how)
    pick = lambda f: f"CASE WHEN {found} THEN _sw_hit.{f} END"
    j = j.selectExpr(*[f"_sw_ev.{q(c)} AS {q(c)}" for c in ev_cols],
                     *[f"{pick(c)} AS {q(prefix + c)}" for c in keep],
                     f"{pick('f')} AS {q(prefix + FROM)}", f"{pick('t')} AS {q(prefix + TO)}")
    if how == "inner":
        return j
    rest = events.where(f"{q(event_key)} IS NULL OR {q(ts)} IS NULL")
    kinds = dict(j.dtypes)
    return j.unionByName(rest.selectExpr(*[q(c) for c in ev_cols], *[
        f"CAST(NULL AS {kinds[c]}) AS {q(c)}" for c in j.columns[len(ev_cols):]]))


def intersect(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              left_from: str, left_to: str, right_from: str, right_to: str,
              out_from: str = FROM, out_to: str = TO) -> DataFrame:
    """Pairs of versions with equal key whose intervals overlap, with the common interval."""
    cond = F.expr(f"{q(left_key)} = {q(right_key)} AND {q(left_from)} <= {q(right_to)} "
                  f"AND {q(right_from)} <= {q(left_to)}")
    j = left.join(right, cond, "inner")
    rest = [c for c in j.columns if c not in (left_from, left_to, right_from, right_to)]
    return j.selectExpr(*[q(c) for c in rest],
                        f"greatest({q(left_from)}, {q(right_from)}) AS {q(out_from)}",
                        f"least({q(left_to)}, {q(right_to)}) AS {q(out_to)}")


def owner_history(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  honour_deleted: bool = True) -> DataFrame:
    """Who owned a card when: card ⋈ account ⋈ client on overlapping validity.

    Columns: card_num, account_num, client_id, valid_to (agreement end),
    passport_num, passport_valid_to, fio, phone, effective_from, effective_to.
    """
    c = live(cards, honour_deleted).selectExpr(
        "card_num", "account_num AS _c_acc", f"{FROM} AS _c_from", f"{TO} AS _c_to")
    a = live(accounts, honour_deleted).selectExpr(
        "account_num", "valid_to", "client", f"{FROM} AS _a_from", f"{TO} AS _a_to")
    k = live(clients, honour_deleted).selectExpr(
        "client_id", "passport_num", "passport_valid_to",
        f"{X.full_name_sql('last_name', 'first_name', 'patronymic')} AS fio", "rtrim(phone) AS phone",
        f"{FROM} AS _k_from", f"{TO} AS _k_to")
    ca = intersect(c, a, "_c_acc", "account_num", "_c_from", "_c_to", "_a_from", "_a_to",
                   "_ca_from", "_ca_to").drop("_c_acc")
    cak = intersect(ca, k, "client", "client_id", "_ca_from", "_ca_to", "_k_from", "_k_to")
    return cak.select("card_num", "account_num", "client_id", "valid_to", "passport_num",
                      "passport_valid_to", "fio", "phone", FROM, TO)


def enrich(transactions: DataFrame, owners: DataFrame) -> DataFrame:
    """Each transaction with the owner valid at its time (one join on card_num)."""
    return valid_at(transactions, owners, "card_num", "card_num", "trans_date",
                    hist_cols=["account_num", "client_id", "valid_to", "passport_num",
                               "passport_valid_to", "fio", "phone"],
                    prefix="", honour_deleted=False) \
        .withColumnRenamed("passport_num", "passport").drop(FROM, TO)


def enrich_terminals(enriched: DataFrame, terminals: DataFrame, honour_deleted: bool = True) -> DataFrame:
    """Enriched transactions that also have a terminal version valid at their time."""
    return valid_at(enriched, terminals, "terminal", "terminal_id", "trans_date",
                    hist_cols=["terminal_city"], prefix="", honour_deleted=honour_deleted) \
        .drop(FROM, TO)
