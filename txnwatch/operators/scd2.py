"""Type-2 slowly changing dimension history as pure DataFrame functions.

History rows: key, tracked attributes, ``effective_from``, ``effective_to``
(both inclusive, one-second grain), ``deleted_flag``. A version is open when
``effective_to >= OPEN_END``.

One load (``scd2_merge``) does what four warehouse statements do: insert keys
never seen, close the open version of a changed key at ``change - 1 s``, open
the next version, and soft-delete keys missing from the full key slice. It is
written as ``hist, staged, keys -> hist`` with no in-place update, and is
idempotent (loading the same staged rows twice equals loading them once).

``scd2_from_changes`` / ``scd2_from_snapshots`` build the whole history of an
ordered series of loads in one pass, equal to folding ``scd2_merge`` over it.

Skew: per-key state is computed with ``groupBy`` (partial aggregation, no key
is gathered into one task); ordering within a key uses windows partitioned by
(key, time bucket) linked by a small edge table; the final rewrite is a join
on the key that AQE can split or broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.functions import scalars as X
from txnwatch.functions.scalars import q

#: Time bucket of the history builders. Dimension changes are sparse: a year keeps the edge table small beside the data
#: and still bounds what one window holds of a key.
HISTORY_BUCKET_SECONDS = 366 * 86400

FROM, TO, FLAG = "effective_from", "effective_to", "deleted_flag"


def _lit_ts(value: dt.datetime | Column | str) -> Column:
    return value if isinstance(value, Column) else X.ntz(value)


def latest_per_key(staged: DataFrame, key: str, attrs: list[str], ts: str,
                   order: list[str] | None = None) -> DataFrame:
    """One staged row per key: the latest by ``ts`` (then ``order``); NULL keys rejected.

    A partial aggregation (``max`` of a struct), so a hot key is pre-combined
    on the map side instead of being gathered into one task.
    """
    fields = [f"'_ts', {q(ts)}"] + [f"'_o_{c}', {q(c)}" for c in (order or [])] + [f"'{a}', {q(a)}" for a in attrs]
    return (staged.where(f"{q(key)} IS NOT NULL").groupBy(key)
            .agg(F.expr(f"max(named_struct({', '.join(fields)})) AS _v"))
            .selectExpr(q(key), *[f"_v.{q(a)} AS {q(a)}" for a in attrs], f"_v._ts AS {q(ts)}"))


def latest_per_key_and_time(rows: DataFrame, key: str, attrs: list[str], ts: str,
                            order: list[str] | None = None) -> DataFrame:
    """One row per (key, ts): the last by ``order`` (else the largest attribute tuple)."""
    fields = [f"'_o_{c}', {q(c)}" for c in (order or [])] + [f"'{a}', {q(a)}" for a in attrs]
    return (rows.where(f"{q(key)} IS NOT NULL AND {q(ts)} IS NOT NULL").groupBy(key, ts)
            .agg(F.expr(f"max(named_struct({', '.join(fields)})) AS _v"))
            .selectExpr(q(key), *[f"_v.{q(a)} AS {q(a)}" for a in attrs], q(ts)))


def _differs(left: str, right: str, attrs: list[str]) -> str:
    """SQL: some attribute of struct ``left`` differs (NULL-safe) from struct ``right``."""
    if not attrs:
        return "false"
    return X.any_differs_sql([(f"{left}.{a}", f"{right}.{a}") for a in attrs])


def _bucketed(rows: DataFrame, key: str, attrs: list[str], ts: str, bucket_seconds: int,
              extra: list[str] | None = None) -> DataFrame:
    """Key, time, bucket and the attributes as one struct ``_a`` (attributes travel
    only inside ``_a``, so every consumer needs the same columns)."""
    return rows.selectExpr(q(key), q(ts), *(q(c) for c in (extra or [])),
                           f"CAST(floor({X.epoch_seconds_sql(q(ts))} / {int(bucket_seconds)}) AS BIGINT) AS _b",
                           f"struct({', '.join(q(a) for a in attrs)}) AS _a")


def _unpack(attrs: list[str]) -> list[str]:
    return [f"_a.{q(a)} AS {q(a)}" for a in attrs]


def _shared(d: DataFrame, key: str) -> DataFrame:
    """State the join's NULL-key filter once, above the window, so the two uses
    of ``d`` (edge table and join back) stay identical and Spark reuses the
    shuffle under them instead of running the window pass twice."""
    return d.where(f"{q(key)} IS NOT NULL AND _b IS NOT NULL")


def scd2_from_changes(changes: DataFrame, key: str, attrs: list[str], ts: str,
                      order: list[str] | None = None,
                      bucket_seconds: int = HISTORY_BUCKET_SECONDS) -> DataFrame:
    """History from a change log (key, attrs, change time): one version per run of equal values.

    Same-second changes of a key keep the last by ``order``; a change to equal
    values (NULL-safe) extends the version; a version ends one second before
    the next one starts; the last one is open.

    Plan: one window pass per (key, time bucket) finds run starts inside each
    bucket; a small per-(key, bucket) edge table links buckets (is the first
    row of a bucket a run start, where does the next run start); one join of
    the edges back on (key, bucket). No window is partitioned by key alone.
    """
    k, t = q(key), q(ts)
    w = f"PARTITION BY {k}, _b ORDER BY {t}"
    after = "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    we = f"PARTITION BY {k} ORDER BY _b"
    c = latest_per_key_and_time(changes, key, attrs, ts, order)
    d = _bucketed(c, key, attrs, ts, bucket_seconds)
    d = d.selectExpr("*", f"lag(_a) OVER ({w}) AS _pa", f"lag(1) OVER ({w}) IS NULL AS _first")
    d = d.selectExpr("*", f"NOT _first AND {_differs('_pa', '_a', attrs)} AS _inner_start")
    d = d.selectExpr("*", f"min(CASE WHEN _inner_start THEN {t} END) OVER ({w} {after}) AS _next_inner")
    d = _shared(d, key)
    edges = d.groupBy(key, "_b").agg(
        F.expr(f"min(named_struct('t', {t}, 'a', _a)) AS _f"),
        F.expr(f"max(named_struct('t', {t}, 'a', _a)) AS _l"),
        F.expr(f"min(CASE WHEN _inner_start THEN {t} END) AS _inner_min"))
    edges = edges.selectExpr(k, "_b", "_f", "_inner_min", f"lag(_l) OVER ({we}) AS _pl")
    fis = f"(_pl IS NULL OR {_differs('_pl.a', '_f.a', attrs)})"
    edges = edges.selectExpr(k, "_b", f"{fis} AS _first_is_start",
                             f"CASE WHEN {fis} THEN _f.t ELSE _inner_min END AS _bstart")
    edges = edges.selectExpr(k, "_b", "_first_is_start",
                             f"first(_bstart, true) OVER ({we} {after}) AS _next_after")
    j = d.join(edges, on=[key, "_b"], how="inner")
    return j.where("CASE WHEN _first THEN _first_is_start ELSE _inner_start END").selectExpr(
        k, *_unpack(attrs), f"{t} AS {FROM}",
        f"coalesce(coalesce(_next_inner, _next_after) - INTERVAL '1' SECOND, {X.ntz_sql(X.OPEN_END)}) AS {TO}",
        f"0 AS {FLAG}")


def scd2_from_snapshots(snapshots: DataFrame, key: str, attrs: list[str], ts: str,
                        bucket_seconds: int = HISTORY_BUCKET_SECONDS) -> DataFrame:
    """History from full snapshots (every present key per snapshot time ``ts``).

    A key absent from the snapshot after one it was in is soft-deleted at that
    snapshot's time (no minus one second) and then frozen: a later return is
    not reopened and the delete is not re-stamped (the fixed defaults of
    ``scd2_merge``). Same plan shape as ``scd2_from_changes``: one bucketed
    window pass, one edge table, one join back.
    """
    k, t = q(key), q(ts)
    w = f"PARTITION BY {k}, _b ORDER BY {t}"
    after = "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    we = f"PARTITION BY {k} ORDER BY _b"
    p = latest_per_key_and_time(snapshots, key, attrs, ts)
    # Distinct snapshot times with their successor: one row per snapshot (file),
    # so this ordered window is over a handful of rows.
    times = snapshots.select(ts).where(f"{t} IS NOT NULL").distinct() \
                     .selectExpr(t, f"lead({t}) OVER (ORDER BY {t}) AS _ns")
    d = _bucketed(p.join(times, on=ts, how="left"), key, attrs, ts, bucket_seconds, extra=["_ns"])
    d = d.selectExpr("*", f"lag(_a) OVER ({w}) AS _pa", f"lag(1) OVER ({w}) IS NULL AS _first",
                     f"lead({t}) OVER ({w}) AS _nts")
    d = d.selectExpr("*", f"NOT _first AND {_differs('_pa', '_a', attrs)} AS _inner_start",
                     "CASE WHEN _nts IS NOT NULL AND _ns IS NOT NULL AND _nts <> _ns THEN _ns END AS _gap_inner")
    d = d.selectExpr("*", f"min(CASE WHEN _inner_start THEN {t} END) OVER ({w} {after}) AS _next_inner")
    d = _shared(d, key)
    edges = d.groupBy(key, "_b").agg(
        F.expr(f"min(named_struct('t', {t}, 'a', _a)) AS _f"),
        F.expr(f"max(named_struct('t', {t}, 'a', _a, 'ns', _ns)) AS _l"),
        F.expr(f"min(CASE WHEN _inner_start THEN {t} END) AS _inner_min"),
        F.expr("min(_gap_inner) AS _gap_min"))
    edges = edges.selectExpr(k, "_b", "_f", "_l", "_inner_min", "_gap_min",
                             f"lag(_l) OVER ({we}) AS _pl", f"lead(_f.t) OVER ({we}) AS _nft")
    fis = f"(_pl IS NULL OR {_differs('_pl.a', '_f.a', attrs)})"
    last_gap = "CASE WHEN _l.ns IS NOT NULL AND (_nft IS NULL OR _nft <> _l.ns) THEN _l.ns END"
    edges = edges.selectExpr(k, "_b", f"{fis} AS _first_is_start",
                             f"CASE WHEN {fis} THEN _f.t ELSE _inner_min END AS _bstart",
                             f"least(_gap_min, {last_gap}) AS _bgap")
    edges = edges.selectExpr(k, "_b", "_first_is_start",
                             f"first(_bstart, true) OVER ({we} {after}) AS _next_after",
                             f"min(_bgap) OVER (PARTITION BY {k}) AS _first_del")
    j = d.join(edges, on=[key, "_b"], how="inner")
    j = j.selectExpr("*", "coalesce(_next_inner, _next_after) AS _nxt")
    by_next = "(_nxt IS NOT NULL AND (_first_del IS NULL OR _nxt < _first_del))"
    return j.where(f"CASE WHEN _first THEN _first_is_start ELSE _inner_start END "
                   f"AND (_first_del IS NULL OR {t} < _first_del)").selectExpr(
        k, *_unpack(attrs), f"{t} AS {FROM}",
        f"CASE WHEN {by_next} THEN _nxt - INTERVAL '1' SECOND WHEN _first_del IS NOT NULL THEN _first_del "
        f"ELSE {X.ntz_sql(X.OPEN_END)} END AS {TO}",
        f"CASE WHEN NOT {by_next} AND _first_del IS NOT NULL THEN 1 ELSE 0 END AS {FLAG}")


# ---------------------------------------------------------------------------
# Pieces of one load
# ---------------------------------------------------------------------------

def key_state(hist: DataFrame, key: str) -> DataFrame:
    """Per key: latest end (``max_end_dt``) and latest end among deleted rows."""
    return hist.groupBy(key).agg(F.expr(f"max({TO}) AS max_end_dt"),
                                 F.expr(f"max(CASE WHEN {FLAG} = 1 THEN {TO} END) AS _max_deleted_end"))


def open_versions(hist: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    return hist.where(f"{TO} >= {X.ntz_sql(X.OPEN_END)}").selectExpr(
        q(key), f"{FROM} AS _open_from", *[f"{q(a)} AS {q('_open_' + a)}" for a in attrs])


def current_view(hist: DataFrame) -> DataFrame:
    """Open, not deleted versions: the dimension as it is now."""
    return hist.where(f"{TO} >= {X.ntz_sql(X.OPEN_END)} AND {FLAG} = 0")


def as_of(hist: DataFrame, at: dt.datetime | Column) -> DataFrame:
    """Versions valid at one time (closed interval, deleted versions excluded)."""
    if isinstance(at, Column):
        return hist.where((F.col(FLAG) == 0) & at.between(F.col(FROM), F.col(TO)))
    return hist.where(f"{FLAG} = 0 AND {X.ntz_sql(at)} BETWEEN {FROM} AND {TO}")


def latest_end(hist: DataFrame, key: str) -> DataFrame:
    """Latest version end per key (``max(effective_to)``)."""
    return hist.groupBy(key).agg(F.expr(f"max({TO}) AS max_end_dt"))


def classify(hist: DataFrame, staged: DataFrame, key: str, attrs: list[str], ts: str = "update_dt",
             reopen_returning: bool = False) -> DataFrame:
    """Each staged key (latest row) labelled new / changed / same / stale / returning.

    * new: the key has no history row at all;
    * changed: an attribute differs (NULL-safe) from the open version and the
      change is later than that version's start;
    * stale: differs but dated at or before the open version's start (ignored);
    * returning: history exists but no open version (deleted earlier); only
      reopened with ``reopen_returning``.
    """
    s = latest_per_key(staged, key, attrs, ts)
    j = s.join(key_state(hist, key), on=key, how="left").join(open_versions(hist, key, attrs), on=key, how="left")
    diff = X.any_differs_sql([(a, f"_open_{a}") for a in attrs])
    kind = (f"CASE WHEN max_end_dt IS NULL THEN 'new' WHEN _open_from IS NULL THEN 'returning' "
            f"WHEN NOT {diff} THEN 'same' WHEN {q(ts)} > _open_from THEN 'changed' ELSE 'stale' END")
    opens = ", ".join(f"'{o}'" for o in ["new", "changed"] + (["returning"] if reopen_returning else []))
    return j.selectExpr("*", f"{kind} AS change_kind").selectExpr("*", f"change_kind IN ({opens}) AS _opens")


def _hist_row(key: str, attrs: list[str]) -> list[str]:
    return [q(key), *[q(a) for a in attrs]]


def new_keys(hist: DataFrame, staged: DataFrame, key: str, attrs: list[str], ts: str = "update_dt") -> DataFrame:
    """Versions inserted for keys with no history row (anti join)."""
    s = latest_per_key(staged, key, attrs, ts)
    return (s.join(hist.select(key), on=key, how="left_anti")
            .selectExpr(*_hist_row(key, attrs), f"{q(ts)} AS {FROM}", f"{X.ntz_sql(X.OPEN_END)} AS {TO}",
                        f"0 AS {FLAG}"))


def changed_rows(hist: DataFrame, staged: DataFrame, key: str, attrs: list[str], ts: str = "update_dt") -> DataFrame:
    """Staged rows that change an open version: key, new attributes, change time, old version start."""
    s = latest_per_key(staged, key, attrs, ts)
    j = s.join(open_versions(hist, key, attrs), on=key, how="inner")
    return (j.where(f"{X.any_differs_sql([(a, f'_open_{a}') for a in attrs])} AND {q(ts)} > _open_from")
            .selectExpr(*_hist_row(key, attrs), q(ts), "_open_from AS prev_effective_from"))


def _slice(keys: DataFrame, key: str, keys_col: str | None) -> DataFrame:
    return keys.selectExpr(f"{q(keys_col or key)} AS {q(key)}").where(f"{q(key)} IS NOT NULL")


def missing_keys(hist: DataFrame, keys: DataFrame, key: str, keys_col: str | None = None) -> DataFrame:
    """History keys absent from the full key slice, with their latest version end."""
    return key_state(hist, key).join(_slice(keys, key, keys_col), on=key, how="left_anti") \
        .selectExpr(q(key), "max_end_dt", "_max_deleted_end = max_end_dt AS already_deleted")


def soft_delete(hist: DataFrame, keys: DataFrame, key: str, delete_ts: dt.datetime | Column,
                restamp_deleted: bool = False, keys_col: str | None = None) -> DataFrame:
    """The latest version of every key missing from the slice, ended at ``delete_ts``, flag 1.

    Returns only the rewritten rows. Keys whose latest version is already
    deleted are left alone unless ``restamp_deleted``.
    """
    m = missing_keys(hist, keys, key, keys_col)
    if not restamp_deleted:
        m = m.where("NOT coalesce(already_deleted, false)")
    j = hist.join(m.selectExpr(q(key), "max_end_dt AS _last_to"), on=key, how="inner")
    rest = [c for c in hist.columns if c not in (key, TO, FLAG)]
    return (j.where(f"{TO} = _last_to")
            .select(key, *rest, _lit_ts(delete_ts).alias(TO), F.lit(1).alias(FLAG)))


def scd2_merge(hist: DataFrame, staged: DataFrame, keys: DataFrame | None, key: str, attrs: list[str],
               delete_ts: dt.datetime | Column, ts: str = "update_dt", keys_col: str | None = None,
               restamp_deleted: bool = False, reopen_returning: bool = False,
               fail_on_empty: bool = False) -> DataFrame:
    """One SCD2 load: new history = untouched ∪ closed ∪ opened ∪ soft-deleted rows.

    ``staged``: key, attrs, ``ts`` (change time). ``keys``: every key now in
    the source (``None`` skips soft deletes). ``delete_ts``: stamp of deletes
    (the file date for snapshots, the load time for incremental sources).
    An empty key slice soft-deletes every key (as the reference does); with
    ``fail_on_empty`` it raises instead (one small action: is there a key).
    """
    k = q(key)
    if keys is not None and fail_on_empty and not _slice(keys, key, keys_col).take(1):
        raise ValueError(f"empty key slice for {key}: refusing to soft-delete every version")
    c = classify(hist, staged, key, attrs, ts, reopen_returning)
    dts = _lit_ts(delete_ts)
    if keys is not None:
        slice_ = _slice(keys, key, keys_col).distinct()
        c = c.join(slice_.selectExpr(k, "true AS _in_slice"), on=key, how="left")
        missing = key_state(hist, key).join(slice_, on=key, how="left_anti")
        if not restamp_deleted:
            missing = missing.where("_max_deleted_end IS NULL OR _max_deleted_end < max_end_dt")
        missing = missing.selectExpr(k, "max_end_dt AS _del_at_end")
    else:
        c = c.selectExpr("*", "true AS _in_slice")
        missing = None
    # Per-key actions on existing rows: close the open version, or delete the latest one.
    closes = c.where("change_kind = 'changed'").selectExpr(k, f"{q(ts)} - INTERVAL '1' SECOND AS _close_to")
    if missing is not None:
        # A key that gets a new version is deleted through that version instead.
        acts = missing.join(c.where("_opens").select(key), on=key, how="left_anti") \
                      .join(closes, on=key, how="full")
    else:
        acts = closes.selectExpr("*", "CAST(NULL AS TIMESTAMP_NTZ) AS _del_at_end")
    is_open = f"{TO} >= {X.ntz_sql(X.OPEN_END)}"
    del_it = f"(_del_at_end IS NOT NULL AND {TO} = _del_at_end)"
    old = hist.join(acts, on=key, how="left").select(
        key, *attrs, FROM,
        F.expr(f"CASE WHEN _close_to IS NOT NULL AND {is_open} THEN _close_to "
               f"WHEN {del_it} THEN NULL ELSE {TO} END").alias("_to"),
        F.expr(del_it).alias("_del"), FLAG)
    old = old.select(key, *attrs, FROM, F.coalesce(F.col("_to"), dts).alias(TO),
                     F.expr(f"CASE WHEN _del THEN 1 ELSE {FLAG} END").alias(FLAG))
    opened = c.where("_opens").select(
        key, *attrs, F.col(ts).alias(FROM),
        F.when(F.col("_in_slice"), F.expr(X.ntz_sql(X.OPEN_END))).otherwise(dts).alias(TO),
        F.expr("CASE WHEN _in_slice THEN 0 ELSE 1 END").alias(FLAG))
    return old.unionByName(opened)


# ---------------------------------------------------------------------------
# One load on the latest versions alone
# ---------------------------------------------------------------------------

def tips(hist: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """The latest version of each key (by end, then start): all that a load has to know of a history. A partial
    aggregation; rows without a key are left out."""
    fields = ", ".join([f"'t', {TO}", f"'f', {FROM}", f"'d', {FLAG}"] + [f"'{a}', {q(a)}" for a in attrs])
    return hist.where(f"{q(key)} IS NOT NULL").groupBy(key).agg(F.expr(f"max(named_struct({fields})) AS _v")).selectExpr(
        q(key), *[f"_v.{q(a)} AS {q(a)}" for a in attrs], f"_v.f AS {FROM}", f"_v.t AS {TO}", f"_v.d AS {FLAG}")


def split_tips(hist: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """A whole history with the ``state`` of each row: ``tip`` for a key's latest version, ``past`` for the others."""
    last = tips(hist, key, attrs).selectExpr(f"{q(key)} AS _k", f"{FROM} AS _f", f"{TO} AS _t")
    j = hist.join(last, F.expr(f"{q(key)} = _k AND {FROM} = _f AND {TO} = _t"), "left")
    return j.selectExpr(*_hist_row(key, attrs), FROM, TO, FLAG, "CASE WHEN _k IS NULL THEN 'past' ELSE 'tip' END AS state")


#: Acts that leave a key's versions as they are.
IDLE = ("same", "stale", "returning")


def scd2_step(tips: DataFrame, staged: DataFrame, keys: DataFrame | None, key: str, attrs: list[str],
              delete_ts: dt.datetime | Column, ts: str = "update_dt", restamp_deleted: bool = False,
              reopen_returning: bool = False) -> DataFrame:
    """One SCD2 load on the latest versions: the new tips of all keys, and the versions that the load ends (``past``).

    Together with the past rows of before this is ``scd2_merge`` of the whole history, which is not read: two joins on the
    key over tips. Beside the version columns: ``state`` (tip / past), ``act`` (new, changed, deleted,
    reopened, or same, stale, returning, which change nothing) and ``since``, the time from which on the key's valid version may be another one
    than before the load (NULL where it is not).
    """
    k, open_end = q(key), X.ntz_sql(X.OPEN_END)
    s = latest_per_key(staged, key, attrs, ts).selectExpr(k, f"struct({', '.join([q(a) for a in attrs] + [q(ts) + ' AS _ts'])}) AS _s")
    t = tips.selectExpr(k, f"struct({', '.join([q(a) for a in attrs] + [f'{FROM} AS _f', f'{TO} AS _t', f'{FLAG} AS _d'])}) AS _o")
    j = t.join(s, key, "full_outer")
    if keys is None:
        j = j.selectExpr("*", "true AS _in")
    else:
        j = j.join(_slice(keys, key, None).distinct().selectExpr(k, "true AS _in"), key, "left")
    back = "'reopened'" if reopen_returning else "'returning'"
    j = j.selectExpr("*", f"CASE WHEN _o IS NULL THEN 'new' WHEN _s IS NULL THEN 'same' WHEN _o._t < {open_end} THEN {back} "
                          f"WHEN NOT {_differs('_o', '_s', attrs)} THEN 'same' WHEN _s._ts > _o._f THEN 'changed' ELSE 'stale' END AS _act")
    gone = "_in IS NULL AND _act NOT IN ('new', 'changed', 'reopened')" + ("" if restamp_deleted else " AND _o._d = 0")
    j = j.withColumn("_dts", _lit_ts(delete_ts)).selectExpr(
        "*", f"CASE WHEN {gone} THEN 'deleted' ELSE _act END AS act", "_act IN ('new', 'changed', 'reopened') AS _opens")

    def row(state: str, of: str, start: str, end: str, flag: str) -> str:
        fields = [f"'{a}', {of}.{q(a)}" for a in attrs] + [f"'{FROM}', {start}", f"'{TO}', {end}", f"'{FLAG}', {flag}", f"'state', '{state}'"]
        return f"named_struct({', '.join(fields)})"

    opened = row("tip", "_s", "_s._ts", f"CASE WHEN _in THEN {open_end} ELSE _dts END", "CASE WHEN _in THEN 0 ELSE 1 END")
    kept = row("tip", "_o", "_o._f", "CASE WHEN act = 'deleted' THEN _dts ELSE _o._t END", "CASE WHEN act = 'deleted' THEN 1 ELSE _o._d END")
    ended = row("past", "_o", "_o._f", "CASE WHEN act = 'changed' THEN _s._ts - INTERVAL '1' SECOND ELSE _o._t END", "_o._d")
    out = f"CASE WHEN act = 'new' THEN array({opened}) WHEN _opens THEN array({opened}, {ended}) ELSE array({kept}) END"
    return j.selectExpr(k, "act", "CASE WHEN _opens THEN _s._ts WHEN act = 'deleted' THEN _o._f END AS since", f"explode({out}) AS _r").selectExpr(
        k, *[f"_r.{q(c)} AS {q(c)}" for c in [*attrs, FROM, TO, FLAG, "state"]], "act", "since")


def key_digest(rows: DataFrame, key: str, bucket: Column, attrs: list[str] | None = None) -> DataFrame:
    """Per bucket an order-free digest of its distinct keys (with ``attrs``, of its distinct rows): their number, and the sum and
    the exclusive or of two 64-bit hashes. Equal digests mean equal sets."""
    cols = [key, *(attrs or [])]
    d = rows.where(F.col(key).isNotNull()).select(*cols).distinct().withColumn("bucket", bucket)
    h = f"xxhash64({', '.join(q(c) for c in cols)})"
    other = f"xxhash64('key', {', '.join(q(c) for c in cols)})"
    # the sum of 32-bit halves cannot overflow a long below 2^31 keys a bucket
    return d.groupBy("bucket").agg(F.expr("count(*) AS n"), F.expr(f"sum({h} & 4294967295L) AS low"), F.expr(f"sum(shiftrightunsigned({h}, 32)) AS high"),
                                   F.expr(f"bit_xor({other}) AS mixed"))
