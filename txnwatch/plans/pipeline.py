"""The daily run: files → facts, snapshots and sources → SCD2 histories → report.

Order as in the reference: transactions, blacklist, terminal snapshots (each file
in business-date order), accounts, cards, clients, then the fraud report. Every
step is a Spark job over whole inputs; each table is written as a new version
(the written table cuts the lineage for the next step).

Every file is read by its listed path, committed and archived before the next one,
so a failed step never blocks what was loaded before it. A fact row carries the
name of its file (``src_file``, written with the row), and a file is loaded when the ledger says so
(``plans.ledger``): a run that died during the append completes it, one that died later only archives the file.
Source tables are read into stored staging tables first; the merge, the deletes
and the watermark use that one copy, however the source changes meanwhile. Staging goes when its load is committed.

Loads cost what they change: a merge reads and writes the key buckets it touches and leaves notes of the changed
keys, and the report looks at the operations of the cards that these notes lead to.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch import schemas
from txnwatch.functions import scalars as X
from txnwatch.operators import affected, facts, report, rules, scd2, temporal, watermark
from txnwatch.plans import ledger
from txnwatch.plans.warehouse import BUCKETS, TIP, Warehouse, bucket_of
from txnwatch.sources import files, tables

FACT_DAY = "day"
SRC_FILE = "src_file"
#: Kinds of change notes that the loads leave for the report; the kept owner history.
NOTES = ("facts", "passports", "terminals", "accounts", "cards", "clients")
OWNERS = "dim_owners"
#: Files that one load writes into one day at most.
FACT_FILES = 4


@dataclass
class Inputs:
    """Where the run reads from. Source tables are DataFrames from the caller
    (catalog table, Parquet, JDBC); missing ones are skipped."""
    files_dir: str | None = None
    archive_dir: str | None = None          # processed files are moved here (``.backup``)
    sheet_format: str = "csv"
    accounts: DataFrame | None = None
    cards: DataFrame | None = None
    clients: DataFrame | None = None
    # names under which the load metadata knows the source tables
    table_names: dict = field(default_factory=lambda: {"accounts": "info.accounts", "cards": "info.cards",
                                                       "clients": "info.clients"})


@dataclass
class RunOptions:
    report_dt: dt.date | None = None
    load_ts: dt.datetime | None = None          # delete stamp of incremental sources (now)
    on_duplicate: str = "fail"                  # facts: fail (reference) or skip (streams)
    amount_rejects: bool = False                # bad/missing amount: fail the file (reference) or set aside
    fail_on_empty: bool = False                 # an empty snapshot / source deletes everything unless set
    skip_when_no_files: bool = True             # do nothing when no file arrived
    restamp_deleted: bool = False
    reopen_returning: bool = False
    honour_deleted_interval: bool = True
    city_gap: dt.timedelta = rules.CITY_GAP
    probe_span: dt.timedelta = rules.PROBE_SPAN
    probe_rejects: int = rules.PROBE_REJECTS
    # Incremental report (D24 option): only operations at or after this time are
    # reported, and only the fact days they and their look-back need are read.
    # None = the reference's full re-scan of all facts on every run.
    report_since: dt.datetime | None = None
    # The report looks at the operations of affected cards only; the result is that of a full re-scan as long as the
    # report's own options stay the same. True = re-scan all facts (after such a change).
    full_report: bool = False
    # Rows that changed in the watermark's own second after that second was read are taken too; True = strictly later
    # ones only, as the reference does, which never reads such rows.
    strict_watermark: bool = False
    buckets: int = BUCKETS                      # key buckets of the histories; fixed for the life of a warehouse
    compact_after: int = 200                    # versions of a table by buckets until it is written as one
    keep_seconds: float = 86400.0               # age from which old versions may go


def split_rejects(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with an amount (facts) and rows without one (rejects); staged with a
    non-strict amount parse, so a bad amount is NULL instead of failing the file."""
    return staged.where("amt IS NOT NULL"), staged.where("amt IS NULL")


def _append_file(wh: Warehouse, table: str, schema: T.StructType, staged: DataFrame, key: str, on_duplicate: str, order: list[str],
                 src: str | None, days: bool = False) -> None:
    """Append the stored batch ``staged`` to a fact table. With ``src``, the name of its file in the table, what a broken append
    has left of the file is completed: the rows that the whole load adds, less those stored under this name, copy by copy."""
    cols = [*schema.fieldNames(), *([SRC_FILE] if SRC_FILE in staged.columns else [])]
    existing, mine = wh.read_facts(table, T.StructType([*schema.fields, T.StructField(SRC_FILE, T.StringType())])), None
    if src is not None:
        mine = existing.where(F.col(SRC_FILE) == src)
        existing = existing.where(~F.col(SRC_FILE).eqNullSafe(F.lit(src)))
    rows = facts.append_facts(staged, existing, key, cols, on_duplicate, order)
    if mine is not None and mine.take(1):
        rows = rows.exceptAll(mine.select(*cols))
    if not days:
        wh.append(table, rows)
        return
    # one task a day and key bucket writes few files, and a large day is still dealt out
    rows = rows.withColumn(FACT_DAY, F.to_date("trans_date")).repartition(FACT_DAY, F.pmod(F.xxhash64(key), F.lit(FACT_FILES)))
    wh.append(table, rows, [FACT_DAY], bloom=key)


def _staged(wh: Warehouse, table: str, df: DataFrame) -> tuple[DataFrame, int]:
    """The stored copy of a batch, and its rows as the write has counted them."""
    seen = Observation()
    df = wh.stage(table, df.observe(seen, F.count(F.lit(1)).alias("n")))
    return df, int(seen.get["n"] or 0)


def load_transactions(wh: Warehouse, staged: DataFrame, on_duplicate: str = "fail", src: str | None = None) -> int:
    """Append staged transactions; returns how many the batch had. ``trans_id`` is unique over the whole fact table: the check
    reads the stored key column of all days (NULL keys never conflict, as in a UNIQUE constraint).

    An amount that is missing fails the load (the fact column is NOT NULL), as
    a bad amount already failed the parse. The batch is read once: it is stored as a staging
    table, which the checks and the append read, and which goes when the rows are committed."""
    staged, n = _staged(wh, "stg_transactions", staged)
    if staged.where("amt IS NULL").take(1):
        raise ValueError("transaction without amount")
    # the note comes first: a load that dies in between leaves a note too many, never one too few
    wh.note("facts", staged.where("card_num IS NOT NULL AND trans_date IS NOT NULL").groupBy("card_num").agg(
        F.min("trans_date").alias("since"), F.max("trans_date").alias("until")))
    _append_file(wh, "fact_transactions", schemas.FACT_TRANSACTIONS, staged, "trans_id", on_duplicate, ["trans_date"], src, days=True)
    wh.unstage("stg_transactions")
    return n


def load_blacklist(wh: Warehouse, staged: DataFrame, on_duplicate: str = "fail", src: str | None = None) -> int:
    staged, n = _staged(wh, "stg_blacklist", staged)
    wh.note("passports", staged.selectExpr("passport_num", "CAST(entry_dt AS TIMESTAMP_NTZ) AS since"))
    _append_file(wh, "fact_blacklist", schemas.FACT_BLACKLIST, staged, "passport_num", on_duplicate, ["entry_dt"], src)
    wh.unstage("stg_blacklist")
    return n


def _append_rejects(wh: Warehouse, rejected: DataFrame, src: str) -> int:
    """Rows without an amount, once a file: a repeated load adds only those that are not stored yet. Their number."""
    stored = wh.read_facts("rejects_transactions", rejected.schema).where(F.col(SRC_FILE) == src)
    wh.append("rejects_transactions", rejected.exceptAll(stored) if stored.take(1) else rejected)
    return wh.read_facts("rejects_transactions", rejected.schema).where(F.col(SRC_FILE) == src).count()


def merge(wh: Warehouse, dim: str, staged: DataFrame, keys: DataFrame, delete_ts: dt.date | dt.datetime, opt: RunOptions,
          snapshot: bool = False) -> dict:
    """One SCD2 load of a dimension that reads and writes only the key buckets that it can change; returns its counts.

    A bucket can change only if it has a staged key, or if its set of source keys differs from the last load's; both are told
    by small per-bucket tables, and ``keys`` is read once. For a ``snapshot``, where all rows are staged,
    the digest covers the rows. Of the buckets read, only those with a new, changed, deleted or reopened key are written.
    The order is note, history, digest: a load that dies in between is repeated to the same result. ``staged`` and ``keys``
    are stored tables. An untouched bucket's keys are in no count.
    """
    spec, table = schemas.DIMENSIONS[dim], f"dim_{dim}_hist"
    key, attrs, n = spec["key"], spec["attrs"], wh.buckets
    if opt.fail_on_empty and not keys.where(F.col(key).isNotNull()).take(1):
        raise ValueError(f"empty key slice for {key}: refusing to soft-delete every version")
    adopt_buckets(wh, dim)
    bucket = bucket_of(key, n)
    digest = wh.stage(f"stg_{dim}_digest", scd2.key_digest(keys, key, bucket, attrs if snapshot else None))
    before = wh.read(f"meta_{dim}_digest", schemas.KEY_DIGEST)
    touched = set(range(n))
    if not (opt.restamp_deleted or opt.reopen_returning):
        touched -= {r.bucket for r in digest.join(before, digest.columns, "left_semi").select("bucket").collect()}
        if not snapshot:
            touched |= {r.bucket for r in staged.where(F.col(key).isNotNull()).select(bucket.alias("bucket")).distinct().collect()}
    counts = dict.fromkeys(["new", "changed", "deleted", "reopened", "same", "stale", "returning"], 0)
    if touched:
        mine = bucket.isin(*touched)
        step = scd2.scd2_step(wh.read_buckets(table, spec["schema"], sorted(touched), TIP), staged.where(mine), keys.where(mine), key, attrs,
                              delete_ts, restamp_deleted=opt.restamp_deleted, reopen_returning=opt.reopen_returning)
        seen = Observation()
        step = step.observe(seen, *[F.expr(f"count_if(act = '{a}' AND state = 'tip') AS {a}") for a in counts])
        step = wh.stage(f"stg_{dim}_step", step.withColumn("bucket", bucket))
        counts = {a: int(v or 0) for a, v in seen.get.items()}
        of = lambda cond: [r.bucket for r in step.where(cond).select("bucket").distinct().collect()]
        changed = of(f"act NOT IN ({', '.join(repr(a) for a in scd2.IDLE)})")
        if changed:
            wh.note(dim, step.where("since IS NOT NULL AND state = 'tip'").select(key, "since"))
            wh.write_buckets(table, step.where(F.col("bucket").isin(*changed)).select(*spec["schema"].fieldNames(), "state"), key)
        # a snapshot row that is too old now may count in a later file: its bucket is looked at again
        stale = of("act = 'stale'") if snapshot else []
        wh.replace(f"meta_{dim}_digest", digest.where(~F.col("bucket").isin(*stale)) if stale else digest)
    wh.unstage(f"stg_{dim}_digest", f"stg_{dim}_step")
    return counts


def adopt_buckets(wh: Warehouse, dim: str) -> None:
    """A history that was stored as one table is written by buckets, once."""
    spec, table = schemas.DIMENSIONS[dim], f"dim_{dim}_hist"
    if not wh.has_buckets(table) and wh.current_path(table):
        wh.write_buckets(table, scd2.split_tips(wh.read(table, spec["schema"]), spec["key"], spec["attrs"]), spec["key"], whole=True)


def load_terminal_snapshot(wh: Warehouse, snap: DataFrame, day: dt.date, opt: RunOptions) -> dict:
    """Merge one full snapshot of ``day``. Loading it again changes nothing."""
    snap = wh.stage("stg_terminals", snap)
    counts = merge(wh, "terminals", snap, snap, day, opt, snapshot=True)
    meta = wh.read("meta_load", schemas.META_LOAD)
    wh.replace("meta_load", watermark.advance_watermark(meta, "terminal", snap, seed=dt.datetime(1900, 1, 1)))
    wh.unstage("stg_terminals")
    return counts


def load_source(wh: Warehouse, dim: str, source: DataFrame, table_name: str, load_ts: dt.datetime,
                opt: RunOptions) -> dict:
    """Incremental SCD2 load of accounts / cards / clients from a source table."""
    spec = schemas.DIMENSIONS[dim]
    default = X.DEFAULT_CHANGE_TS_CARDS if dim == "cards" else X.DEFAULT_CHANGE_TS
    meta = wh.read("meta_load", schemas.META_LOAD)
    w = watermark.read_watermark(meta, table_name)
    src_attrs = [a for a in source.columns if a not in (spec["source_key"], "create_dt", "update_dt")]
    seen = None if opt.strict_watermark else wh.read(f"seen_{dim}", schemas.TIES)
    staged = tables.source_changes(source, spec["source_key"], src_attrs, w, default=default,
                                   rename=spec["rename"], seen=seen)
    if spec["source_key"] != spec["key"]:
        staged = staged.withColumnRenamed(spec["source_key"], spec["key"])
    # one read each, changes before keys: what arrives in between is in neither and is taken by the next run
    staged = wh.stage(f"stg_{dim}", staged)
    keys = wh.stage(f"stg_{dim}_keys", tables.key_slice(source, spec["source_key"], spec["key"]))
    counts = merge(wh, dim, staged, keys, load_ts, opt)
    meta = watermark.advance_watermark(meta, table_name, staged)
    wh.replace("meta_load", meta)
    if seen is not None:  # after the watermark: a set of an older second takes nothing away
        w = watermark.read_watermark(wh.read("meta_load", schemas.META_LOAD), table_name)
        names = spec["rename"] or {}
        key, attrs = spec["key"], [names.get(a, a) for a in src_attrs]
        wh.replace(f"seen_{dim}", watermark.tie_set(staged, seen, key, attrs, w))
    wh.unstage(f"stg_{dim}", f"stg_{dim}_keys")
    return counts


def build_report(spark: SparkSession, wh: Warehouse, opt: RunOptions) -> DataFrame:
    """Report rows of this run (all four rules over all stored facts, priority applied)."""
    d = schemas.DIMENSIONS
    owners = temporal.owner_history(wh.read("dim_cards_hist", d["cards"]["schema"]),
                                    wh.read("dim_accounts_hist", d["accounts"]["schema"]),
                                    wh.read("dim_clients_hist", d["clients"]["schema"]),
                                    honour_deleted=opt.honour_deleted_interval)
    if opt.report_since is None:
        tx = wh.read_facts("fact_transactions", schemas.FACT_TRANSACTIONS)
    else:
        # Rules 3-4 look back at most max(gap, span): read from there on. The day
        # filter prunes fact partitions; the time filter is pushed to the scan.
        start = opt.report_since - _lookback(opt)
        tx = (wh.read_facts_with_day("fact_transactions", schemas.FACT_TRANSACTIONS, FACT_DAY)
              .where(F.col(FACT_DAY) >= F.lit(start.date()))
              .where(F.col("trans_date") >= X.ntz(start))
              .select(*schemas.FACT_TRANSACTIONS.fieldNames()))
    return _hits_report(wh, opt, temporal.enrich(tx, owners))


def _hits_report(wh: Warehouse, opt: RunOptions, enriched: DataFrame) -> DataFrame:
    d = schemas.DIMENSIONS
    hits = rules.rule_hits(enriched, wh.read_facts("fact_blacklist", schemas.FACT_BLACKLIST),
                           wh.read("dim_terminals_hist", d["terminals"]["schema"]),
                           gap=opt.city_gap, n=opt.probe_rejects, span=opt.probe_span,
                           honour_deleted=opt.honour_deleted_interval)
    if opt.report_since is not None:
        hits = hits.where(F.col("event_dt") >= X.ntz(opt.report_since))
    return report.fraud_report(hits, opt.report_dt)


def _lookback(opt: RunOptions) -> dt.timedelta:
    return max(opt.city_gap, opt.probe_span)


def _histories(wh: Warehouse) -> list[DataFrame]:
    d = schemas.DIMENSIONS
    return [wh.read(f"dim_{dim}_hist", d[dim]["schema"]) for dim in ("cards", "accounts", "clients")]


def read_owners(wh: Warehouse, buckets: list[int] | None = None) -> DataFrame:
    """The kept owner history (of some key buckets)."""
    return wh.read_buckets(OWNERS, schemas.OWNERS, buckets, TIP).where(f"{temporal.FROM} IS NOT NULL")


def update_owners(wh: Warehouse, moved: DataFrame | None, opt: RunOptions) -> None:
    """The kept owner history after a load: the cards in the stored table ``moved`` (card_num) are intersected anew and replaced
    in their buckets. With ``None`` all cards are."""
    cards, accounts, clients = _histories(wh)
    if moved is None:
        whole = temporal.owner_history(cards, accounts, clients, honour_deleted=opt.honour_deleted_interval)
        wh.write_buckets(OWNERS, whole.withColumn("state", F.lit(TIP)), "card_num", whole=True)
        return
    bucket, mine = bucket_of("card_num", wh.buckets), moved.select("card_num")
    buckets = sorted(r.b for r in mine.select(bucket.alias("b")).distinct().collect())
    if not buckets:
        return
    old = read_owners(wh, buckets).join(mine, "card_num", "left_anti").select(*schemas.OWNERS.fieldNames())
    new = temporal.owner_history(cards.join(mine, "card_num", "left_semi"), accounts, clients, honour_deleted=opt.honour_deleted_interval)
    # a row without a time in every bucket, so that one whose last owner went is written too
    blank = mine.groupBy(bucket.alias("b")).agg(F.min("card_num").alias("card_num")).select("card_num")
    rows = old.unionByName(new).unionByName(blank, allowMissingColumns=True)
    wh.write_buckets(OWNERS, rows.withColumn("state", F.lit(TIP)), "card_num")


def affected_report(spark: SparkSession, wh: Warehouse, opt: RunOptions, notes: dict[str, list[str]]) -> DataFrame | None:
    """Report rows of the operations that the noted loads can have given other hits (None: there is none).

    The owners of cards with a changed card, account or client version are replaced first. Then the operations of all
    affected cards are read, from the days that hold them, and go through the rules with the kept owners.
    """
    read = lambda kind: spark.read.parquet(*notes[kind]) if notes[kind] else None
    cards, accounts, clients = _histories(wh)
    tx, back = wh.read_facts_with_day("fact_transactions", schemas.FACT_TRANSACTIONS, FACT_DAY), _lookback(opt)
    of_owners = dict(card_notes=read("cards"), account_notes=read("accounts"), client_notes=read("clients"))
    if any(v is not None for v in of_owners.values()):
        update_owners(wh, wh.stage("stg_moved", affected.affected_cards(cards, accounts, clients, tx, back, **of_owners, owners_only=True)), opt)
    found = wh.stage("stg_affected", affected.affected_cards(
        cards, accounts, clients, tx, back, **of_owners, terminal_notes=read("terminals"), passport_notes=read("passports"), fact_notes=read("facts")))
    days = affected.affected_days(found, wh.fact_days("fact_transactions"), back)
    if not days:
        return None
    buckets = sorted(r.b for r in found.select(bucket_of("card_num", wh.buckets).alias("b")).distinct().collect())
    tx = tx.where(F.col(FACT_DAY).isin(*[dt.date.fromisoformat(d) for d in days])).select(*schemas.FACT_TRANSACTIONS.fieldNames())
    owners = read_owners(wh, buckets).join(found.select("card_num"), "card_num", "left_semi")
    return _hits_report(wh, opt, temporal.enrich(affected.operations_of(tx, found, back), owners))


def update_report(spark: SparkSession, wh: Warehouse, opt: RunOptions) -> dict:
    """Append this run's new rows and return their number by rule; what was reported before is read for the anti join and not
    written again. The change notes that the run has taken up go when the rows are committed."""
    notes = {kind: wh.notes(kind) for kind in NOTES}
    if opt.report_since is not None:
        candidate = build_report(spark, wh, opt)
    elif opt.full_report or not wh.has_buckets(OWNERS):
        update_owners(wh, None, opt)
        candidate = build_report(spark, wh, opt)
    else:
        candidate = affected_report(spark, wh, opt, notes)
    counts = {}
    if candidate is not None:
        new = report.new_report_rows(wh.read("rep_fraud", schemas.REPORT), candidate).select(*schemas.REPORT.fieldNames())
        seen = Observation()
        wh.append("rep_fraud", new.observe(seen, *[F.expr(f"count_if(event_type = '{k}') AS rule_{k}") for k in range(1, 5)]))
        counts = {k: int(v or 0) for k, v in seen.get.items()}
    if opt.report_since is None:  # a partial report leaves them to the next one
        wh.drop([p for paths in notes.values() for p in paths])
    wh.unstage("stg_affected", "stg_moved")
    return counts


def maintain(wh: Warehouse, opt: RunOptions) -> None:
    """Old versions go, and tables by buckets that many loads have scattered are written as one version."""
    for dim, spec in schemas.DIMENSIONS.items():
        wh.compact(f"dim_{dim}_hist", spec["schema"], spec["key"], opt.compact_after)
        wh.prune(f"dim_{dim}_hist", older_than=opt.keep_seconds)
        wh.prune(f"meta_{dim}_digest", older_than=opt.keep_seconds)
    wh.compact(OWNERS, schemas.OWNERS, "card_num", opt.compact_after)
    for table in (OWNERS, "meta_load", ledger.TABLE):
        wh.prune(table, older_than=opt.keep_seconds)


def run_pipeline(spark: SparkSession, inputs: Inputs, warehouse_root: str,
                 opt: RunOptions | None = None) -> dict:
    """One scheduled run. Returns what was done: files and loads, and the ``counts`` that the writes themselves have taken:
    rows of facts, keys of dimensions by what became of them (stale ones among them), report rows by rule."""
    opt = opt or RunOptions()
    wh = Warehouse(spark, warehouse_root, opt.buckets)
    load_ts = opt.load_ts or dt.datetime.now().replace(microsecond=0)
    done: dict = {"transaction_files": 0, "blacklist_files": 0, "terminal_files": 0, "sources": [], "counts": {}}
    if inputs.files_dir:
        tx_files = files.dated_files(spark, inputs.files_dir, files.PATTERNS["transactions"])
        bl_files = files.dated_files(spark, inputs.files_dir, files.PATTERNS["blacklist"])
        term_files = files.dated_files(spark, inputs.files_dir, files.PATTERNS["terminals"])
    else:
        tx_files = bl_files = term_files = []
    if opt.skip_when_no_files and not (tx_files or bl_files or term_files):
        return done

    def finish(path: str, kind: str) -> None:
        if inputs.archive_dir:
            files.archive_files(spark, [path], inputs.archive_dir)
        done[kind] += 1

    def count(name: str, counts: dict) -> None:
        into = done["counts"].setdefault(name, {})
        for k, v in counts.items():
            into[k] = into.get(k, 0) + v

    exact = opt.on_duplicate == "fail"
    for path, _ in tx_files:
        src = ledger.delivery(wh, "transactions", path, inputs.archive_dir)
        if src is not None:
            staged = files.read_transactions(spark, path, glob=None, strict_amount=not opt.amount_rejects).withColumn(SRC_FILE, F.lit(src))
            rejected = 0
            if opt.amount_rejects:
                staged, bad = split_rejects(staged)
                rejected = _append_rejects(wh, bad, src)
            n = load_transactions(wh, staged, opt.on_duplicate, src)
            stored = ledger.loaded(wh, "transactions", path, src, "fact_transactions", rejected, n if exact else None)
            count("transactions", {"staged": n, "stored": stored, "rejected": rejected})
        finish(path, "transaction_files")
    for path, _ in bl_files:
        src = ledger.delivery(wh, "blacklist", path, inputs.archive_dir)
        if src is not None:
            staged = files.read_blacklist(spark, path, inputs.sheet_format, glob=None).withColumn(SRC_FILE, F.lit(src))
            n = load_blacklist(wh, staged, opt.on_duplicate, src)
            count("blacklist", {"staged": n, "stored": ledger.loaded(wh, "blacklist", path, src, "fact_blacklist", 0, n if exact else None)})
        finish(path, "blacklist_files")
    for path, day in term_files:
        count("terminals", load_terminal_snapshot(wh, files.read_terminals(spark, path, inputs.sheet_format, glob=None), day, opt))
        finish(path, "terminal_files")
    for dim, src in (("accounts", inputs.accounts), ("cards", inputs.cards), ("clients", inputs.clients)):
        if src is not None:
            count(dim, load_source(wh, dim, src, inputs.table_names[dim], load_ts, opt))
            done["sources"].append(dim)
    count("report", update_report(spark, wh, opt))
    maintain(wh, opt)
    return done
