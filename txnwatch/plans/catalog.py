"""Registered queries: each builds one operator's result from the driver tables.

Every query reads whole tables at ``sf_dir`` through ``txnwatch.sources.mapping``
and returns a lazy DataFrame; column names equal those of ``plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch import schemas
from txnwatch.functions import scalars as X
from txnwatch.operators import affected, facts, report, rules, scd2, temporal, watermark
from txnwatch.session import ensure_checkpoint_dir
from txnwatch.sources import mapping as M
from txnwatch.sources import tables
from txnwatch.streaming import lags

# Fixed query parameters (shared with the oracle SQL).
WATERMARK = dt.datetime(2001, 1, 1)
SLICE_DAY = dt.date(2024, 1, 5)
REPORT_DT = dt.date(2024, 2, 1)
EARLIER_REPORT_DT = dt.date(2024, 1, 15)
EARLIER_CUTOFF = dt.datetime(2024, 1, 15)
ACCOUNT_SPLIT = dt.datetime(2023, 1, 1)
INCREMENTAL_DELETE_TS = dt.datetime(2024, 2, 1)
FACTS_EXISTING_BEFORE = dt.datetime(2024, 1, 10)
EARLY_DAY = dt.datetime(2024, 1, 2)
FACTS_STAGED_FROM = dt.datetime(2024, 1, 5)
AS_OF = dt.datetime(2024, 1, 10, 12, 0, 0)
CARD_SPLIT = dt.datetime(2024, 1, 12)
CLIENT_SPLIT = dt.datetime(2024, 1, 1)
WIDE_PROBE_SPAN = dt.timedelta(hours=96)

TERMINAL_ATTRS = ["terminal_type", "terminal_city", "terminal_address"]
ACCOUNT_ATTRS = ["valid_to", "client"]

Query = Callable[[SparkSession, str], DataFrame]


# --- building blocks --------------------------------------------------------

def card_history(spark, d):
    return scd2.scd2_from_changes(M.card_changes(spark, d), "card_num", ["account_num"], "update_dt", order=["seq"])


def account_history(spark, d, before: dt.datetime | None = None):
    ch = M.account_changes(spark, d)
    if before is not None:
        ch = ch.where(F.col("update_dt") < X.ntz(before))
    return scd2.scd2_from_changes(ch, "account_num", ACCOUNT_ATTRS, "update_dt", order=["seq"])


def terminal_history(spark, d, upto: int = 2):
    return scd2.scd2_from_snapshots(M.terminal_snapshots(spark, d, upto), "terminal_id", TERMINAL_ATTRS, "update_dt")


def owners(spark, d):
    return temporal.owner_history(card_history(spark, d), account_history(spark, d), M.client_history(spark, d))


def enriched(spark, d):
    return temporal.enrich(M.transactions(spark, d), owners(spark, d))


def enriched_t(spark, d):
    return temporal.enrich_terminals(enriched(spark, d), terminal_history(spark, d))


def all_rules(spark, d, span=rules.PROBE_SPAN):
    return rules.rule_hits(enriched(spark, d), M.blacklist(spark, d), terminal_history(spark, d), span=span)


def raw_transaction_rows(spark, d):
    """The transactions as the text rows of dated files (decimal comma, file name from the day)."""
    t = M.transactions(spark, d)
    return t.select(
        F.col("trans_id").alias("transaction_id"),
        F.date_format("trans_date", facts.TIMESTAMP_TEXT).alias("transaction_date"),
        F.regexp_replace(F.col("amt").cast("string"), r"\.", ",").alias("amount"),
        "card_num", "oper_type", "oper_result", "terminal",
        F.concat(F.lit("transactions_"), F.date_format("trans_date", "ddMMyyyy"), F.lit(".txt")).alias("file_name"))


FACT_COLS = ["trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result", "terminal"]


# --- queries ----------------------------------------------------------------

def q_stage_transactions(spark, d):
    return facts.stage_transactions(raw_transaction_rows(spark, d))


def q_file_date_parse(spark, d):
    return facts.file_dates(raw_transaction_rows(spark, d))


def q_facts_append(spark, d):
    t = M.transactions(spark, d)
    existing = t.where(F.col("trans_date") < X.ntz(FACTS_EXISTING_BEFORE))
    staged = t.where(F.col("trans_date") >= X.ntz(FACTS_STAGED_FROM))
    # keys that are stored already, dated a day later; and rows without a key, which conflict with nothing
    early = existing.where(F.col("trans_date") < X.ntz(EARLY_DAY))
    moved = early.withColumn("trans_date", F.expr("trans_date + INTERVAL '1' DAY"))
    keyless = early.withColumn("trans_id", F.lit(None).cast("string"))
    staged = staged.unionByName(moved).unionByName(keyless)
    added = facts.append_facts(staged, existing, "trans_id", FACT_COLS, on_duplicate="skip", order=["trans_date"])
    return existing.select(*FACT_COLS).unionByName(added)


def q_daily_slice(spark, d):
    staged = M.blacklist(spark, d).withColumn("update_dt", X.ntz(SLICE_DAY))
    return facts.daily_slice(staged)


def q_full_name(spark, d):
    return M.clients(spark, d).select("client_id", X.full_name().alias("fio"))


def q_change_time(spark, d):
    s = M.incremental_source(spark, d)
    return s.select("account", "create_dt", "update_dt",
                    X.change_time("create_dt", "update_dt").alias("change_ts"),
                    X.change_time("create_dt", "update_dt", X.DEFAULT_CHANGE_TS_CARDS).alias("change_ts_cards"))


def _staged_source(spark, d, w):
    return tables.source_changes(M.incremental_source(spark, d), "account", ACCOUNT_ATTRS, w,
                                 rename={"account": "account_num"})


def q_source_changes(spark, d):
    return _staged_source(spark, d, WATERMARK)


def q_watermark_advance(spark, d):
    meta = spark.createDataFrame([("public", "info.accounts", WATERMARK)],
                                 "schema_name string, table_name string, max_update_dt timestamp_ntz")
    w = watermark.read_watermark(meta, "info.accounts")
    staged = _staged_source(spark, d, w)
    return watermark.advance_watermark(meta, "info.accounts", staged)


def _late_load(spark, d):
    """(source, metadata, watermark, tie set) after a first load that came before the rows with an update time."""
    source = M.incremental_source(spark, d)
    first = tables.source_changes(source.where(F.col("update_dt").isNull() & (F.col("create_dt") <= X.ntz(WATERMARK))),
                                  "account", ACCOUNT_ATTRS, X.SEED_WATERMARK)
    meta = watermark.advance_watermark(watermark.empty_meta(spark), "info.accounts", first)
    w = watermark.read_watermark(meta, "info.accounts")
    none = spark.createDataFrame([], schemas.TIES)
    return source, w, watermark.tie_set(first, none, "account", ACCOUNT_ATTRS, w)


def q_source_changes_late(spark, d):
    source, w, seen = _late_load(spark, d)
    return tables.source_changes(source, "account", ACCOUNT_ATTRS, w, rename={"account": "account_num"}, seen=seen)


def q_watermark_ties(spark, d):
    """The tie set after a second load that read the same second again."""
    source, w, seen = _late_load(spark, d)
    late = tables.source_changes(source.where(F.col("update_dt").isNotNull()), "account", ACCOUNT_ATTRS, w, seen=seen)
    ties = watermark.tie_set(late, seen, "account", ACCOUNT_ATTRS, w)
    return ties.select(F.col("tie_key").alias("account_num"), F.col("tie_second").alias("update_dt"))


def q_scd2_from_changes(spark, d):
    return account_history(spark, d)


def q_scd2_from_changes_cards(spark, d):
    return card_history(spark, d)


def q_current_view(spark, d):
    return scd2.current_view(account_history(spark, d))


def q_as_of(spark, d):
    return scd2.as_of(account_history(spark, d), AS_OF)


def q_scd2_from_snapshots(spark, d):
    return terminal_history(spark, d)


def q_latest_end(spark, d):
    return scd2.latest_end(terminal_history(spark, d), "terminal_id")


def _hist0_snap1(spark, d):
    return terminal_history(spark, d, upto=0), M.terminal_snapshot(spark, d, 1)


def q_new_keys(spark, d):
    h, s = _hist0_snap1(spark, d)
    return scd2.new_keys(h, s, "terminal_id", TERMINAL_ATTRS)


def q_changed_rows(spark, d):
    h, s = _hist0_snap1(spark, d)
    return scd2.changed_rows(h, s, "terminal_id", TERMINAL_ATTRS)


def q_missing_keys(spark, d):
    h, s = _hist0_snap1(spark, d)
    return scd2.missing_keys(h, s, "terminal_id")


def q_scd2_merge_snapshot(spark, d):
    h, s = _hist0_snap1(spark, d)
    return scd2.scd2_merge(h, s, s, "terminal_id", TERMINAL_ATTRS, delete_ts=M.TERMINAL_SNAPSHOT_DATES[1])


def q_scd2_soft_delete(spark, d):
    h, s = _hist0_snap1(spark, d)
    return scd2.soft_delete(h, s, "terminal_id", delete_ts=M.TERMINAL_SNAPSHOT_DATES[1])


def q_scd2_merge_incremental(spark, d):
    ch = M.account_changes(spark, d)
    hist = account_history(spark, d, before=ACCOUNT_SPLIT)
    # at the time of the load every 17th account is gone from the source
    ch = ch.where("CAST(substr(account_num, 2) AS BIGINT) % 17 <> 3")
    later = ch.where(F.col("update_dt") >= X.ntz(ACCOUNT_SPLIT))
    staged = scd2.latest_per_key(later, "account_num", ACCOUNT_ATTRS, "update_dt", order=["seq"])
    return scd2.scd2_merge(hist, staged, ch, "account_num", ACCOUNT_ATTRS, delete_ts=INCREMENTAL_DELETE_TS)


def q_valid_at_card(spark, d):
    return temporal.valid_at(M.transactions(spark, d).select("trans_id", "trans_date", "card_num"),
                             card_history(spark, d), "card_num", "card_num", "trans_date",
                             hist_cols=["account_num"])


def q_valid_at_terminal(spark, d):
    return temporal.valid_at(M.transactions(spark, d).select("trans_id", "trans_date", "terminal"),
                             terminal_history(spark, d), "terminal", "terminal_id", "trans_date",
                             hist_cols=["terminal_city"])


def q_valid_at_card_sweep(spark, d):
    return temporal.valid_at(M.transactions(spark, d).select("trans_id", "trans_date", "card_num"),
                             card_history(spark, d), "card_num", "card_num", "trans_date",
                             hist_cols=["account_num"], strategy="sweep").drop("effective_from", "effective_to")


def q_valid_at_terminal_sweep_left(spark, d):
    return temporal.valid_at(M.transactions(spark, d).select("trans_id", "trans_date", "terminal"),
                             terminal_history(spark, d), "terminal", "terminal_id", "trans_date",
                             hist_cols=["terminal_city"], how="left", strategy="sweep")


def q_owner_history(spark, d):
    return owners(spark, d)


def q_enriched(spark, d):
    return enriched(spark, d)


def q_enriched_terminal(spark, d):
    return enriched_t(spark, d)


def q_rule_passport(spark, d):
    return rules.rule_passport(enriched(spark, d), M.blacklist(spark, d))


def q_rule_agreement(spark, d):
    return rules.rule_agreement(enriched(spark, d))


def q_rule_city_jump(spark, d):
    return rules.rule_city_jump(enriched_t(spark, d))


def q_rule_amount_probe(spark, d):
    return rules.rule_amount_probe(enriched_t(spark, d))


def q_rule_amount_probe_wide(spark, d):
    return rules.rule_amount_probe(enriched_t(spark, d), span=WIDE_PROBE_SPAN)


def q_card_rules_stream(spark, d):
    """Rules 3 and 4 on a stream over the operations, run until all its files are read: what the watermark has reached."""
    folder = f"{ensure_checkpoint_dir(spark)}/card_rules-{uuid.uuid4().hex}"
    hits = lags.card_rule_stream(M.transactions(spark, d, stream=True), owners(spark, d), terminal_history(spark, d), span=WIDE_PROBE_SPAN)
    lags.start_card_rules(hits, f"{folder}/hits", f"{folder}/state").awaitTermination()
    return spark.read.schema(hits.schema).parquet(f"{folder}/hits")


def q_fraud_report(spark, d):
    return report.fraud_report(all_rules(spark, d), REPORT_DT)


def q_fraud_report_wide(spark, d):
    return report.fraud_report(all_rules(spark, d, WIDE_PROBE_SPAN), REPORT_DT)


def q_report_incremental(spark, d):
    # The earlier run knew rule 2 only, up to the cut-off: its rows stay as first reported, though rule 1 hits some now.
    hits = rules.rule_agreement(enriched(spark, d)).where(F.col("event_dt") < X.ntz(EARLIER_CUTOFF))
    earlier = report.fraud_report(hits, EARLIER_REPORT_DT)
    return report.append_report(earlier, report.fraud_report(all_rules(spark, d), REPORT_DT))


def client_versions(spark, d, before: dt.datetime | None = None):
    ch = M.client_changes(spark, d)
    if before is not None:
        ch = ch.where(F.col("update_dt") < X.ntz(before))
    return scd2.scd2_from_changes(ch, "client_id", M.CLIENT_ATTRS, "update_dt")


def _step(hist, staged, keys, key, attrs, delete_ts):
    """A load on the latest versions: the rows of the whole history after it, and the step itself."""
    parts = scd2.split_tips(hist, key, attrs)
    step = scd2.scd2_step(parts.where("state = 'tip'").drop("state"), staged, keys, key, attrs, delete_ts)
    return parts.where("state = 'past'").drop("state").unionByName(step.drop("state", "act", "since")), step


def q_scd2_from_changes_clients(spark, d):
    return client_versions(spark, d)


def q_scd2_merge_cards(spark, d):
    # at the time of the load every 13th card is gone from the source
    ch = M.card_changes(spark, d).where("CAST(substr(card_num, 2) AS BIGINT) % 13 <> 5")
    hist = scd2.scd2_from_changes(M.card_changes(spark, d).where(F.col("update_dt") < X.ntz(CARD_SPLIT)), "card_num", ["account_num"], "update_dt", order=["seq"])
    staged = scd2.latest_per_key(ch.where(F.col("update_dt") >= X.ntz(CARD_SPLIT)), "card_num", ["account_num"], "update_dt", order=["seq"])
    return _step(hist, staged, ch, "card_num", ["account_num"], INCREMENTAL_DELETE_TS)[0]


def q_scd2_merge_clients(spark, d):
    ch = M.client_changes(spark, d).where("CAST(substr(client_id, 2) AS BIGINT) % 19 <> 7")
    staged = ch.where(F.col("update_dt") >= X.ntz(CLIENT_SPLIT))
    return _step(client_versions(spark, d, CLIENT_SPLIT), staged, ch, "client_id", M.CLIENT_ATTRS, INCREMENTAL_DELETE_TS)[0]


def q_owner_history_versions(spark, d):
    return temporal.owner_history(card_history(spark, d), account_history(spark, d), client_versions(spark, d))


def q_report_affected(spark, d):
    """What the report gains by a late load of clients: the rules over the cards that it affects, less what was reported."""
    cards, accounts, terminals = card_history(spark, d), account_history(spark, d), terminal_history(spark, d)
    tx, blacklist, back = M.transactions(spark, d), M.blacklist(spark, d), max(rules.CITY_GAP, rules.PROBE_SPAN)
    before = client_versions(spark, d, CLIENT_SPLIT)
    staged = M.client_changes(spark, d).where(F.col("update_dt") >= X.ntz(CLIENT_SPLIT))
    after, step = _step(before, staged, None, "client_id", M.CLIENT_ATTRS, INCREMENTAL_DELETE_TS)
    found = affected.affected_cards(cards, accounts, after, tx, back, client_notes=step.where("state = 'tip'").select("client_id", "since"))
    owned = temporal.owner_history(cards.join(found.select("card_num"), "card_num", "left_semi"), accounts, after)
    rows = temporal.enrich(affected.operations_of(tx, found, back), owned)
    gained = report.fraud_report(rules.rule_hits(rows, blacklist, terminals), REPORT_DT)
    earlier = rules.rule_hits(temporal.enrich(tx, temporal.owner_history(cards, accounts, before)), blacklist, terminals)
    return report.new_report_rows(report.fraud_report(earlier, EARLIER_REPORT_DT), gained)


def q_valid_at_card_slots(spark, d):
    return temporal.valid_at(M.transactions(spark, d).select("trans_id", "trans_date", "card_num"),
                             card_history(spark, d), "card_num", "card_num", "trans_date",
                             hist_cols=["account_num"], strategy="slots", hot_rows=10)


def q_valid_at_terminal_slots_left(spark, d):
    return temporal.valid_at(M.transactions(spark, d).select("trans_id", "trans_date", "terminal"),
                             terminal_history(spark, d), "terminal", "terminal_id", "trans_date",
                             hist_cols=["terminal_city"], how="left", strategy="slots", hot_rows=10)


QUERIES: dict[str, Query] = {
    "scd2_from_changes_clients": q_scd2_from_changes_clients,
    "scd2_merge_cards": q_scd2_merge_cards,
    "scd2_merge_clients": q_scd2_merge_clients,
    "owner_history_versions": q_owner_history_versions,
    "report_affected": q_report_affected,
    "valid_at_card_slots": q_valid_at_card_slots,
    "valid_at_terminal_slots_left": q_valid_at_terminal_slots_left,
    "stage_transactions": q_stage_transactions,
    "file_date_parse": q_file_date_parse,
    "facts_append": q_facts_append,
    "daily_slice": q_daily_slice,
    "full_name": q_full_name,
    "change_time": q_change_time,
    "source_changes": q_source_changes,
    "watermark_advance": q_watermark_advance,
    "source_changes_late": q_source_changes_late,
    "watermark_ties": q_watermark_ties,
    "card_rules_stream": q_card_rules_stream,
    "scd2_from_changes": q_scd2_from_changes,
    "scd2_from_changes_cards": q_scd2_from_changes_cards,
    "current_view": q_current_view,
    "as_of": q_as_of,
    "scd2_from_snapshots": q_scd2_from_snapshots,
    "latest_end": q_latest_end,
    "new_keys": q_new_keys,
    "changed_rows": q_changed_rows,
    "missing_keys": q_missing_keys,
    "scd2_merge_snapshot": q_scd2_merge_snapshot,
    "scd2_soft_delete": q_scd2_soft_delete,
    "scd2_merge_incremental": q_scd2_merge_incremental,
    "valid_at_card": q_valid_at_card,
    "valid_at_terminal": q_valid_at_terminal,
    "valid_at_card_sweep": q_valid_at_card_sweep,
    "valid_at_terminal_sweep_left": q_valid_at_terminal_sweep_left,
    "owner_history": q_owner_history,
    "enriched": q_enriched,
    "enriched_terminal": q_enriched_terminal,
    "rule_passport": q_rule_passport,
    "rule_agreement": q_rule_agreement,
    "rule_city_jump": q_rule_city_jump,
    "rule_amount_probe": q_rule_amount_probe,
    "rule_amount_probe_wide": q_rule_amount_probe_wide,
    "fraud_report": q_fraud_report,
    "fraud_report_wide": q_fraud_report_wide,
    "report_incremental": q_report_incremental,
}
