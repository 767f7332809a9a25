"""The report over affected cards equals a full re-scan after every kind of late load; loads touch only what they change."""

import datetime as dt
import random

import pytest

from txnwatch import schemas
from txnwatch.operators import affected, scd2, temporal
from txnwatch.plans import pipeline
from txnwatch.plans.warehouse import TIP, Warehouse

from conftest import rows, ts

TX_HEAD = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
TERM_HEAD = "terminal_id,terminal_type,terminal_city,terminal_address\n"
C0 = ts("2021-01-01")


class Bank:
    """Files and source tables of a small bank, changed from run to run."""

    def __init__(self, spark, root, rng):
        self.spark, self.root, self.rng, self.n = spark, root, rng, 0
        self.cards = {f"C{i}": [f"A{i % 5}", C0, None] for i in range(8)}
        self.accounts = {f"A{i}": [dt.date(2030, 1, 1), f"K{i % 4}", C0, None] for i in range(5)}
        self.clients = {f"K{i}": ["L", f"F{i}", None, dt.date(1990, 1, 1), f"PS{i}" if i else None, dt.date(2030, 1, 1), f"+7 {i}  ", C0, None] for i in range(4)}

    def sources(self):
        make = lambda d, s: self.spark.createDataFrame([(k, *v) for k, v in d.items()], s)
        return dict(accounts=make(self.accounts, schemas.SRC_ACCOUNTS), cards=make(self.cards, schemas.SRC_CARDS), clients=make(self.clients, schemas.SRC_CLIENTS))

    def transactions(self, into, day, k=25):
        lines = []
        for _ in range(k):
            self.n += 1
            t = dt.datetime.combine(day, dt.time(10)) + dt.timedelta(minutes=self.rng.randrange(180))
            lines.append(f"X{self.n};{t};{self.rng.randrange(1, 50)};C{self.rng.randrange(9)};WITHDRAW;{self.rng.choice(['SUCCESS', 'REJECT', 'REJECT'])};T{self.rng.randrange(4)}\n")
        (into / f"transactions_{day:%d%m%Y}.txt").write_text(TX_HEAD + "".join(lines))

    def terminals(self, into, day, cities):
        (into / f"terminals_{day:%d%m%Y}.csv").write_text(TERM_HEAD + "".join(f"{t},ATM,{c},a\n" for t, c in cities.items()))


def day(n):
    return dt.date(2021, 3, n)


def test_report_over_affected_cards_equals_full_rescan(spark, tmp_path):
    rng = random.Random(11)
    bank = Bank(spark, tmp_path, rng)
    city = {"T0": "M", "T1": "N", "T2": "M", "T3": "O"}

    def start(into):
        bank.transactions(into, day(1))
        bank.transactions(into, day(2))
        bank.terminals(into, day(1), city)

    def late_owners(into):          # an account that ended long ago, a card that changes its account, a client's passport
        bank.accounts["A1"] = [dt.date(2021, 2, 1), "K1", C0, ts("2021-03-01 11:00:00")]
        bank.cards["C3"] = ["A0", C0, ts("2021-03-02 10:30:00")]
        bank.clients["K2"][5] = dt.date(2021, 1, 31)
        bank.clients["K2"][-1] = ts("2021-03-02 00:00:00")
        bank.transactions(into, day(4))

    def late_terminals(into):       # a city changes before operations that are stored already, one terminal goes
        bank.terminals(into, day(2), {"T0": "M", "T1": "M", "T2": "N"})

    def blacklist_and_gone(into):   # a listed passport, an account and a card that are gone, operations of an earlier day
        (into / "passport_blacklist_03032021.csv").write_text("date,passport\n2021-03-03,PS1\n2021-03-01,PS3\n")
        del bank.accounts["A4"], bank.cards["C6"]
        bank.transactions(into, day(3))

    def late_facts(into):
        bank.transactions(into, day(5), 5)
        (into / "transactions_06032021.txt").write_text(TX_HEAD + "".join(
            f"Y{k};2021-03-04 {h:02d}:{m:02d}:00;{a};C2;WITHDRAW;{r};T2\n" for k, (h, m, a, r) in enumerate(
                [(9, 1, 40, "REJECT"), (9, 3, 30, "REJECT"), (9, 5, 20, "REJECT"), (9, 7, 10, "SUCCESS"), (12, 5, 3, "SUCCESS")])))

    root, gained, reported = str(tmp_path / "wh"), [], set()
    for k, change in enumerate([start, late_owners, late_terminals, blacklist_and_gone, late_facts]):
        into = tmp_path / f"in{k}"
        into.mkdir()
        change(into)
        opt = pipeline.RunOptions(report_dt=day(10 + k), load_ts=ts(f"2021-03-{10 + k} 00:00:00"), buckets=5)
        done = pipeline.run_pipeline(spark, pipeline.Inputs(files_dir=str(into), **bank.sources()), root, opt)
        wh = Warehouse(spark, root, 5)
        now = {r[:5] for r in rows(wh.read("rep_fraud", schemas.REPORT))}
        full = [r[:5] for r in rows(pipeline.build_report(spark, wh, opt))]  # all four rules over all stored facts
        keyed = {r[:2] for r in reported if r[1] is not None}
        want = {r for r in full if (r[:2] not in keyed if r[1] is not None else r not in reported)}
        assert now - reported == want
        assert sum(done["counts"]["report"].values()) == len(want)
        gained.append(len(want))
        reported = now
        hist = [wh.read(f"dim_{d}_hist", schemas.DIMENSIONS[d]["schema"]) for d in ("cards", "accounts", "clients")]
        assert rows(pipeline.read_owners(wh)) == rows(temporal.owner_history(*hist).select(*schemas.OWNERS.fieldNames()))
        assert not any(wh.notes(kind) for kind in pipeline.NOTES)
    assert all(gained)  # every kind of load had something to report


def test_a_report_that_died_is_made_up_for(spark, tmp_path, monkeypatch):
    bank, root = Bank(spark, tmp_path, random.Random(5)), str(tmp_path / "wh")
    opt = pipeline.RunOptions(report_dt=day(9), load_ts=ts("2021-03-09"), buckets=4)
    for k in range(3):
        into = tmp_path / f"in{k}"
        into.mkdir()
        bank.transactions(into, day(k + 1))
        bank.terminals(into, day(k + 1), {"T0": "M", "T1": "N", "T2": "O"})
        if k == 1:
            bank.accounts["A1"] = [dt.date(2021, 2, 1), "K1", C0, ts("2021-03-01 10:30:00")]
        inputs = pipeline.Inputs(files_dir=str(into), archive_dir=str(tmp_path / "arch"), **bank.sources())
        if k == 1:
            with monkeypatch.context() as m:
                m.setattr(pipeline.report, "new_report_rows", lambda *a: (_ for _ in ()).throw(OSError("gone")))
                with pytest.raises(OSError):
                    pipeline.run_pipeline(spark, inputs, root, opt)
        else:
            pipeline.run_pipeline(spark, inputs, root, opt)
    wh = Warehouse(spark, root, 4)
    reported = rows(wh.read("rep_fraud", schemas.REPORT))
    assert reported == rows(pipeline.build_report(spark, wh, opt)) and reported


def test_days_and_operations_of_affected_cards(spark):
    found = spark.createDataFrame([("C1", ts("2021-03-03 00:30:00"), ts("2021-03-03 05:00:00")), ("C2", ts("2021-03-06 12:00:00"), ts("2990-12-31"))], affected.OUT)
    days = [f"2021-03-{d:02d}" for d in range(1, 9)]
    assert affected.affected_days(found, days, dt.timedelta(hours=1)) == [days[1], days[2], *days[5:]]
    assert affected.affected_days(found, [], dt.timedelta(hours=1)) == [] and affected.affected_days(found.limit(0), days, dt.timedelta(0)) == []
    ops = [("C1", ts("2021-03-02 23:29:00")), ("C1", ts("2021-03-02 23:30:00")), ("C1", ts("2021-03-03 05:00:00")), ("C1", ts("2021-03-03 05:00:01")),
           ("C2", ts("2021-03-07")), ("C3", ts("2021-03-07")), (None, ts("2021-03-07")), ("C2", None)]
    got = rows(affected.operations_of(spark.createDataFrame(ops, "card_num string, trans_date timestamp_ntz"), found, dt.timedelta(hours=1)))
    assert got == sorted([ops[1], ops[2], ops[4]], key=repr)


def test_other_days_are_not_read(spark, tmp_path):
    bank, root = Bank(spark, tmp_path, random.Random(2)), str(tmp_path / "wh")
    into = tmp_path / "in"
    into.mkdir()
    for n in range(1, 6):
        bank.transactions(into, day(n), 4)
    opt = pipeline.RunOptions(report_dt=day(9), load_ts=ts("2021-03-09"), buckets=4)
    pipeline.run_pipeline(spark, pipeline.Inputs(files_dir=str(into), **bank.sources()), root, opt)
    wh = Warehouse(spark, root, 4)
    more = tmp_path / "more"
    more.mkdir()
    bank.transactions(more, day(6), 4)
    staged = pipeline.files.read_transactions(spark, str(more)).withColumn("src_file", pipeline.F.lit("x"))
    pipeline.load_transactions(wh, staged, src="x")
    plan = pipeline.affected_report(spark, wh, opt, {k: wh.notes(k) for k in pipeline.NOTES})._jdf.queryExecution().optimizedPlan().toString()
    assert "2021-03-06" in plan and "2021-03-04" not in plan


def test_only_touched_buckets_are_written(spark, tmp_path):
    n = 200
    src = {f"A{i}": [dt.date(2030, 1, 1), f"K{i}", C0, None] for i in range(n)}
    wh, opt = Warehouse(spark, str(tmp_path / "wh"), 64), pipeline.RunOptions()
    frame = lambda: spark.createDataFrame([(k, *v) for k, v in src.items()], schemas.SRC_ACCOUNTS)
    first = pipeline.load_source(wh, "accounts", frame(), "bank.accounts", ts("2021-02-01"), opt)
    assert first["new"] == n
    want = wh.read("dim_accounts_hist", schemas.DIM_ACCOUNTS).collect()
    src["A7"][0], src["A7"][-1] = dt.date(2031, 1, 1), ts("2021-02-05")
    src["A9"][-1] = ts("2021-02-05")           # touched, but the same
    src["N1"] = [dt.date(2031, 1, 1), "K1", ts("2021-02-03"), None]
    del src["A11"]
    counts = pipeline.load_source(wh, "accounts", frame(), "bank.accounts", ts("2021-02-10"), opt)
    assert {k: v for k, v in counts.items() if v and k != "same"} == {"new": 1, "changed": 1, "deleted": 1}
    last = wh._bucket_versions("dim_accounts_hist")[0]
    keys = spark.createDataFrame([("A7",), ("N1",), ("A11",)], "k string").select(pipeline.bucket_of("k", 64).alias("b")).distinct().collect()
    assert sorted(wh._names(f"{last}/state=tip")) == sorted(f"bucket={r.b}" for r in keys)
    assert len(wh._names(f"{last}/state=past")) == 1   # only A7 has a version that ended
    staged = spark.createDataFrame([("A7", dt.date(2031, 1, 1), "K7", ts("2021-02-05")), ("A9", dt.date(2030, 1, 1), "K9", ts("2021-02-05")),
                                    ("N1", dt.date(2031, 1, 1), "K1", ts("2021-02-03"))], "account_num string, valid_to date, client string, update_dt timestamp_ntz")
    keys = frame().selectExpr("account AS account_num")
    merged = scd2.scd2_merge(spark.createDataFrame(want, schemas.DIM_ACCOUNTS), staged, keys, "account_num", ["valid_to", "client"], ts("2021-02-10"))
    assert rows(wh.read("dim_accounts_hist", schemas.DIM_ACCOUNTS)) == rows(merged.select(*schemas.DIM_ACCOUNTS.fieldNames()))
    # nothing new: nothing is read or written
    assert sum(pipeline.load_source(wh, "accounts", frame(), "bank.accounts", ts("2021-02-11"), opt).values()) == 0
    assert wh._bucket_versions("dim_accounts_hist")[0] == last
    # scattered versions are put together and the old ones go
    assert wh.compact("dim_accounts_hist", schemas.DIM_ACCOUNTS, "account_num", 1) and not wh.compact("dim_accounts_hist", schemas.DIM_ACCOUNTS, "account_num", 1)
    assert wh.prune("dim_accounts_hist", older_than=-1) == 2
    assert rows(wh.read("dim_accounts_hist", schemas.DIM_ACCOUNTS)) == rows(merged.select(*schemas.DIM_ACCOUNTS.fieldNames()))
    assert wh.read_buckets("dim_accounts_hist", schemas.DIM_ACCOUNTS, state=TIP).count() == n + 1


def test_histories_stored_whole_are_adopted(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), 3)
    old = spark.createDataFrame([("T1", "ATM", "M", "a", ts("2021-01-01"), ts("2021-01-31 23:59:59"), 0), ("T1", "ATM", "N", "a", ts("2021-02-01"), ts("2990-12-31"), 0)],
                                schemas.DIM_TERMINALS)
    wh.replace("dim_terminals_hist", old)
    snap = spark.createDataFrame([("T1", "ATM", "O", "a", ts("2021-03-01")), ("T2", "ATM", "O", "a", ts("2021-03-01"))], schemas.STG_TERMINALS)
    pipeline.load_terminal_snapshot(wh, snap, day(1), pipeline.RunOptions())
    got = rows(wh.read("dim_terminals_hist", schemas.DIM_TERMINALS))
    assert got == rows(scd2.scd2_merge(old, snap, snap, "terminal_id", ["terminal_type", "terminal_city", "terminal_address"], day(1)).select(
        *schemas.DIM_TERMINALS.fieldNames()))


def test_stale_snapshot_rows_count_and_are_looked_at_again(spark, tmp_path):
    wh, opt = Warehouse(spark, str(tmp_path / "wh"), 3), pipeline.RunOptions()
    snap = lambda d, c: spark.createDataFrame([("T1", "ATM", c, "a", ts(f"2021-03-{d:02d}"))], schemas.STG_TERMINALS)
    assert pipeline.load_terminal_snapshot(wh, snap(5, "M"), day(5), opt)["new"] == 1
    assert pipeline.load_terminal_snapshot(wh, snap(4, "N"), day(4), opt)["stale"] == 1   # an older file comes late: counted, ignored
    assert pipeline.load_terminal_snapshot(wh, snap(6, "N"), day(6), opt)["changed"] == 1  # the same rows, now newer
    assert sum(pipeline.load_terminal_snapshot(wh, snap(6, "N"), day(6), opt).values()) == 0
