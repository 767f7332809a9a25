"""The load path under change, failure and odd input: staging, per-file commits, keys, headers, archive, sweep joins."""

import datetime as dt

import pytest

from txnwatch import schemas
from txnwatch.operators import facts, temporal
from txnwatch.operators.facts import DuplicateKeyError
from txnwatch.plans import pipeline
from txnwatch.plans.warehouse import Warehouse
from txnwatch.sources import files
from txnwatch.streaming import intake

from conftest import rows, ts

TX_HEAD = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
TERM_HEAD = "terminal_id,terminal_type,terminal_city,terminal_address\n"


def tx(path, *lines):
    path.write_text(TX_HEAD + "".join(f"{x};{d} 10:00:00;1,5;C1;WITHDRAW;SUCCESS;T1\n" for x, d in lines))


class Moving:
    """A source table that gets a row between two evaluations, as a database read twice does."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def add(self, account, day):
        row = [(account, dt.date(2030, 1, 1), "K1", ts(f"2021-01-{day:02d}"), None)]
        self.spark.createDataFrame(row, schemas.SRC_ACCOUNTS).write.mode("append").parquet(self.path)

    def read(self):
        return self.spark.read.schema(schemas.SRC_ACCOUNTS).parquet(self.path)


def test_staging_is_one_copy(spark, tmp_path, monkeypatch):
    source, wh = Moving(spark, tmp_path / "src"), Warehouse(spark, str(tmp_path / "wh"))
    source.add("A1", 1)
    first = Warehouse.stage

    def stage(self, table, df):
        out = first(self, table, df)
        if table == "stg_accounts" and not source_late:
            source_late.append(1)
            source.add("A2", 5)  # arrives after the changes were read
        return out

    source_late = []
    monkeypatch.setattr(Warehouse, "stage", stage)
    for _ in range(2):
        pipeline.load_source(wh, "accounts", source.read(), "bank.accounts", ts("2021-02-01"), pipeline.RunOptions())
    hist = wh.read("dim_accounts_hist", schemas.DIM_ACCOUNTS)
    assert rows(hist, "account_num", "deleted_flag") == [("A1", 0), ("A2", 0)]


def test_broken_file_does_not_block_the_next_run(spark, tmp_path):
    src, arch, root = tmp_path / "in", tmp_path / "arch", str(tmp_path / "wh")
    src.mkdir()
    tx(src / "transactions_01032021.txt", ("X1", "2021-03-01"))
    (src / "terminals_01032021.csv").write_text("terminal_id,terminal_city\nT1,Moscow\n")
    inputs = pipeline.Inputs(files_dir=str(src), archive_dir=str(arch))
    opt = pipeline.RunOptions(report_dt=dt.date(2021, 3, 2))
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, inputs, root, opt)
    assert [p.name for p in arch.iterdir() if p.suffix == ".backup"] == ["transactions_01032021.backup"]
    (src / "terminals_01032021.csv").write_text(TERM_HEAD + "T1,ATM,Moscow,a\n")
    done = pipeline.run_pipeline(spark, inputs, root, opt)
    wh = Warehouse(spark, root)
    assert done["terminal_files"] == 1 and done["transaction_files"] == 0
    assert rows(wh.read_facts("fact_transactions", schemas.FACT_TRANSACTIONS), "trans_id") == [("X1",)]
    assert rows(wh.read("dim_terminals_hist", schemas.DIM_TERMINALS), "terminal_id") == [("T1",)]


def test_death_between_commit_and_archive(spark, tmp_path, monkeypatch):
    src, arch, root = tmp_path / "in", tmp_path / "arch", str(tmp_path / "wh")
    src.mkdir()
    tx(src / "transactions_01032021.txt", ("X1", "2021-03-01"))
    inputs, opt = pipeline.Inputs(files_dir=str(src), archive_dir=str(arch)), pipeline.RunOptions(report_dt=dt.date(2021, 3, 2))
    with monkeypatch.context() as m:
        m.setattr(files, "archive_files", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            pipeline.run_pipeline(spark, inputs, root, opt)
    assert pipeline.run_pipeline(spark, inputs, root, opt)["transaction_files"] == 1
    assert rows(Warehouse(spark, root).read_facts("fact_transactions", schemas.FACT_TRANSACTIONS), "trans_id") == [("X1",)]
    # the same name once more is a new delivery: it fails on the key and stays
    tx(src / "transactions_01032021.txt", ("X1", "2021-03-01"))
    with pytest.raises(DuplicateKeyError):
        pipeline.run_pipeline(spark, inputs, root, opt)


def test_archive_failure_is_raised(spark, tmp_path):
    (tmp_path / "arch").mkdir()
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "arch" / "a.backup").write_text("old")
    with pytest.raises(OSError):
        files.archive_files(spark, [str(tmp_path / "a.txt")], str(tmp_path / "arch"))
    assert (tmp_path / "a.txt").exists()


def test_key_is_unique_over_all_days(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "wh")
    src.mkdir()
    tx(src / "transactions_01032021.txt", ("X1", "2021-03-01"))
    pipeline.run_pipeline(spark, pipeline.Inputs(files_dir=str(src)), root, pipeline.RunOptions(report_dt=dt.date(2021, 3, 2)))
    again = tmp_path / "again"
    again.mkdir()
    tx(again / "transactions_02032021.txt", ("X1", "2021-03-02"), ("X2", "2021-03-02"))
    with pytest.raises(DuplicateKeyError):
        pipeline.run_pipeline(spark, pipeline.Inputs(files_dir=str(again)), root, pipeline.RunOptions())
    pipeline.run_pipeline(spark, pipeline.Inputs(files_dir=str(again)), root,
                          pipeline.RunOptions(on_duplicate="skip", report_dt=dt.date(2021, 3, 2)))
    stored = Warehouse(spark, root).read_facts("fact_transactions", schemas.FACT_TRANSACTIONS)
    assert rows(stored, "trans_id") == [("X1",), ("X2",)]


def test_null_keys_never_conflict(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 2), ("a", 1)], "k string, v int")
    old = spark.createDataFrame([(None, 9), ("b", 1)], "k string, v int")
    assert rows(facts.append_facts(df, old, "k", ["k", "v"], "skip")) == sorted([(None, 1), (None, 1), ("a", 1)], key=repr)
    single = df.where("k IS NULL OR v = 2")
    assert facts.append_facts(single, old, "k", ["k", "v"], "fail").count() == 3
    with pytest.raises(DuplicateKeyError):
        facts.append_facts(df, old, "k", ["k", "v"], "fail")


REORDERED = "transaction_id;transaction_date;oper_type;amount;card_num;oper_result;terminal\nX1;2021-03-01 10:00:00;WITHDRAW;10,5;777;SUCCESS;T1\n"
SHORT = TX_HEAD + "X1;2021-03-01 10:00:00;1,5;C1;WITHDRAW;SUCCESS\n"


@pytest.mark.parametrize("text", [REORDERED, SHORT])
def test_wrong_header_and_short_rows_fail_in_batch_and_stream(spark, tmp_path, text):
    src = tmp_path / "in"
    src.mkdir()
    (src / "transactions_01032021.txt").write_text(text)
    with pytest.raises(Exception):
        files.read_transactions(spark, str(src)).collect()
    with pytest.raises(Exception):
        intake.start_transaction_intake(spark, str(src), str(tmp_path / "wh"), str(tmp_path / "ck")).awaitTermination(120)


def test_blacklist_and_terminal_streams(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "wh")
    src.mkdir()
    (src / "passport_blacklist_01042021.csv").write_text("date,passport\n2021-04-01,PS2\n2021-03-01,PS9\n")
    (src / "terminals_01042021.csv").write_text(TERM_HEAD + "T1,ATM,Moscow,a\n")
    (src / "terminals_31032021.csv").write_text(TERM_HEAD + "T1,ATM,Moscow,a\nT2,ATM,Kazan,b\n")
    intake.start_blacklist_intake(spark, str(src), root, str(tmp_path / "c1")).awaitTermination(120)
    intake.start_terminal_intake(spark, str(src), root, str(tmp_path / "c2")).awaitTermination(120)
    wh = Warehouse(spark, root)
    assert rows(wh.read_facts("fact_blacklist", schemas.FACT_BLACKLIST), "passport_num") == [("PS2",)]
    hist = rows(wh.read("dim_terminals_hist", schemas.DIM_TERMINALS), "terminal_id", "effective_to", "deleted_flag")
    assert ("T2", ts("2021-04-01"), 1) in hist and len(hist) == 2


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sweep_equals_join_with_null_keys_and_times(spark, how):
    ev = spark.createDataFrame([("a", ts("2021-01-02"), 1), (None, ts("2021-01-02"), 2), ("a", None, 3), ("z", ts("2021-01-02"), 4)],
                               "k string, t timestamp_ntz, n int")
    hist = spark.createDataFrame([("a", "v", ts("2021-01-01"), ts("2021-01-03"), 0), (None, "w", ts("2021-01-01"), ts("2021-01-03"), 0)],
                                 "k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flag int")
    got = [rows(temporal.valid_at(ev, hist, "k", "k", "t", ["v"], how=how, strategy=s)) for s in ("join", "sweep")]
    assert got[0] == got[1] and len(got[0]) == (4 if how == "left" else 1)


def test_prune_keeps_new_and_needed_versions(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    df = spark.createDataFrame([(1,)], "a int")
    for _ in range(5):
        wh.replace("t", df)
    assert wh.prune("t", keep=2) == 0 and wh.prune("t", keep=2, older_than=-1) == 3 and wh.read("t", df.schema).count() == 1
