"""Daily run over real dated files (month change), rerun, and the streaming intake."""

import datetime as dt

import pytest

from txnwatch import schemas
from txnwatch.operators.facts import DuplicateKeyError
from txnwatch.plans import pipeline
from txnwatch.plans.warehouse import Warehouse
from txnwatch.streaming import intake

from conftest import rows, ts

TX_HEAD = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def write(path, text):
    path.write_text(text)


def make_files(d):
    d.mkdir(parents=True, exist_ok=True)
    write(d / "transactions_31032021.txt", TX_HEAD +
          "X1;2021-03-31 10:00:00;100,00;C1;WITHDRAW;SUCCESS;T1\n"
          "X2;2021-03-31 10:30:00;50,5;C1;WITHDRAW;SUCCESS;T2\n")
    write(d / "transactions_01042021.txt", TX_HEAD + "X3;2021-04-01 09:00:00;10;C2;PAYMENT;SUCCESS;T1\n")
    write(d / "passport_blacklist_01042021.csv", "date,passport\n2021-04-01,PS2\n2021-03-01,PS9\n")
    write(d / "terminals_31032021.csv", "terminal_id,terminal_type,terminal_city,terminal_address\n"
                                        "T1,ATM,Moscow,a\nT2,ATM,Kazan,b\n")
    write(d / "terminals_01042021.csv", "terminal_id,terminal_type,terminal_city,terminal_address\n"
                                        "T1,ATM,Moscow,a\n")


def sources(spark):
    c = ts("2021-01-01")
    acc = spark.createDataFrame([("A1", dt.date(2021, 3, 30), "K1", c, None), ("A2", dt.date(2022, 1, 1), "K2", c, None)],
                                schemas.SRC_ACCOUNTS)
    cards = spark.createDataFrame([("C1", "A1", c, None), ("C2", "A2", c, None)], schemas.SRC_CARDS)
    cli = spark.createDataFrame([("K1", "L", "F", None, dt.date(1990, 1, 1), "PS1", dt.date(2030, 1, 1), "+7 1", c, None),
                                 ("K2", "L2", "F2", "P2", dt.date(1991, 1, 1), "PS2", dt.date(2030, 1, 1), "+7 2", c, None)],
                                schemas.SRC_CLIENTS)
    return acc, cards, cli


def test_daily_run_rerun_and_duplicates(spark, tmp_path):
    files_dir, arch, wh_root = tmp_path / "in", tmp_path / "archive", str(tmp_path / "wh")
    make_files(files_dir)
    acc, cards, cli = sources(spark)
    inputs = pipeline.Inputs(files_dir=str(files_dir), archive_dir=str(arch), accounts=acc, cards=cards, clients=cli)
    opt = pipeline.RunOptions(report_dt=dt.date(2021, 4, 2), load_ts=ts("2021-04-02"))
    done = pipeline.run_pipeline(spark, inputs, wh_root, opt)
    assert done["transaction_files"] == 2 and done["terminal_files"] == 2
    wh = Warehouse(spark, wh_root)
    rep = rows(wh.read("rep_fraud", schemas.REPORT), "event_dt", "passport", "event_type", "report_dt")
    assert rep == sorted([(ts("2021-03-31 10:00:00"), "PS1", "2", dt.date(2021, 4, 2)),
                          (ts("2021-03-31 10:30:00"), "PS1", "2", dt.date(2021, 4, 2)),
                          (ts("2021-04-01 09:00:00"), "PS2", "1", dt.date(2021, 4, 2))], key=repr)
    term = rows(wh.read("dim_terminals_hist", schemas.DIM_TERMINALS), "terminal_id", "effective_to", "deleted_flag")
    assert (("T2", ts("2021-04-01"), 1)) in term                       # missing on 01.04: soft-deleted
    assert sorted(p.name for p in arch.iterdir()) == [
        "passport_blacklist_01042021.backup", "terminals_01042021.backup", "terminals_31032021.backup",
        "transactions_01042021.backup", "transactions_31032021.backup"]
    # No new file: nothing runs, the report keeps its first report_dt.
    assert pipeline.run_pipeline(spark, inputs, wh_root, opt)["transaction_files"] == 0
    # The same file again fails the load on the unique key (reference behaviour).
    make_files(files_dir)
    with pytest.raises(DuplicateKeyError):
        pipeline.run_pipeline(spark, pipeline.Inputs(files_dir=str(files_dir)), wh_root, opt)


def test_incremental_report_equals_full_report_after_cutoff(spark, tmp_path):
    files_dir, wh_root = tmp_path / "in", str(tmp_path / "wh")
    make_files(files_dir)
    write(files_dir / "transactions_01042021.txt", TX_HEAD +
          "X3;2021-04-01 09:00:00;10;C2;PAYMENT;SUCCESS;T1\n"
          "X4;2021-03-31 23:30:00;10;C1;WITHDRAW;SUCCESS;T1\n"
          "X5;2021-04-01 00:10:00;10;C1;WITHDRAW;SUCCESS;T2\n")
    acc, cards, cli = sources(spark)
    inputs = pipeline.Inputs(files_dir=str(files_dir), accounts=acc, cards=cards, clients=cli)
    opt = pipeline.RunOptions(report_dt=dt.date(2021, 4, 2), load_ts=ts("2021-04-02"))
    pipeline.run_pipeline(spark, inputs, wh_root, opt)
    wh = Warehouse(spark, wh_root)
    cut = ts("2021-04-01 00:00:00")
    full = [r for r in rows(pipeline.build_report(spark, wh, opt)) if r[0] >= cut]
    inc = rows(pipeline.build_report(spark, wh, pipeline.RunOptions(report_dt=dt.date(2021, 4, 2), report_since=cut)))
    assert inc == full and len(inc) > 0


def test_stream_intake_available_now(spark, tmp_path):
    src, wh_root = tmp_path / "in", str(tmp_path / "wh")
    src.mkdir()
    write(src / "transactions_31032021.txt", TX_HEAD + "X1;2021-03-31 10:00:00;1,5;C1;WITHDRAW;SUCCESS;T1\n")
    q = intake.start_transaction_intake(spark, str(src), wh_root, str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    write(src / "transactions_01042021.txt", TX_HEAD + "X2;2021-04-01 10:00:00;2;C1;WITHDRAW;SUCCESS;T1\n"
                                                       "X1;2021-03-31 10:00:00;1,5;C1;WITHDRAW;SUCCESS;T1\n")
    q = intake.start_transaction_intake(spark, str(src), wh_root, str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    facts = Warehouse(spark, wh_root).read_facts("fact_transactions", schemas.FACT_TRANSACTIONS)
    assert rows(facts, "trans_id") == [("X1",), ("X2",)]             # restart: no file twice, no duplicate key


def test_bad_amount_fails_or_goes_to_rejects(spark, tmp_path):
    files_dir, wh_root = tmp_path / "in", str(tmp_path / "wh")
    files_dir.mkdir()
    write(files_dir / "transactions_31032021.txt", TX_HEAD +
          "X1;2021-03-31 10:00:00;1,5;C1;WITHDRAW;SUCCESS;T1\nX2;2021-03-31 10:00:00;abc;C1;WITHDRAW;SUCCESS;T1\n"
          "X3;2021-03-31 10:00:00;;C1;WITHDRAW;SUCCESS;T1\n")
    inputs = pipeline.Inputs(files_dir=str(files_dir))
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, inputs, wh_root, pipeline.RunOptions(report_dt=dt.date(2021, 4, 1)))
    pipeline.run_pipeline(spark, inputs, wh_root, pipeline.RunOptions(report_dt=dt.date(2021, 4, 1), amount_rejects=True))
    wh = Warehouse(spark, wh_root)
    assert rows(wh.read_facts("fact_transactions", schemas.FACT_TRANSACTIONS), "trans_id") == [("X1",)]
    rej = spark.read.parquet(wh.facts_path("rejects_transactions"))
    assert sorted(r["trans_id"] for r in rej.collect()) == ["X2", "X3"]


def test_empty_slice_option(spark):
    from txnwatch.operators import scd2
    hist = spark.createDataFrame([("K", "a", ts("2021-03-01"), ts("2990-12-31"), 0)],
                                 "k string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flag int")
    staged = spark.createDataFrame([], "k string, v string, update_dt timestamp_ntz")
    keys = spark.createDataFrame([], "k string")
    out = rows(scd2.scd2_merge(hist, staged, keys, "k", ["v"], delete_ts=ts("2021-03-02")), "deleted_flag")
    assert out == [(1,)]                                              # D20: everything soft-deleted
    with pytest.raises(ValueError):
        scd2.scd2_merge(hist, staged, keys, "k", ["v"], delete_ts=ts("2021-03-02"), fail_on_empty=True)
