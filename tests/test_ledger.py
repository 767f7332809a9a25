"""Files are loaded once and whole, whatever dies on the way."""

import datetime as dt

import pytest

from txnwatch import schemas
from txnwatch.operators.facts import DuplicateKeyError
from txnwatch.plans import ledger, pipeline
from txnwatch.plans.warehouse import Warehouse

from conftest import rows

TX_HEAD = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
LINES = [f"X{i};2021-03-0{1 + i % 3} 10:00:{i:02d};1,5;C{i % 4};WITHDRAW;SUCCESS;T1\n" for i in range(30)]
LINES += [";2021-03-01 11:00:00;2,5;C1;WITHDRAW;SUCCESS;T1\n"] * 3 + [";2021-03-02 11:00:00;2,5;C1;WITHDRAW;SUCCESS;T1\n"]


def stored(wh):
    return rows(wh.read_facts("fact_transactions", schemas.FACT_TRANSACTIONS), "trans_id", "trans_date", "amt")


@pytest.mark.parametrize("mode", ["fail", "skip"])
def test_a_half_written_append_is_completed(spark, tmp_path, monkeypatch, mode):
    src, arch, root = tmp_path / "in", tmp_path / "arch", str(tmp_path / "wh")
    src.mkdir()
    (src / "transactions_01032021.txt").write_text(TX_HEAD + "".join(LINES))
    inputs, opt = pipeline.Inputs(files_dir=str(src), archive_dir=str(arch)), pipeline.RunOptions(report_dt=dt.date(2021, 3, 4), on_duplicate=mode)
    wh = Warehouse(spark, root)
    with monkeypatch.context() as m:  # the run dies after the append, before the ledger
        m.setattr(ledger, "loaded", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            pipeline.run_pipeline(spark, inputs, root, opt)
    whole = stored(wh)
    assert len(whole) == len(LINES)
    parts = sorted((tmp_path / "wh" / "fact_transactions" / "data").glob("day=*/*.parquet"))
    assert len(parts) > 2
    for p in parts[::2]:  # half of its part files had been moved when it died
        p.unlink()
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
    assert 0 < len(stored(wh)) < len(whole)
    done = pipeline.run_pipeline(spark, inputs, root, opt)
    assert stored(wh) == whole and done["counts"]["transactions"] == {"staged": 34, "stored": 34, "rejected": 0}
    assert not list(src.iterdir()) and pipeline.run_pipeline(spark, inputs, root, opt)["transaction_files"] == 0


def test_a_loaded_file_is_archived_only_and_a_new_delivery_is_another(spark, tmp_path, monkeypatch):
    src, arch, root = tmp_path / "in", tmp_path / "arch", str(tmp_path / "wh")
    src.mkdir()
    (src / "transactions_01032021.txt").write_text(TX_HEAD + LINES[0])
    (src / "passport_blacklist_01032021.csv").write_text("date,passport\n2021-03-01,PS1\n")
    inputs, opt = pipeline.Inputs(files_dir=str(src), archive_dir=str(arch)), pipeline.RunOptions(report_dt=dt.date(2021, 3, 4))
    wh = Warehouse(spark, root)
    with monkeypatch.context() as m:
        m.setattr(pipeline.files, "archive_files", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            pipeline.run_pipeline(spark, inputs, root, opt)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "load_transactions", lambda *a, **k: pytest.fail("loaded twice"))
        done = pipeline.run_pipeline(spark, inputs, root, opt)
    assert done["transaction_files"] == done["blacklist_files"] == 1
    (src / "transactions_01032021.txt").write_text(TX_HEAD + LINES[1])  # the name once more, other rows
    with pytest.raises(OSError):  # its archive name is taken: it stays, but its rows are in and noted
        pipeline.run_pipeline(spark, inputs, root, opt)
    assert [r[0] for r in stored(wh)] == ["X0", "X1"]
    names = sorted(r["src_file"] for r in wh.read(ledger.TABLE, schemas.META_FILES).collect())
    assert names == ["passport_blacklist_01032021.csv", "transactions_01032021.txt", "transactions_01032021.txt#2"]
    (src / "transactions_01032021.txt").write_text(TX_HEAD + LINES[0])
    with pytest.raises(DuplicateKeyError):
        pipeline.run_pipeline(spark, inputs, root, opt)


def test_rejects_are_stored_once(spark, tmp_path, monkeypatch):
    src, arch, root = tmp_path / "in", tmp_path / "arch", str(tmp_path / "wh")
    src.mkdir()
    bad = ["B1;2021-03-01 10:00:00;abc;C1;WITHDRAW;SUCCESS;T1\n"] * 2 + ["B2;2021-03-01 10:00:00;;C1;WITHDRAW;SUCCESS;T1\n"]
    (src / "transactions_01032021.txt").write_text(TX_HEAD + "".join(bad) + LINES[0])
    (src / "transactions_02032021.txt").write_text(TX_HEAD + bad[0])  # a file of rejects only
    inputs, opt = pipeline.Inputs(files_dir=str(src), archive_dir=str(arch)), pipeline.RunOptions(report_dt=dt.date(2021, 3, 4), amount_rejects=True)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "_append_file", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        for _ in range(2):
            with pytest.raises(OSError):
                pipeline.run_pipeline(spark, inputs, root, opt)
    done = pipeline.run_pipeline(spark, inputs, root, opt)
    assert done["transaction_files"] == 2 and done["counts"]["transactions"] == {"staged": 1, "stored": 1, "rejected": 4}
    rejects = spark.read.parquet(f"{root}/rejects_transactions/data")
    assert sorted(r["trans_id"] for r in rejects.collect()) == ["B1", "B1", "B1", "B2"]
    assert not [p for p in (tmp_path / "wh").glob("stg_*")]  # staging went with the commits


def test_a_short_count_is_no_load(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(ValueError):
        ledger.loaded(wh, "transactions", "/in/f.txt", "f.txt", "fact_transactions", 0, 3)
    assert ledger.delivery(wh, "transactions", "/in/f.txt", None) == "f.txt"
    assert ledger.loaded(wh, "transactions", "/in/f.txt", "f.txt", "fact_transactions", 3, 0) == 0
    assert ledger.delivery(wh, "transactions", "/in/f.txt", None) == "f.txt#2"
