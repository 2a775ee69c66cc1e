"""The ledger as a snapshot and a log: a change writes its own keys only, and breaking off loses nothing."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from zonarium.sources import tables


def change(spark, root, *lines):
    tables.change_ledger(spark.createDataFrame(lines, "buildingid long, variablename string, subvariable string, status string, n_rows long"), root)


def state(spark, root):
    return rows(tables.read_table(spark, root, "ledger").select("buildingid", "subvariable", "status", "n_rows"))


def test_changes_and_compaction(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    assert state(spark, root) == []
    change(spark, root, (1, "V", "a", "Upload Started", None), (2, "V", None, None, 3))
    change(spark, root, (1, "V", "a", None, 7), (1, "V", "b", "x", None))
    want = [(1, "a", "Upload Started", 7), (1, "b", "x", None), (2, "NA", "None", 3)]
    assert state(spark, root) == sorted(want, key=repr)
    assert tables.table_state(spark, root, "ledger") == (True, False)
    # The second change wrote nothing of building 2.
    assert rows(spark.read.parquet(f"{root}/ledger_log/change-000000000002").select("buildingid").distinct()) == [(1,)]
    tables.compact_ledger(spark, root)
    assert state(spark, root) == sorted(want, key=repr) and not list((tmp_path / "ledger_log").glob("change-*"))
    monkeypatch.setattr(tables, "LOG_BATCHES", 2)
    for n in range(5):
        change(spark, root, (2, "V", "NA", "Upload Completed", n))
    assert state(spark, root)[-1] == (2, "NA", "Upload Completed", 4)
    assert len(list((tmp_path / "ledger_log").glob("change-*"))) < 2


def test_breaking_off(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    change(spark, root, (1, "V", "a", "s", 1))
    change(spark, root, (1, "V", "a", "t", 2))
    (tmp_path / "ledger_log" / "change-000000000002" / "_SUCCESS").unlink()
    assert state(spark, root) == [(1, "a", "s", 1)]  # a change that was not written to the end
    change(spark, root, (1, "V", "a", "u", None))
    assert state(spark, root) == [(1, "a", "u", 1)]

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(tables, "remove_folder", broken)
    with pytest.raises(OSError):
        tables.compact_ledger(spark, root)
    # The snapshot is there and the log not yet gone: its changes do not count twice.
    assert state(spark, root) == [(1, "a", "u", 1)] and list((tmp_path / "ledger_log").glob("change-*"))
    monkeypatch.undo()
    change(spark, root, (1, "V", "a", None, 9))
    assert state(spark, root) == [(1, "a", "u", 9)]


def test_replacing_takes_all_fields(spark, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    change(spark, root, (1, "V", "a", "s", 1))
    ledger = tables.read_table(spark, root, "ledger")
    tables.replace_table(ledger.withColumn("n_rows", F.lit(None).cast("long")), root, "ledger")
    assert state(spark, root) == [(1, "a", "s", None)]
    tables.truncate_table(spark, root, "ledger")
    assert state(spark, root) == [] and tables.table_state(spark, root, "ledger") == (True, True)
