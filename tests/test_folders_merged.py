"""Fact tables as folders of appends: merging, breaking off, pruning."""

import re
import shutil

import pytest

from helpers import rows
from zonarium.sources import tables

NAME = "timeseriesdata"
COLUMNS = "buildingid long, datetime timestamp_ntz, variablename string, value float"


def append(spark, root, *lines):
    frame = spark.createDataFrame([(b, None, v, x) for b, v, x in lines], COLUMNS)
    for field in tables.SCHEMAS[NAME]:
        if field.name not in frame.columns and field.name != tables.ID_COLUMN[NAME]:
            frame = frame.selectExpr("*", f"CAST(NULL AS {field.dataType.simpleString()}) AS {field.name}")
    tables.append_rows(frame, root, NAME)


def state(spark, root):
    return rows(tables.read_table(spark, root, NAME).select("buildingid", "variablename", "value"))


def folders(tmp_path):
    return sorted(f.name for f in (tmp_path / NAME).glob("rows=*"))


def scanned(frame):
    """Number of files the frame's scan opens."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan()
    leaf = next(iter_scans(text))
    return leaf.metrics().apply("numFiles").value()


def iter_scans(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if plan.getClass().getSimpleName() == "FileSourceScanExec":
        yield plan
    children = plan.children()
    for k in range(children.size()):
        yield from iter_scans(children.apply(k))


def test_which_folders_are_merged():
    def of(*sizes):
        return tables.small_folders(list(sizes), least=3, small=10)

    assert of() == of(5) == of(5, 5) == 0
    assert of(5, 5, 5) == 3
    assert of(25, 5, 5) == 0 and of(25, 20, 30, 5, 5) == 5  # the next class takes the small ones along
    assert of(1000, 5, 5) == 0 and of(1000, 5, 5, 5) == 3
    assert of(5, 5, 1000, 5) == 4  # small ones behind a large one do not stay forever
    assert of(0, 0, 0) == 3


def test_every_class_keeps_few_folders():
    sizes = []
    rewritten = 0
    for _ in range(2000):
        sizes.append(7)
        n = tables.small_folders(sizes, least=4, small=8)
        if n:
            rewritten += sum(sizes[-n:])
            sizes[-n:] = [sum(sizes[-n:])]
        assert len(sizes) <= 3 * 7
    assert sum(sizes) == 14000 and rewritten <= 14000 * 7


def test_merging(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(tables, "MERGE_FOLDERS", 4)
    tables.ensure_tables(spark, root)
    assert tables.table_state(spark, root, NAME) == (True, True) and state(spark, root) == []
    want, held = [], None
    for n in range(9):
        lines = [(1, "V", float(n)), (2, "V", 0.5)]
        append(spark, root, *lines)
        want += lines
        assert state(spark, root) == sorted(want, key=repr)
        if n == 2:
            held = tables.read_table(spark, root, NAME)
        if n == 4:
            assert held.count() == 6  # made before the merge
    assert tables.table_state(spark, root, NAME) == (True, False)
    assert len(tables._live(tables._folders(spark, root, NAME))) < 4
    tables.compact_table(spark, root, NAME)
    assert state(spark, root) == sorted(want, key=repr)
    live = tables._live(tables._folders(spark, root, NAME))
    assert live == [(1, 9)]
    assert len(list((tmp_path / NAME / "rows=000000000001_000000000009").glob("buildingid=1/*.parquet"))) == 1
    tables.compact_table(spark, root, NAME)  # nothing to do
    append(spark, root, (3, "V", 1.0))
    assert state(spark, root) == sorted([*want, (3, "V", 1.0)], key=repr)
    tables.truncate_table(spark, root, NAME)
    assert state(spark, root) == [] and folders(tmp_path) == []


def test_breaking_off(spark, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    append(spark, root, (1, "V", 1.0))
    append(spark, root, (1, "V", 2.0))
    tables.compact_table(spark, root, NAME)
    assert len(folders(tmp_path)) == 3 and state(spark, root) == [(1, "V", 1.0), (1, "V", 2.0)]
    (tmp_path / NAME / "rows=000000000001_000000000002" / "_SUCCESS").unlink()  # as if it had broken off
    assert state(spark, root) == [(1, "V", 1.0), (1, "V", 2.0)]
    (tmp_path / NAME / "rows=000000000002_000000000002" / "_SUCCESS").unlink()  # an append that broke off
    assert state(spark, root) == [(1, "V", 1.0)]
    append(spark, root, (1, "V", 3.0))
    assert state(spark, root) == [(1, "V", 1.0), (1, "V", 3.0)]
    tables.compact_table(spark, root, NAME)
    assert state(spark, root) == [(1, "V", 1.0), (1, "V", 3.0)]


def test_empty_appends(spark, tmp_path):
    root = str(tmp_path)
    append(spark, root, (1, "V", 1.0))
    tables.append_rows(tables.read_table(spark, root, NAME).limit(0), root, NAME)
    assert state(spark, root) == [(1, "V", 1.0)]
    tables.compact_table(spark, root, NAME)
    assert state(spark, root) == [(1, "V", 1.0)]
    tables.truncate_table(spark, root, NAME)
    for _ in range(2):
        tables.append_rows(tables.read_table(spark, root, NAME).limit(0), root, NAME)
    tables.compact_table(spark, root, NAME)
    assert tables.table_state(spark, root, NAME) == (True, True)


def test_a_building_filter_prunes(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        append(spark, root, *[(b, "V", float(n)) for b in range(1, 6)])
    one = tables.read_table(spark, root, NAME).filter("buildingid = 2")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*buildingid", plan)
    assert scanned(one) == 3
    tables.compact_table(spark, root, NAME)
    assert scanned(tables.read_table(spark, root, NAME).filter("buildingid = 2")) == 1


def test_an_earlier_layout_is_not_taken_for_empty(spark, tmp_path):
    root = str(tmp_path)
    append(spark, root, (1, "V", 1.0))
    old = tmp_path / NAME / "rows=000000000001_000000000001"
    shutil.move(str(old / "buildingid=1"), str(tmp_path / NAME / "buildingid=1"))
    shutil.rmtree(old)
    with pytest.raises(ValueError, match="earlier version"):
        tables.read_table(spark, root, NAME)
