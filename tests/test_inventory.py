"""Loads read new and changed files only."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_jobs import RUNS, SERIES_PER_RUN, setup, write_run  # noqa: F401
from zonarium.plans import jobs
from zonarium.sources import files, inventory, tables

ROWS = SERIES_PER_RUN * 3


def files_opened(df):
    """Files that the scans of a frame have opened."""
    df.collect()
    nodes, opened = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        if node.metrics().contains("numFiles"):
            opened += node.metrics().get("numFiles").get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return opened


@pytest.fixture
def load(setup, monkeypatch):  # noqa: F811
    """A load that tells which lines and models it was given."""
    spark, root, manifest, results, models = setup
    given = {}

    def spy(name, take):
        real = getattr(jobs, name)

        def wrapped(*args, **kw):
            given[name] = take(args)
            return real(*args, **kw)

        monkeypatch.setattr(jobs, name, wrapped)

    spy("load_outputs", lambda args: args[2])
    spy("load_eio", lambda args: args[2])
    spy("model_heating", lambda args: args[2])

    def run(mode=jobs.DEDUPE, **kw):
        given.clear()
        jobs.load_all(spark, root, manifest, str(results), models, 2012, 60, mode, **kw)
        return dict(given)

    run.facts = lambda: tables.read_table(spark, root, "timeseriesdata").count()
    run.setup = setup
    return run


def test_nothing_is_read_twice(load):
    assert set(load()) == {"load_outputs", "load_eio", "model_heating"}
    assert load() == {}
    assert load(mode=jobs.WATERMARK) == {}
    assert load.facts() == 2 * ROWS
    spark, root, manifest, *_ = load.setup
    state = files.read_manifest(spark, manifest)
    assert rows(state.select("BuildingID", "Simulation Status")) == [("1", "Complete"), ("2", "Complete")]


def test_a_changed_file_is_the_only_one_read(load):
    load(skip_completed=False)
    _, _, _, results, _ = load.setup
    folder = results / RUNS[1] / "TimeSeriesData"
    with open(folder / "System_node_Temperature.csv", "a") as file:
        file.write(" 12/31  20:00:00,0.5\n")
    given = load(skip_completed=False)
    assert set(given) == {"load_outputs"}
    lines = given["load_outputs"]
    assert rows(lines.select(F.substring_index("file", "/", -1)).distinct()) == [("System_node_Temperature.csv",)]
    assert files_opened(lines) == 1
    assert load.facts() == 2 * ROWS + 1
    assert load(skip_completed=False) == {}


def test_a_file_that_was_passed_over_is_read_by_a_thorough_load(load):
    load()
    _, _, _, results, _ = load.setup
    write_run(results, RUNS[0], range(0, 4))
    assert "load_outputs" in load()  # its series are completed, so its new lines stay out
    assert load.facts() == 2 * ROWS and load() == {}
    assert "load_outputs" in load(mode=jobs.WATERMARK, skip_completed=False)
    assert load.facts() == 2 * ROWS  # its new lines are older than the marks
    assert "load_outputs" in load(skip_completed=False)
    assert load.facts() == 2 * ROWS + SERIES_PER_RUN
    assert load(skip_completed=False) == {} and load(mode=jobs.WATERMARK, skip_completed=False) == {} and load() == {}


def test_a_load_that_broke_off_reads_its_files_again(load, monkeypatch):
    real = jobs.add_rejected
    monkeypatch.setattr(jobs, "add_rejected", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load()
    monkeypatch.setattr(jobs, "add_rejected", real)
    assert {"load_outputs", "load_eio"} <= set(load())
    assert load.facts() == 2 * ROWS


def test_models(load):
    spark, root, manifest, _, models = load.setup
    load()
    with open(os.path.join(models, "m0.idf"), "a") as file:
        file.write("ALL OBJECTS IN CLASS: COIL:HEATING:WATER\n")
    assert load()["model_heating"] == "{m0.idf}"
    kinds = tables.read_table(spark, root, "buildingids").select("buildingid", "buildingheatingtype")
    assert rows(kinds) == [(1, "Gas"), (2, "gas+furnace"), (3, "Water & Gas")]
    assert rows(files.read_manifest(spark, manifest).select("BuildingID")) == [("2",), ("3",)]


def test_truncated_tables_are_filled_again(load):
    spark, root, *_ = load.setup
    load()
    for name in ("eiotabledata", "timeseriesdata", "ledger"):
        tables.truncate_table(spark, root, name)
    assert set(load()) == {"load_outputs", "load_eio"}
    assert load.facts() == 2 * ROWS


def test_many_files_are_found_by_join(load, monkeypatch):
    monkeypatch.setattr(inventory, "MAX_LISTED_FILES", 1)
    load()
    assert load.facts() == 2 * ROWS and load() == {}
