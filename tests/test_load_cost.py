"""What a load does not do for each line of its files."""

import contextlib
import io

from helpers import rows
from zonarium.operators.reshape import parsed_cells, split_output_lines
from zonarium.plans import jobs
from zonarium.sources import tables


def plan(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("extended")
    return text.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_the_run_of_a_variable_is_not_read_from_its_lines(spark, tmp_path, monkeypatch):
    path = tmp_path / "run 1" / "TimeSeriesData" / "Zone_Air.csv"
    path.mkdir(parents=True)
    for name in ("a.csv", "b.csv"):
        (path / name).write_text("Date/Time,ZA:x\n 01/02  01:00:00,1\n")
    (path / "_SUCCESS").write_text("")
    given = []
    monkeypatch.setattr(jobs, "load_outputs", lambda spark, root, lines, runs, *more: given.append((lines, runs)))
    jobs.load_variable(spark, str(tmp_path / "t"), str(path), 7, 2012, 60)
    (lines, runs), = given
    assert rows(runs) == [("run 1", 7)] and lines.count() == 4
    assert " text" not in plan(runs)


def test_a_cell_is_read_as_a_number_once(spark):
    lines = spark.createDataFrame(
        [("f", "Date/Time,A:x"), ("f", " 01/02  01:00:00, 1.5 "), ("f", " 01/02  02:00:00,x"), ("f", " 01/02  03:00:00, ")],
        "file string, value string",
    )
    headers, body = split_output_lines(lines)
    wanted = spark.sql(
        "SELECT 'f' AS file, 1L AS buildingid, 'Zone Air' AS variablename, 2 AS width, array(named_struct('position', 1, "
        "'schedulename', 'NA', 'zonename', 'A', 'surfacename', 'NA', 'systemnodename', 'NA')) AS columns"
    )
    cells = parsed_cells(body, headers, wanted, 2012)
    assert rows(cells.select("value", "reason")) == [(1.5, None), (None, "unreadable number"), (None, None)]
    assert plan(cells).count("as double)") == 1


def test_one_header_and_several_find_the_same_lines(spark, tmp_path):
    """A file with one header, one that follows it, and lines before any."""
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    at = "/r/TimeSeriesData/Zone_{}.csv"
    lines = [
        (at.format("A"), " 01/02  01:00:00,9", 0), (at.format("A"), "Date/Time,Z1:x", 1), (at.format("A"), " 01/02  01:00:00,1", 2),
        (at.format("B"), "Date/Time,Z2:x", 0), (at.format("B"), " 01/02  01:00:00,2", 1), (at.format("B"), "Date/Time,Z3:x", 2),
        (at.format("B"), " 01/02  01:00:00,3", 3), (at.format("C"), " 01/02  01:00:00,9", 0),
    ]
    frame = spark.createDataFrame(lines, "file string, value string, n long").selectExpr(
        "file", "value", "named_struct('block', 0L, 'row', n) AS line_no"
    )
    jobs.load_outputs(spark, root, frame, spark.createDataFrame([("r", 1)], "run string, buildingid long"), 2012, 60)
    stored = tables.read_table(spark, root, "timeseriesdata")
    assert rows(stored.select("variablename", "zonename", "value")) == [("Zone A", "Z1", 1.0), ("Zone B", "Z2", 2.0), ("Zone B", "Z3", 3.0)]
    lost = tables.read_rejected(spark, root, "timeseries_rejected")
    assert rows(lost.select("file", "reason")) == [(at.format(x), "no header") for x in "AC"]
