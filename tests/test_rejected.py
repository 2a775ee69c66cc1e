"""Lines that cannot be loaded are kept with the reason; broken loads can be run again."""

from pyspark.sql import functions as F

from helpers import rows
from zonarium.functions.scalars import is_number, split_cells
from zonarium.operators.manifest import pending_runs
from zonarium.operators.reshape import (
    BAD_NUMBER,
    BAD_TIME,
    LONG_LINE,
    NO_HEADER,
    collect_columns,
    good_rows,
    header_columns,
    parsed_cells,
    rejected_lines,
    split_output_lines,
)
from zonarium.operators.retrieve import retrieve_timeseries
from zonarium.plans.jobs import run_folders
from zonarium.schemas import MANIFEST, TIMESERIES
from zonarium.sources.files import read_ledger, write_zone_info


def test_quoted_cells(spark):
    lines = ['a,"b, c",d', '"x ""y""",', ",,", "", '"a,b', "plain", ' "q" ,r']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in lines], "t string").select(split_cells(F.col("t"))).collect()]
    assert got == [["a", "b, c", "d"], ['x "y"', ""], ["", "", ""], [""], ['"a', "b"], ["plain"], ["q", "r"]]


def test_numbers_with_underscores(spark):
    texts = ["1__0", "1_", "_1", "1_0", "1e1_0", "1._5", "1.5_0", ".5", "5.", "nan", "-INF", "infinity", "1e", ""]
    got = dict(spark.createDataFrame([(t,) for t in texts], "t string").select("t", is_number(F.col("t"))).collect())

    def python_says(t):
        try:
            float(t)
            return True
        except ValueError:
            return False

    assert got == {t: python_says(t) for t in texts}


def test_faulty_lines_are_found(spark):
    data = [
        ("f", '﻿ Date/Time,"Z,A:x",ZB:x'),
        ("f", " 01/01  01:00:00,1,2"),
        ("f", " 01/01  02:00:00,1,oops"),
        ("f", " 01/01  03:00:00,,2"),
        ("f", "no time,1,2"),
        ("f", " 01/01  04:00:00,1,2,3"),
        ("g", " 01/01  01:00:00,1,2"),
    ]
    lines = spark.createDataFrame(data, "file string, value string")
    headers, body = split_output_lines(lines)
    headers = headers.withColumns(
        {"buildingid": F.lit(1).cast("long"), "variablename": F.lit("Zone Air"), "width": F.size("header")}
    )
    wanted = collect_columns(header_columns(headers), ["file", "buildingid", "variablename", "width"])
    cells = parsed_cells(body, headers, wanted, 2012)
    long = rows(good_rows(cells, 5).select("zonename", F.hour("datetime"), "value"))
    assert long == sorted(
        [("Z,A", 1, 1.0), ("ZB", 1, 2.0), ("Z,A", 2, 1.0), ("Z,A", 3, None), ("ZB", 3, 2.0)], key=repr
    )
    got = rows(rejected_lines(cells).select("file", "reason"))
    assert got == sorted([("f", BAD_NUMBER), ("f", BAD_TIME), ("f", LONG_LINE), ("g", NO_HEADER)])
    bad = cells.filter("reason IS NOT NULL").groupBy("reason").agg(F.sort_array(F.collect_list("zonename")))
    both = ["Z,A", "ZB"]
    assert rows(bad) == sorted([(BAD_NUMBER, ["ZB"]), (BAD_TIME, both), (LONG_LINE, both), (NO_HEADER, [])], key=repr)


def test_a_run_without_state_is_pending(spark):
    runs = [("NA", "m", "w", f"r{i}", state) for i, state in enumerate([None, "Uploaded", " Uploaded ", "Not Started"])]
    got = pending_runs(spark.createDataFrame(runs, MANIFEST)).select("Completed Simulation FolderPath")
    assert rows(got) == [("r0",), ("r3",)]


def test_no_sub_name_filters_nothing(spark):
    facts = spark.createDataFrame([], TIMESERIES)
    plan = retrieve_timeseries(facts, subvariabletype="zonename", subvariable=None)
    assert "zonename" not in plan.columns


def test_only_folders_of_the_runs_are_read(spark):
    runs = spark.createDataFrame([("b c+d",), ("a",)], "run string")
    assert run_folders(runs) == "{a,b c+d}"
    assert run_folders(spark.createDataFrame([("odd{name",)], "run string")) == "*"


def test_ledger_with_last_times(spark, tmp_path):
    text = "BuildingID,Variable Name,Variable Type,SubVariable Name,Sim Start Datetime,Last Uploaded Datetime\n"
    (tmp_path / "l.csv").write_text(text + "3,Zone Air,zone,ZA,2012-01-01 00:00:00,2012-01-02 03:00:00\n4,Site Air,site,NA,x,None\n")
    got = rows(read_ledger(spark, str(tmp_path)).select("buildingid", "subvariable", "status", F.col("last_datetime").cast("string")))
    assert got == [(3, "ZA", "Upload Started", "2012-01-02 03:00:00"), (4, "NA", "Upload Started", None)]


def test_zone_table_starts_with_its_header(spark, tmp_path):
    zones = spark.createDataFrame([(f"a_b_c_{k}", ["Zone Information", f"Z{i}"]) for k in "xy" for i in range(9)], "run string, cells array<string>")
    heads = spark.createDataFrame([(f"a_b_c_{k}", ["! <Zone Information>", "Zone Name"]) for k in "xyx"], "run string, cells array<string>")
    write_zone_info(zones, str(tmp_path / "z"), heads)
    for k in "xy":
        parts = sorted((tmp_path / "z" / f"buildingtype={k}").glob("part-*"))
        lines = [line for p in parts for line in p.read_text().splitlines()]
        assert lines == ["! <Zone Information>,Zone Name"] + [f"Zone Information,Z{i}" for i in range(9)]
