import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from zonarium.operators.reshape import (
    collect_columns,
    good_rows,
    header_columns,
    parsed_cells,
    pivot_variables,
    split_output_lines,
    to_long,
)

T1, T2 = dt.datetime(2012, 5, 1, 0, 5), dt.datetime(2013, 1, 1)


def wide(spark, headers):
    columns = ", ".join(f"`{h}` double" for h in headers)
    data = [(1, " 05/01  00:05:00", *[20.5 + i for i in range(len(headers))]),
            (1, " 12/31  24:00:00", *[None] * len(headers))]
    return spark.createDataFrame(data, f"buildingid long, `Date/Time` string, {columns}")


@pytest.mark.parametrize(
    "variable,column",
    [
        ("Schedule_Value", "schedulename"),
        ("Zone_Mean_Air_Temperature", "zonename"),
        ("Surface_Inside_Face_Temperature", "surfacename"),
        ("System_node_Temperature", "systemnodename"),
    ],
)
def test_to_long_families(spark, variable, column):
    headers = ["ZONE A:Zone Mean [C](TimeStep)", " ZONE.B :Zone Mean [C](TimeStep)"]
    long = to_long(wide(spark, headers), variable, 2012, 5)
    assert long.columns == [
        "buildingid", "datetime", "timeresolution", "variablename", "schedulename",
        "zonename", "surfacename", "systemnodename", "value",
    ]
    got = rows(long.select("datetime", column, "value"))
    assert got == sorted(
        [(T1, "ZONE A", 20.5), (T2, "ZONE A", None), (T1, "ZONE.B", 21.5), (T2, "ZONE.B", None)],
        key=repr,
    )
    others = [c for c in ("schedulename", "zonename", "surfacename", "systemnodename") if c != column]
    assert rows(long.select(*others).distinct()) == [("NA", "NA", "NA")]
    assert rows(long.select("variablename", "timeresolution").distinct()) == [
        (variable.replace("_", " "), 5)
    ]


@pytest.mark.parametrize("variable", ["Facility_Total_Power", "Site_Outdoor_Temperature"])
def test_to_long_site_uses_the_first_column(spark, variable):
    long = to_long(wide(spark, ["Environment:x", "Second:x"]), variable, 2012, 5)
    assert rows(long.select("datetime", "zonename", "value")) == sorted(
        [(T1, "NA", 20.5), (T2, "NA", None)], key=repr
    )


def test_to_long_unknown_family_gives_nothing(spark):
    assert to_long(wide(spark, ["A:x"]), "Boiler_Rate", 2012, 5).count() == 0


def test_to_long_counts_and_round_trip(spark):
    data = spark.range(50).select(
        F.lit(1).cast("long").alias("buildingid"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("datetime"),
        *[(F.col("id") * k).cast("double").alias(f"z{k}") for k in range(1, 4)],
    )
    long = to_long(data, "Zone Mean", timeresolution=60)
    assert long.count() == 150
    back = (
        long.groupBy("buildingid", "datetime").pivot("zonename", ["z1", "z2", "z3"]).agg(F.first("value"))
    )
    assert rows(back) == rows(data)


def test_to_long_has_no_shuffle(spark):
    long = to_long(wide(spark, ["A:x", "B:x"]), "Zone_Mean", 2012, 5)
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def lines_frame(spark):
    return spark.createDataFrame(
        [
            ("f1", "Date/Time,ZA:Zone Mean,Z.B:Zone Mean"),
            ("f1", " 05/01  00:05:00,20.5,21"),
            ("f1", " 12/31  24:00:00,19.5,"),
            ("f2", "Date/Time,ZC:Zone Mean"),
            ("f2", " 05/01  00:05:00,1"),
            ("f2", ""),
            ("f3", "Date/Time,Environment:Site,Other:Site"),
            ("f3", " 05/01  00:05:00,7,8"),
            ("f4", "Date/Time,X:Boiler"),
            ("f4", " 05/01  00:05:00,7"),
        ],
        "file string, value string",
    )


def test_lines_with_a_header_per_file(spark):
    names = {"f1": "Zone Mean", "f2": "Zone Mean", "f3": "Site Temp", "f4": "Boiler Rate"}
    headers, body = split_output_lines(lines_frame(spark))
    pairs = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    headers = headers.withColumn("variablename", pairs[F.col("file")]).withColumn(
        "buildingid", F.lit(3).cast("long")
    )
    columns = header_columns(headers.withColumn("width", F.size("header")))
    wanted = collect_columns(columns, ["file", "buildingid", "variablename", "width"])
    cells = parsed_cells(body, headers, wanted, 2012)
    assert cells.filter("reason IS NOT NULL").count() == 0
    got = rows(good_rows(cells, 5).select("variablename", "zonename", "datetime", "value"))
    assert got == sorted(
        [
            ("Zone Mean", "ZA", T1, 20.5),
            ("Zone Mean", "Z.B", T1, 21.0),
            ("Zone Mean", "ZA", T2, 19.5),
            ("Zone Mean", "Z.B", T2, None),
            ("Zone Mean", "ZC", T1, 1.0),
            ("Site Temp", "NA", T1, 7.0),
        ],
        key=repr,
    )


def test_pivot_variables(spark):
    df = spark.createDataFrame(
        [("z", 1, "A", 1.0), ("z", 1, "B", 2.0), ("z", 2, "A", 3.0)],
        "zonename string, datetime int, variablename string, value double",
    )
    got = pivot_variables(df, ["zonename", "datetime"], ["A", "B"])
    assert rows(got) == [("z", 1, 1.0, 2.0), ("z", 2, 3.0, None)]
