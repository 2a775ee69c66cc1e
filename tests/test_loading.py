import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from zonarium.operators import loading
from zonarium.schemas import LEDGER, TIMESERIES, TIMESERIES_KEY

D = dt.datetime(2024, 1, 1)


def hours(n):
    return D + dt.timedelta(hours=n)


def series(spark, data):
    """(building, hour, zone, value) rows of one variable."""
    full = [(None, b, hours(h), 60, "Zone T", "NA", z, "NA", "NA", v) for b, h, z, v in data]
    return spark.createDataFrame(full, TIMESERIES).select(*TIMESERIES_KEY)


def ledger(spark, data):
    """(building, variable, subvariable, status, hour, rows, seconds) rows."""
    full = [(b, v, s, st, None if h is None else hours(h), n, e) for b, v, s, st, h, n, e in data]
    return spark.createDataFrame(full, LEDGER)


def short(df):
    return rows(df.select("buildingid", F.hour("datetime"), "zonename", "value"))


def test_new_rows(spark):
    batch = series(spark, [(1, 0, "A", 1.5), (1, 0, "A", 1.5), (1, 1, "A", None), (1, 2, "A", 0.1), (2, 0, "A", 1.0)])
    stored = series(spark, [(1, 1, "A", None), (1, 2, "A", 0.1), (3, 0, "A", 1.5)])
    want = [(1, 0, "A", 1.5), (1, 0, "A", 1.5), (2, 0, "A", 1.0)]
    assert short(loading.new_rows(batch, stored)) == want
    assert short(loading.new_rows(batch, stored, [1, 2])) == want
    assert short(loading.new_rows(batch, batch)) == []


def test_buildings_of(spark, monkeypatch):
    batch = series(spark, [(1, 0, "A", 1.0), (2, 0, "A", 1.0), (2, 1, "A", 1.0)])
    stored = series(spark, [(b, 0, "A", 1.0) for b in (1, 2, 3)])
    assert sorted(loading.buildings_of(batch)) == [1, 2]
    assert short(loading.of_buildings(stored, [1, 2])) == [(1, 0, "A", 1.0), (2, 0, "A", 1.0)]
    monkeypatch.setattr(loading, "MAX_LISTED_BUILDINGS", 1)
    many = loading.buildings_of(batch)
    assert rows(many) == [(1,), (2,)]
    assert short(loading.of_buildings(stored, many)) == [(1, 0, "A", 1.0), (2, 0, "A", 1.0)]


def test_after_watermark_is_per_key(spark):
    batch = loading.with_subvariable(
        series(spark, [(1, h, z, float(h)) for h in range(4) for z in ("A", "B", "C")])
    )
    marks = ledger(
        spark,
        [
            (1, "Zone T", "A", "Upload Started", 1, 2, None),
            (1, "Zone T", "B", "Upload Started", 3, 4, None),
            (1, "Zone T", "C", "Upload Started", None, 0, None),
        ],
    )
    got = short(loading.after_watermark(batch, marks))
    assert got == sorted([(1, 2, "A", 2.0), (1, 3, "A", 3.0)] + [(1, h, "C", float(h)) for h in range(4)])


def test_split_load_equals_full_load(spark):
    full = loading.with_subvariable(series(spark, [(1, h, "A", float(h)) for h in range(10)]))
    first = full.filter(F.col("datetime") < hours(5))
    marks = loading.last_datetime(first)
    rest = loading.after_watermark(full, marks)
    assert rows(first.unionByName(rest)) == rows(full)


def test_not_loaded_and_wildcard(spark):
    done = ledger(
        spark,
        [
            (1, "Zone T", "A", "Upload Completed", 1, 1, 1),
            (1, "Zone T", "B", "Upload Started", 1, 1, 1),
        ],
    )
    keys = spark.createDataFrame(
        [(1, "Zone T", "A"), (1, "Zone T", "B"), (1, "Zone U", "A"), (2, "Zone T", "A")],
        "buildingid long, variablename string, subvariable string",
    )
    assert rows(loading.not_loaded(keys, done)) == [
        (1, "Zone T", "B"), (1, "Zone U", "A"), (2, "Zone T", "A"),
    ]
    assert rows(loading.not_loaded(keys, done, ["buildingid", "variablename"])) == [
        (1, "Zone U", "A"), (2, "Zone T", "A"),
    ]
    assert rows(loading.not_loaded(keys, done, ["buildingid"])) == [(2, "Zone T", "A")]


def test_last_datetime_and_last_line(spark):
    data = loading.with_subvariable(series(spark, [(1, 0, "A", 1.0), (1, 5, "A", 1.0), (1, 3, "B", 1.0)]))
    got = rows(loading.last_datetime(data).select("subvariable", "last_datetime"))
    assert got == [("A", hours(5)), ("B", hours(3))]
    assert rows(loading.last_datetime(data, ["buildingid"])) == [(1, hours(5))]
    lines = ledger(spark, [(1, "V", "A", "s", 9, 1, 1), (1, "V", "A", "s", 2, 7, 1)])
    got = loading.last_ledger_line(lines, ["buildingid"], "n_rows")
    assert rows(got) == [(1, hours(2))]


def test_upsert_ledger(spark):
    old = ledger(spark, [(1, "V", "A", "Upload Started", 1, 10, None), (1, "V", "B", "Upload Completed", 1, 5, 3)])
    new = spark.createDataFrame(
        [(1, "V", "A", "Upload Completed", 9), (2, "V", None, None, None)],
        "buildingid long, variablename string, subvariable string, status string, elapsed_seconds long",
    )
    assert rows(loading.upsert_ledger(old, new)) == [
        (1, "V", "A", "Upload Completed", hours(1), 10, 9),
        (1, "V", "B", "Upload Completed", hours(1), 5, 3),
        (2, "V", "NA", "None", None, None, None),
    ]


def test_building_status(spark):
    lines = ledger(
        spark,
        [
            (1, "V", "A", "Upload Completed", 1, 1, 1),
            (1, "V", "B", "Upload Completed", 1, 1, 1),
            (2, "V", "A", "Upload Completed", 1, 1, 1),
            (2, "V", "B", "Upload Started", 1, 1, 1),
            (3, "V", "A", None, 1, 1, 1),
        ],
    )
    assert rows(loading.building_status(lines)) == [
        (1, "Complete"), (2, "Incomplete"), (3, "Incomplete"),
    ]


def test_load_durations(spark):
    lines = ledger(
        spark,
        [(1, "V", "A", "s", 1, 1, 2690), (1, "V", "B", "s", 1, 1, 360001), (1, "V", "C", "s", 1, 1, None)],
    )
    assert rows(loading.load_durations(lines)) == [(1, 2, 181345.5, 360001, "100:00:01")]


def test_foreign_key(spark):
    facts = series(spark, [(1, 0, "A", 1.0), (2, 0, "A", 1.0)])
    dimension = spark.createDataFrame([(1,)], "buildingid long")
    assert short(loading.orphans(facts, dimension)) == [(2, 0, "A", 1.0)]
    assert short(loading.with_building(facts, dimension)) == [(1, 0, "A", 1.0)]
