import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from zonarium.operators import aggregate
from zonarium.operators.retrieve import retrieve_eio, retrieve_timeseries, training_rows
from zonarium.plans.jobs import build_training_set
from zonarium.schemas import EIO, TIMESERIES, ZONE_MAP

D = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]


@pytest.fixture(scope="module")
def facts(spark):
    data = []
    for b in (1, 2):
        for i, d in enumerate(D):
            for z, v in (("A", 1.0), ("B", 3.0), ("C", 10.0)):
                data.append((len(data), b, d, 60, "Zone T", "NA", z, "NA", "NA", v + i))
            data.append((len(data), b, d, 60, "Site T", "NA", "NA", "NA", "NA", 100.0 + i))
            data.append((len(data), b, d, 5, "Schedule Value", "S1", "NA", "NA", "NA", 0.5))
    return spark.createDataFrame(data, TIMESERIES)


@pytest.fixture(scope="module")
def zone_map(spark):
    return spark.createDataFrame([(1, "A", 1), (1, "B", 1), (1, "C", 2), (2, "A", 1)], ZONE_MAP)


@pytest.fixture(scope="module")
def eio(spark):
    people = "People Internal Gains Nominal"
    data = [
        (1, "Zone Information", "A", "Floor Area {m2}", "NA", 1.0),
        (1, "Zone Information", "B", "Floor Area {m2}", "NA", 3.0),
        (1, "Zone Information", "C", "Floor Area {m2}", "N/A", None),
        (1, "Zone Information", "A", "Volume {m3}", "NA", 5.0),
        (1, people, "A", "Number", "NA", 2.0),
        (1, people, "B", "Number", "NA", 4.0),
        (1, people, "A", "Schedule Name", "S1", None),
        (1, "Lights Internal Gains Nominal", "C", "Number", "NA", 7.0),
    ]
    return spark.createDataFrame([(i, *d) for i, d in enumerate(data)], EIO)


def test_retrieve_columns(facts):
    assert retrieve_timeseries(facts).columns == [
        "timeseriesdataid", "buildingid", "variablename", "datetime", "value",
    ]
    assert retrieve_timeseries(facts, 1, variable="Zone T").columns == [
        "timeseriesdataid", "datetime", "value",
    ]
    assert retrieve_timeseries(facts, subvariabletype="zonename", subvariable="A").columns == [
        "timeseriesdataid", "buildingid", "variablename", "zonename", "datetime", "value",
    ]


def test_retrieve_filters(facts):
    assert retrieve_timeseries(facts).count() == 30
    assert retrieve_timeseries(facts, 1).count() == 15
    assert retrieve_timeseries(facts, 1, D[1], D[2]).count() == 10
    assert retrieve_timeseries(facts, start="2024-01-02 00:00:00").count() == 20
    assert retrieve_timeseries(facts, timeresolution=5).count() == 6
    assert retrieve_timeseries(facts, 2, D[0], D[0], 60, "Zone T", "zonename", "B").count() == 1
    # 'NA', an unknown type and empty values filter nothing
    assert retrieve_timeseries(facts, subvariabletype="zonename", subvariable="NA").count() == 30
    assert retrieve_timeseries(facts, subvariabletype="Zone", subvariable="A").count() == 30
    assert retrieve_timeseries(facts, buildingid=0, variable="").count() == 30


def test_retrieve_eio(eio):
    assert retrieve_eio(eio).columns == [
        "buildingid", "tablename", "zonename", "variablename", "stringvalue", "floatvalue",
    ]
    got = retrieve_eio(eio, 1, "Zone Information", variablename="Floor Area {m2}")
    assert rows(got) == [("A", "NA", 1.0), ("B", "NA", 3.0), ("C", "N/A", None)]


def test_pushed_filters(spark, facts, tmp_path):
    path = str(tmp_path / "t")
    facts.write.partitionBy("buildingid").parquet(path)
    stored = spark.read.schema(TIMESERIES).parquet(path)
    out = retrieve_timeseries(stored, 1, D[0], D[1], 60, "Zone T", "zonename", "A")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(buildingid" in plan
    for name in ("datetime", "timeresolution", "variablename", "zonename"):
        assert f"({name}," in plan.split("PushedFilters")[1]
    assert "surfacename" not in plan.split("ReadSchema")[1]
    assert out.count() == 2


def test_training_rows(facts):
    got = training_rows(facts, 1, D[0], D[0], "A")
    assert rows(got.select("variablename", "zonename", "value")) == [
        ("Schedule Value", "NA", 0.5), ("Site T", "NA", 100.0), ("Zone T", "A", 1.0),
    ]


@pytest.mark.parametrize(
    "how,first",
    [("mean", 2.0), ("sum", 4.0), ("min", 1.0), ("max", 3.0), ("area_weighted", 2.5), ("volume_weighted", 1.0)],
)
def test_aggregate_zones(facts, zone_map, eio, how, first):
    weights = aggregate.zone_weights(eio)
    out = aggregate.aggregate_zones(facts, zone_map, how, weights)
    one = out.filter((F.col("buildingid") == 1) & (F.col("datetime") == D[0]))
    got = dict(rows(one.select("zonename", "value")))
    assert got["Aggregation_Zone_1"] == first
    if how.endswith("weighted"):
        assert got["Aggregation_Zone_2"] is None
    assert out.count() == 9


def test_aggregate_zones_in_several_ways_at_once(facts, zone_map, eio):
    out = aggregate.aggregate_zones(
        facts, zone_map, ["min", "max", "area_weighted"], aggregate.zone_weights(eio)
    )
    assert out.columns[4:] == ["min", "max", "area_weighted"]
    first = out.filter((F.col("buildingid") == 1) & (F.col("datetime") == D[0]))
    assert rows(first.drop("buildingid", "variablename", "datetime")) == [
        ("Aggregation_Zone_1", 1.0, 3.0, 2.5), ("Aggregation_Zone_2", 10.0, 10.0, None),
    ]


def test_weighted_mean_leaves_out_missing_values(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 5.0), (4.0, None), (3.0, 3.0)], "v double, w double")
    assert df.agg(aggregate.weighted_mean(F.col("v"), F.col("w"))).first()[0] == 2.5


def test_aggregate_errors(facts, zone_map):
    with pytest.raises(ValueError):
        aggregate.aggregate_zones(facts, zone_map, "median")
    with pytest.raises(ValueError):
        aggregate.aggregate_zones(facts, zone_map, "area_weighted")


def test_zone_series_table(facts, zone_map):
    table = aggregate.zone_series_table(aggregate.aggregate_zones(facts, zone_map), ["Zone T", "Other"])
    assert table.columns == ["buildingid", "zonename", "datetime", "Zone T", "Other"]
    assert table.count() == 9


def test_equipment_levels(eio, zone_map):
    got = aggregate.equipment_levels(eio, zone_map, "Number", ["People", "Lights"])
    assert got.columns == ["buildingid", "zonename", "People_Level", "Lights_Level"]
    assert rows(got) == [
        (1, "Aggregation_Zone_Equipment_1", 6.0, None), (1, "Aggregation_Zone_Equipment_2", None, 7.0),
    ]


def test_equipment_schedules(facts, eio, zone_map):
    series = aggregate.equipment_schedules(facts, eio)
    got = rows(series.select("buildingid", "variablename", "zonename", "schedulename", "value").distinct())
    assert got == [(1, "Schedule Value People", "A", "S1", 0.5)]
    assert aggregate.aggregate_zones(series, zone_map).count() == 3


def test_build_training_set(facts, zone_map):
    got = build_training_set(facts, zone_map, 1, D[0], D[1], 1, ["Zone T", "Site T"])
    assert rows(got) == [(1, D[0], 2.0, 100.0), (1, D[1], 3.0, 101.0)]


def test_surfaces_collapse_to_zones(spark):
    data = [(i, 1, D[0], 60, "Surface T", "NA", "NA", s, "NA", v) for i, (s, v) in enumerate([("w1", 1.0), ("w2", 3.0)])]
    surfaces = spark.createDataFrame(data, TIMESERIES)
    mapping = spark.createDataFrame([(1, "w1", 1), (1, "w2", 1)], "buildingid long, surfacename string, aggregation_zone int")
    got = aggregate.aggregate_zones(surfaces, mapping, name="surfacename")
    assert rows(got.select("zonename", "value")) == [("Aggregation_Zone_1", 2.0)]
