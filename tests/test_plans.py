"""Plans that the design rests on: numbers of scans and exchanges."""

import re

from __spark_entry__ import queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_many_variables_are_one_scan(spark):
    plan = plan_of(queries()["q_wide_families"](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert "Exchange" not in plan


def test_zone_table_is_one_shuffle(spark):
    from zonarium.operators.aggregate import aggregate_zone_table

    series = spark.createDataFrame(
        [(1, "a", v, t, float(t)) for v in ("x", "y") for t in range(50)],
        "buildingid long, zonename string, variablename string, datetime long, value double",
    )
    zones = spark.createDataFrame([(1, "a", 1)], "buildingid long, zonename string, aggregation_zone int")
    table = aggregate_zone_table(series, zones, ["x", "y"], "sum")
    plan = plan_of(table)
    assert len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange hashpartitioning", plan)) == 1
    assert {(r.datetime, r.x, r.y) for r in table.collect()} == {(t, t, t) for t in range(50)}


def test_training_set_is_one_exchange_of_the_facts(spark):
    from zonarium.plans.jobs import build_training_set
    from zonarium.schemas import TIMESERIES

    facts = spark.createDataFrame([], TIMESERIES)
    zones = spark.createDataFrame([(1, "a", 1)], "buildingid long, zonename string, aggregation_zone int")
    weights = spark.createDataFrame([(1, "a", 1.0, 1.0)], "buildingid long, zonename string, area double, volume double")
    for how in ("mean", "area_weighted"):
        table = build_training_set(facts, zones, 1, None, None, 1, ["x", "y"], how, weights)
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange hashpartitioning", plan)) == 1


def test_schedule_rows_do_not_grow_with_zones(spark):
    from zonarium.operators.aggregate import aggregate_schedules, aggregate_zones, equipment_schedules
    from zonarium.schemas import EIO, TIMESERIES

    import datetime as dt

    day = dt.datetime(2024, 1, 1)
    facts = spark.createDataFrame(
        [(i, 1, day + dt.timedelta(hours=i), 60, "Schedule Value", "S", "NA", "NA", "NA", v) for i, v in enumerate([1.0, None, 3.0])],
        TIMESERIES,
    )

    def joined(zones):
        eio = spark.createDataFrame(
            [(i, 1, "People Internal Gains Nominal", f"Z{i}", "Schedule Name", " S ", None) for i in range(zones)], EIO
        )
        mapping = spark.createDataFrame([(1, f"Z{i}", i % 2) for i in range(zones)], "buildingid long, zonename string, aggregation_zone int")
        weights = spark.createDataFrame(
            [(1, f"Z{i}", float(i) if i % 3 else None, 2.0) for i in range(zones)], "buildingid long, zonename string, area double, volume double"
        )
        modes = ["mean", "sum", "min", "max", "area_weighted", "volume_weighted"]
        got = aggregate_schedules(facts, eio, mapping, modes, weights)
        want = aggregate_zones(equipment_schedules(facts, eio), mapping, modes, weights)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        leaves, found = [got._jdf.queryExecution().executedPlan()], []
        while leaves:
            node = leaves.pop()
            if node.nodeName() == "AdaptiveSparkPlan":
                node = node.executedPlan()
            if node.nodeName().endswith("QueryStage"):
                node = node.plan()
            if "Join" in node.nodeName():
                found.append(node.metrics().get("numOutputRows").get().value())
            children = node.children()
            leaves += [children.apply(i) for i in range(children.size())]
        return found

    assert joined(4) == joined(40) == [6]
