"""A third of the rows under one key: results stay whole."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from zonarium.operators import joins, loading, rows as row_ops
from zonarium.operators.aggregate import aggregate_zones

N = 30_000


def skewed(spark):
    """Long rows of which a third belong to one building and zone."""
    hot = F.col("id") < N // 3
    return spark.range(N).select(
        F.when(hot, F.lit(1)).otherwise(F.col("id") % 200).cast("long").alias("buildingid"),
        F.when(hot, "Z0").otherwise(F.concat(F.lit("Z"), F.col("id") % 7)).alias("zonename"),
        F.lit("Zone T").alias("variablename"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 500).cast("int"))).alias("datetime"),
        (F.col("id") % 11).cast("double").alias("value"),
    )


def mapping(spark):
    return (
        skewed(spark).select("buildingid", "zonename").distinct()
        .withColumn("aggregation_zone", F.when(F.col("zonename") < "Z4", 1).otherwise(2))
    )


def test_salted_join_spreads_the_hot_key(spark):
    big = skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.lookup_join(big, mapping(spark), ["buildingid", "zonename"], "inner", max_bytes=0)
        assert joined.count() == N
        hot = joined.filter("buildingid = 1 and zonename = 'Z0'")
        parts = hot.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("limit", [joins.MAX_BROADCAST_BYTES, 0])
def test_aggregate_zones(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("left", None, limit))
    out = aggregate_zones(skewed(spark), mapping(spark), "sum")
    total = skewed(spark).agg(F.sum("value")).first()[0]
    assert out.agg(F.sum("value")).first()[0] == total


@pytest.mark.parametrize("limit", [joins.MAX_BROADCAST_BYTES, 0])
def test_after_watermark(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("left", None, limit))
    keys = ["buildingid", "zonename"]
    batch = skewed(spark)
    half = batch.filter("datetime < timestamp_ntz'2024-01-01 04:00:00'")
    marks = loading.last_datetime(half, keys)
    later = loading.after_watermark(batch, marks, keys)
    pairs = {(r.buildingid, r.zonename): r.last_datetime for r in marks.collect()}
    want = [r for r in batch.collect()
            if (r.buildingid, r.zonename) not in pairs or r.datetime > pairs[r.buildingid, r.zonename]]
    assert later.count() == len(want)


def test_copies_of_one_row(spark):
    same = spark.range(N).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    other = spark.range(100).select(F.col("id").cast("int").alias("a"), F.lit("y").alias("b"))
    batch, stored = same.unionByName(other), other.filter("a < 60")
    assert N > row_ops.COPIES_PER_PIECE
    fresh = row_ops.minus_existing(batch, stored)
    assert rows(fresh.groupBy("b").count()) == [("x", N), ("y", 40)]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert row_ops.minus_existing(batch, same).count() == 100


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_key_with_half_the_rows(spark, how):
    hot = F.col("id") % 2 == 0
    # The types of the keys differ, and some keys are missing on either side.
    big = spark.range(N).select(
        F.when(hot, F.lit(7)).when(F.col("id") % 101 != 0, (F.col("id") % 5000).cast("int")).alias("k"), F.col("id").alias("v")
    )
    small = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    small = small.unionByName(spark.createDataFrame([(None, 1), (1 << 40, 1)], "k long, w long"))
    plain = big.join(small, "k", how)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        joined = joins.lookup_join(big, small, "k", how, max_bytes=0)
        assert joined.columns == plain.columns
        assert rows(joined) == rows(plain)
        if how != "left_anti":
            parts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert max(parts) < N / 10
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_only_hot_keys_are_spread(spark):
    big = spark.range(N).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 9999).alias("k"))
    (key, pieces), = joins.hot_keys(big, ["k"])
    assert key == spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert abs(pieces - 0.5 / joins.HOT_SHARE) <= 2
    assert joins.hot_keys(big.limit(0), ["k"]) == []


def test_a_derived_lookup_is_computed_once(spark):
    stored = spark.createDataFrame([(1, 2), (1, 3), (2, 5), (None, 7)], "k long, v long")
    assert not joins.is_derived(stored.filter("v > 2").selectExpr("k", "v + 1 AS w").unionByName(stored.toDF("k", "w")))
    grouped = stored.groupBy("k").agg(F.max("v").alias("top"))
    assert joins.is_derived(grouped) and joins.is_derived(stored.join(grouped, "k")) and joins.is_derived(grouped.select("top"))
    big = spark.range(4).select(F.col("id").alias("k"))
    for limit in (joins.MAX_BROADCAST_BYTES, 0):
        joined = joins.lookup_join(big, grouped, "k", "left", max_bytes=limit)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan
        assert sorted(map(tuple, joined.collect()), key=repr) == [(0, None), (1, 3), (2, 5), (3, None)]
