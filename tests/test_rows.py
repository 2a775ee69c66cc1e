from pyspark.sql import functions as F

from helpers import rows
from zonarium.operators import joins
from zonarium.operators.ids import serial_ids
from zonarium.operators.rows import first_by, last_by, minus_existing, repeat_rows


def plan_of(df):
    return df._jdf.queryExecution().toString()


NAN = float("nan")
SCHEMA = "b long, t string, v float"


def test_minus_existing_is_null_safe_and_keeps_copies(spark):
    batch = spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (2, "b", NAN), (3, "c", 1.0), (3, "c", 1.0), (4, None, 2.0), (5, "e", 0.1)],
        SCHEMA,
    )
    existing = spark.createDataFrame(
        [(2, "b", NAN), (4, None, 2.0), (3, "c", 9.0), (5, "e", 0.1), (5, "e", 0.1)], SCHEMA
    )
    assert rows(minus_existing(batch, existing)) == [
        (1, "a", None), (1, "a", None), (3, "c", 1.0), (3, "c", 1.0),
    ]
    assert rows(minus_existing(batch, existing, keep_copies=False)) == [
        (1, "a", None), (3, "c", 1.0),
    ]


def test_minus_existing_compares_in_the_stored_type(spark):
    batch = spark.createDataFrame([(1, "a", 0.1), (1, "a", 0.2)], "b long, t string, v double")
    stored = spark.createDataFrame([(1, "a", 0.1)], SCHEMA)
    got = minus_existing(batch, stored)
    assert got.schema["v"].dataType.simpleString() == "float" and got.count() == 1


def test_minus_existing_with_nothing_stored(spark):
    batch = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0)], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(minus_existing(batch, empty)) == rows(batch)
    assert rows(minus_existing(empty, batch)) == []


def test_minus_existing_matches_anti_join_on_random_rows(spark):
    batch = spark.range(4000).select(
        F.pmod(F.xxhash64("id"), F.lit(300)).alias("b"),
        F.when(F.col("id") % 7 > 0, F.lit("x")).alias("t"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("float")).alias("v"),
    )
    existing = batch.filter((F.col("b") > 100) & (F.coalesce("v", F.lit(0.0)) < 2))
    anti = batch.alias("l").join(
        existing.alias("r"),
        [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in batch.columns],
        "left_anti",
    )
    assert rows(minus_existing(batch, existing)) == rows(anti)


def test_repeat_rows_in_pieces(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 10), ("d", 11)], "k string, n long")
    got = repeat_rows(df, "n", per_piece=10).groupBy("k").count()
    assert rows(got) == [("a", 1), ("b", 25), ("c", 10), ("d", 11)]


def test_minus_existing_shuffles_once(spark):
    batch = spark.range(100).select(F.col("id").alias("b"), F.lit("x").alias("t"))
    out = minus_existing(batch, batch.filter("b < 50"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_sum" in plan
    out.collect()


def test_lookup_join_ways_agree(spark):
    big = spark.range(2000).select(
        F.when(F.col("id") < 700, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("x"),
    )
    small = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        small_how = small if how in ("inner", "left") else small.select("k")
        broadcast = joins.lookup_join(big, small_how, "k", how)
        salted = joins.lookup_join(big, small_how, "k", how, max_bytes=0)
        assert rows(broadcast) == rows(salted)
        assert "BroadcastHashJoin" in plan_of(broadcast)


def test_lookup_join_keeps_several_matches(spark):
    big = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    small = spark.createDataFrame([(1, "p"), (1, "q")], "k long, y string")
    for limit in (joins.MAX_BROADCAST_BYTES, 0):
        assert rows(joins.lookup_join(big, small, "k", "inner", max_bytes=limit)) == [
            (1, "a", "p"), (1, "a", "q"),
        ]


def test_serial_ids_are_dense_and_ordered(spark):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    got = serial_ids(df, "n", ["name"], start=7).orderBy("n").collect()
    assert [r.n for r in got] == list(range(8, 1008))
    assert [r.name for r in got] == sorted(r.name for r in got)


def test_serial_ids_of_nothing(spark):
    assert serial_ids(spark.createDataFrame([], "name string"), "n", ["name"]).count() == 0


def test_first_and_last_by(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, o int, v string")
    assert rows(last_by(df, ["k"], "o", ["v"])) == [("a", "y"), ("b", "z")]
    assert rows(first_by(df, ["k"], "o", ["v"])) == [("a", "x"), ("b", "z")]
