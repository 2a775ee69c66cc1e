"""Queries on time series: reshaping, loading, reading, aggregating."""

from pyspark.sql import functions as F

from ..functions.scalars import (
    format_datetime,
    normalise_variable,
    seconds_to_hhmmss,
    subvariable,
    variable_family,
)
from ..operators import aggregate, loading
from ..operators.reshape import LONG_COLUMNS, pivot_variables, to_long
from ..operators.retrieve import retrieve_timeseries, training_rows
from ..plans.jobs import build_training_set
from . import standins as s
from .registry import query, table

_MONTH_DAY = "strftime(l_shipdate, '%m/%d')"


def _wide_lineitem(spark, sf_dir):
    time = F.concat(F.date_format("l_shipdate", "MM/dd"), F.lit("  "), F.format_string("%02d", "l_linenumber"), F.lit(":30:00"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("buildingid"),
        time.alias("Date/Time"),
        F.col("l_quantity").alias("QTY:Zone Air [x](TimeStep)"),
        F.col("l_extendedprice").alias(" PRICE.1 :Zone Air [x](TimeStep)"),
        F.col("l_discount").alias("DISC"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("TAX:Zone"),
    )


_TIME_SQL = "make_timestamp(2000, month(l_shipdate), day(l_shipdate), CAST(l_linenumber AS BIGINT), 30, 0.0)"
_CELLS = {"QTY": "l_quantity", "PRICE.1": "l_extendedprice", "DISC": "l_discount", "TAX": "nullif(l_tax, 0)"}


def _long_sql(variable, column, cells):
    subs = ["schedulename", "zonename", "surfacename", "systemnodename"]
    return " UNION ALL ".join(
        f"""SELECT l_orderkey AS buildingid, {_TIME_SQL} AS datetime, 15 AS timeresolution,
            '{variable}' AS variablename,
            {", ".join(f"'{name if c == column else 'NA'}' AS {c}" for c in subs)},
            {cell} AS value FROM lineitem"""
        for name, cell in cells.items()
    )


@query(_long_sql("Zone Mean Air Temperature", "zonename", _CELLS))
def q_wide_to_long(spark, sf_dir):
    return to_long(_wide_lineitem(spark, sf_dir), "Zone_Mean_Air_Temperature", 2000, 15)


_FAMILIES = {
    "Schedule_Value": "schedulename",
    "Surface_Inside_Face_Temperature": "surfacename",
    "System_node_Temperature": "systemnodename",
    "Site_Outdoor_Air_Drybulb_Temperature": None,
    "Facility_Total_HVAC_Electric_Demand_Power": None,
}


@query(
    " UNION ALL ".join(
        _long_sql(v.replace("_", " "), c, _CELLS if c else {"NA": "l_quantity"})
        for v, c in _FAMILIES.items()
    )
)
def q_wide_families(spark, sf_dir):
    wide = _wide_lineitem(spark, sf_dir)
    # the first is of an unknown family and has no rows
    return to_long(wide, ["Boiler_Rate", *_FAMILIES], 2000, 15)


@query(f"""
    SELECT buildingid, datetime, zonename,
           CAST(max(value) FILTER (variablename = 'Zone click') AS DOUBLE) AS "Zone click",
           CAST(max(value) FILTER (variablename = 'Zone view') AS DOUBLE) AS "Zone view"
    FROM {s.ZONE_SERIES_SQL} GROUP BY ALL""")
def q_pivot_variables(spark, sf_dir):
    return pivot_variables(
        s.zone_series(spark, sf_dir),
        ["buildingid", "datetime", "zonename"],
        ["Zone click", "Zone view"],
        how=F.max,
    )


_NAME_SQL = """CASE event_type WHEN 'click' THEN 'Zone_Mean_Air_' || user_id || '.csv'
    WHEN 'view' THEN 'Surface_Inside_Face' WHEN 'purchase' THEN 'System_node_Temp'
    WHEN 'error' THEN CASE WHEN value < 20 THEN 'Schedule_Value' ELSE 'Boiler_Rate' END
    ELSE CASE WHEN value < 20 THEN 'Facility_Total' ELSE ' Site Outdoor' END END"""


@query(f"""
    WITH n AS (SELECT event_id, trim(replace(replace({_NAME_SQL}, '_', ' '), '.csv', '')) AS variablename
               FROM events)
    SELECT event_id, variablename,
           CASE WHEN variablename = 'Schedule Value' THEN 'schedule'
                WHEN variablename LIKE 'Facility%' OR variablename LIKE 'Site%' THEN 'site'
                WHEN variablename LIKE 'Zone%' THEN 'zone'
                WHEN variablename LIKE 'Surface%' THEN 'surface'
                WHEN variablename LIKE 'System node%' THEN 'node' END AS family
    FROM n""")
def q_variable_family(spark, sf_dir):
    kind, small = F.col("event_type"), F.col("value") < 20
    name = (
        F.when(kind == "click", F.concat(F.lit("Zone_Mean_Air_"), "user_id", F.lit(".csv")))
        .when(kind == "view", "Surface_Inside_Face")
        .when(kind == "purchase", "System_node_Temp")
        .when((kind == "error") & small, "Schedule_Value")
        .when(kind == "error", "Boiler_Rate")
        .when(small, "Facility_Total")
        .otherwise(" Site Outdoor")
    )
    return table(spark, sf_dir, "events").select(
        "event_id", normalise_variable(name).alias("variablename"), variable_family(name).alias("family")
    )


@query("SELECT p_partkey, trim(split_part(' ' || p_name || ' :' || p_type || ':x', ':', 1)) AS subvariable FROM part")
def q_subvariable(spark, sf_dir):
    header = F.concat(F.lit(" "), "p_name", F.lit(" :"), "p_type", F.lit(":x"))
    return table(spark, sf_dir, "part").select("p_partkey", subvariable(header).alias("subvariable"))


@query("""
    SELECT o_orderkey, date_trunc('day', o_orderdate)::TIMESTAMP + to_hours(1 + o_orderkey % 24)
           AS datetime FROM orders""")
def q_format_datetime(spark, sf_dir):
    hour = (F.lit(1) + F.col("o_orderkey") % 24).cast("int")
    text = F.format_string(" %d/%02d  %02d:00:00", F.month("o_orderdate"), F.day("o_orderdate"), hour)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", format_datetime(F.year("o_orderdate"), text).alias("datetime")
    )


@query(f"""
    SELECT timeseriesdataid, buildingid, zonename, datetime, value FROM {s.FACTS_SQL}
    WHERE variablename = 'Zone Mean Air Temperature' AND zonename = 'Z9' AND timeresolution = 60
      AND datetime >= TIMESTAMP '2024-01-03 00:00:00' AND datetime <= TIMESTAMP '2024-01-25 12:00:00'""")
def q_retrieve_ts(spark, sf_dir):
    return retrieve_timeseries(
        s.facts(spark, sf_dir),
        start="2024-01-03 00:00:00",
        end="2024-01-25 12:00:00",
        timeresolution=60,
        variable="Zone Mean Air Temperature",
        subvariabletype="zonename",
        subvariable="Z9",
    )


@query(f"""
    SELECT timeseriesdataid, variablename, datetime, value FROM {s.FACTS_SQL}
    WHERE buildingid = 8""")
def q_retrieve_building(spark, sf_dir):
    return retrieve_timeseries(
        s.facts(spark, sf_dir), buildingid=8, subvariabletype="zonename", subvariable="NA"
    )


@query(f"""
    SELECT timeseriesdataid, variablename, zonename, datetime, value FROM {s.FACTS_SQL}
    WHERE zonename IN ('Z9', 'NA')
      AND datetime >= TIMESTAMP '2024-01-02 00:00:00' AND datetime <= TIMESTAMP '2024-01-20 00:00:00'""")
def q_training_set(spark, sf_dir):
    return training_rows(
        s.facts(spark, sf_dir), None, "2024-01-02 00:00:00", "2024-01-20 00:00:00", "Z9"
    )


# A batch with empty cells and, for purchases, every row twice; stored are the
# rows of the first half of the month, with other values for views.
_COLS = ", ".join(s.FACT_COLUMNS)
_BATCH_SQL = f"""(
    SELECT * REPLACE (CASE WHEN schedulename <> 'NA' THEN NULL ELSE value END AS value)
    FROM (SELECT {_COLS} FROM {s.FACTS_SQL}
          UNION ALL SELECT {_COLS} FROM {s.FACTS_SQL} WHERE systemnodename <> 'NA'))"""
_STORED_SQL = f"""(
    SELECT * REPLACE (CASE WHEN schedulename <> 'NA' THEN NULL
                           WHEN surfacename <> 'NA' THEN value + 1 ELSE value END AS value)
    FROM (SELECT {_COLS} FROM {s.FACTS_SQL}) WHERE datetime < TIMESTAMP '2024-01-15 00:00:00')"""


def _batch(spark, sf_dir):
    rows = s.facts(spark, sf_dir).select(*s.FACT_COLUMNS)
    rows = rows.unionByName(rows.filter("systemnodename <> 'NA'"))
    return rows.withColumn("value", F.when(F.col("schedulename") == "NA", F.col("value")))


def _stored(spark, sf_dir):
    rows = s.facts(spark, sf_dir).select(*s.FACT_COLUMNS)
    value = F.when(F.col("surfacename") != "NA", F.col("value") + 1).when(
        F.col("schedulename") == "NA", F.col("value")
    )
    return rows.filter("datetime < timestamp_ntz'2024-01-15 00:00:00'").withColumn("value", value)


@query(
    f"SELECT {_COLS} FROM {_BATCH_SQL} b WHERE NOT EXISTS (SELECT 1 FROM {_STORED_SQL} e WHERE "
    + " AND ".join(f"e.{c} IS NOT DISTINCT FROM b.{c}" for c in s.FACT_COLUMNS)
    + ")"
)
def q_new_rows(spark, sf_dir):
    return loading.new_rows(_batch(spark, sf_dir), _stored(spark, sf_dir))


_MARKS_SQL = f"""(
    SELECT buildingid, variablename, subvariable, max(datetime) AS last_datetime
    FROM {s.KEYED_SQL} WHERE datetime < TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL)"""


@query(f"""
    SELECT k.* FROM {s.KEYED_SQL} k LEFT JOIN {_MARKS_SQL} m USING (buildingid, variablename, subvariable)
    WHERE m.last_datetime IS NULL OR k.datetime > m.last_datetime""")
def q_after_watermark(spark, sf_dir):
    series = s.keyed_series(spark, sf_dir)
    marks = loading.last_datetime(series.filter("datetime < timestamp_ntz'2024-01-15 00:00:00'"))
    return loading.after_watermark(series, marks)


_LEDGER_SQL = f"""(
    SELECT buildingid, variablename, subvariable, max(datetime) AS last_datetime,
           CAST(count(*) AS BIGINT) AS n_rows,
           CASE WHEN max(datetime) < TIMESTAMP '2024-01-25 00:00:00' THEN 'Upload Completed'
                ELSE 'Upload Started' END AS status,
           CAST(floor(epoch(max(datetime) - min(datetime))) AS BIGINT) AS elapsed_seconds
    FROM {s.KEYED_SQL} GROUP BY ALL)"""


def _ledger(spark, sf_dir):
    last, first = F.max("datetime"), F.min("datetime")
    return (
        s.keyed_series(spark, sf_dir)
        .groupBy("buildingid", "variablename", "subvariable")
        .agg(
            last.alias("last_datetime"),
            F.count(F.lit(1)).alias("n_rows"),
            F.when(last < F.lit("2024-01-25").cast("timestamp_ntz"), "Upload Completed")
            .otherwise("Upload Started")
            .alias("status"),
            F.timestamp_diff("SECOND", first, last).alias("elapsed_seconds"),
        )
    )


@query(f"""
    SELECT k.* FROM {s.KEYED_SQL} k ANTI JOIN
        (SELECT * FROM {_LEDGER_SQL} WHERE status = 'Upload Completed') l
        USING (buildingid, variablename, subvariable)""")
def q_not_loaded(spark, sf_dir):
    return loading.not_loaded(s.keyed_series(spark, sf_dir), _ledger(spark, sf_dir))


@query(f"""
    SELECT DISTINCT k.buildingid, k.variablename FROM {s.KEYED_SQL} k ANTI JOIN
        (SELECT * FROM {_LEDGER_SQL} WHERE status = 'Upload Completed') l
        USING (buildingid, variablename)""")
def q_not_loaded_variables(spark, sf_dir):
    keys = s.keyed_series(spark, sf_dir).select("buildingid", "variablename").distinct()
    return loading.not_loaded(keys, _ledger(spark, sf_dir), ["buildingid", "variablename"])


@query(f"""
    SELECT buildingid, variablename, subvariable, max(datetime) AS last_datetime
    FROM {s.KEYED_SQL} GROUP BY ALL""")
def q_last_datetime(spark, sf_dir):
    return loading.last_datetime(s.keyed_series(spark, sf_dir))


@query(f"""
    SELECT buildingid, variablename, arg_max(last_datetime, timeseriesdataid) AS last_datetime,
           arg_max(value, timeseriesdataid) AS value
    FROM (SELECT *, datetime AS last_datetime FROM {s.KEYED_SQL}) GROUP BY ALL""")
def q_last_ledger_line(spark, sf_dir):
    lines = s.keyed_series(spark, sf_dir).withColumnRenamed("datetime", "last_datetime")
    return loading.last_ledger_line(
        lines, ["buildingid", "variablename"], "timeseriesdataid", ["last_datetime", "value"]
    )


@query(f"""
    SELECT buildingid,
           CASE WHEN bool_and(status = 'Upload Completed') THEN 'Complete' ELSE 'Incomplete' END
               AS building_status
    FROM {_LEDGER_SQL} GROUP BY buildingid""")
def q_building_status(spark, sf_dir):
    return loading.building_status(_ledger(spark, sf_dir))


@query(f"""
    SELECT buildingid, CAST(count(elapsed_seconds) AS BIGINT) AS n_loads,
           round(avg(elapsed_seconds), 6) AS avg_seconds, max(elapsed_seconds) AS max_seconds,
           printf('%02d:%02d:%02d', CAST(max(elapsed_seconds) // 3600 AS BIGINT),
                  CAST(max(elapsed_seconds) % 3600 // 60 AS BIGINT),
                  CAST(max(elapsed_seconds) % 60 AS BIGINT)) AS longest
    FROM {_LEDGER_SQL} GROUP BY buildingid""")
def q_load_durations(spark, sf_dir):
    out = loading.load_durations(_ledger(spark, sf_dir))
    return out.withColumn("avg_seconds", F.round("avg_seconds", 6))


@query("""
    SELECT o_orderkey, printf('%02d:%02d:%02d', CAST(floor(o_totalprice) AS BIGINT) // 3600,
           CAST(floor(o_totalprice) AS BIGINT) % 3600 // 60, CAST(floor(o_totalprice) AS BIGINT) % 60)
           AS duration FROM orders""")
def q_hhmmss(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", seconds_to_hhmmss(F.col("o_totalprice")).alias("duration")
    )


@query(f"""
    SELECT buildingid, variablename, subvariable,
           CASE WHEN value > 40 THEN 'Upload Completed' ELSE coalesce(o.status, 'None') END AS status,
           o.last_datetime, coalesce(o.n_rows, -1) AS n_rows,
           CASE WHEN value > 40 THEN CAST(floor(value) AS BIGINT) ELSE coalesce(o.elapsed_seconds, -1) END AS elapsed_seconds
    FROM (SELECT * FROM {_LEDGER_SQL} WHERE n_rows > 1) o
    FULL JOIN (SELECT buildingid, variablename, subvariable, max(value) AS value
               FROM {s.KEYED_SQL} WHERE datetime >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY ALL) u
    USING (buildingid, variablename, subvariable)""")
def q_ledger_upsert(spark, sf_dir):
    value = F.max("value")
    updates = (
        s.keyed_series(spark, sf_dir)
        .filter("datetime >= timestamp_ntz'2024-01-10 00:00:00'")
        .groupBy("buildingid", "variablename", "subvariable")
        .agg(
            F.when(value > 40, "Upload Completed").alias("status"),
            F.when(value > 40, F.floor(value)).alias("elapsed_seconds"),
        )
    )
    out = loading.upsert_ledger(_ledger(spark, sf_dir).filter("n_rows > 1"), updates)
    return out.fillna(-1, ["n_rows", "elapsed_seconds"])


@query("""
    SELECT o_orderkey, o_custkey AS buildingid, o_totalprice FROM orders
    ANTI JOIN (SELECT c_custkey AS o_custkey FROM customer WHERE c_acctbal > 3000) USING (o_custkey)""")
def q_fk_orphans(spark, sf_dir):
    return loading.orphans(*_orders_and_customers(spark, sf_dir))


@query("""
    SELECT o_orderkey, o_custkey AS buildingid, o_totalprice FROM orders
    SEMI JOIN (SELECT c_custkey AS o_custkey FROM customer WHERE c_acctbal > 3000) USING (o_custkey)""")
def q_fk_valid(spark, sf_dir):
    return loading.with_building(*_orders_and_customers(spark, sf_dir))


def _orders_and_customers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("buildingid"), "o_totalprice"
    )
    customers = table(spark, sf_dir, "customer").filter("c_acctbal > 3000")
    return orders, customers.select(F.col("c_custkey").alias("buildingid"))


_LABEL_SQL = "'Aggregation_Zone_' || aggregation_zone"


@query(f"""
    SELECT buildingid, {_LABEL_SQL} AS zonename, variablename, datetime, round(avg(value), 8) AS mean,
           round(sum(value), 6) AS sum, min(value) AS min, max(value) AS max
    FROM {s.DAILY_SQL} JOIN {s.ZONE_MAP_SQL} USING (buildingid, zonename) GROUP BY ALL""")
def q_zone_aggregate(spark, sf_dir):
    out = aggregate.aggregate_zones(
        s.daily_zone_series(spark, sf_dir), s.zone_map(spark, sf_dir), ["mean", "sum", "min", "max"]
    )
    return out.withColumns({"mean": F.round("mean", 8), "sum": F.round("sum", 6)})


@query(f"""
    SELECT buildingid, {_LABEL_SQL} AS zonename, variablename, datetime, round(avg(value), 8) AS value
    FROM {s.DAILY_SQL} JOIN {s.ZONE_MAP_SQL} USING (buildingid, zonename) GROUP BY ALL""")
def q_zone_mean(spark, sf_dir):
    out = aggregate.aggregate_zones(s.daily_zone_series(spark, sf_dir), s.zone_map(spark, sf_dir))
    return out.withColumn("value", F.round("value", 8))


# Report rows that give each zone of the series its size; large zones have none.
_SIZES_SQL = f"""(
    SELECT user_id AS buildingid, {s.ZONE_SQL} AS zonename, max(value) AS w
    FROM events GROUP BY ALL)"""
_WEIGHT = "CASE WHEN w < 60 THEN CAST(CAST(w AS FLOAT) AS DOUBLE) END"


def _sizes(spark, sf_dir):
    return (
        s.zone_series(spark, sf_dir)
        .groupBy("buildingid", "zonename")
        .agg(F.max("value").alias("w"))
        .select(
            "buildingid",
            F.lit("Zone Information").alias("tablename"),
            "zonename",
            F.lit("Floor Area {m2}").alias("variablename"),
            F.when(F.col("w") < 60, F.col("w").cast("float")).alias("floatvalue"),
        )
    )


@query(f"""
    SELECT buildingid, {_LABEL_SQL} AS zonename, variablename, datetime,
           round(sum(value * {_WEIGHT}) / sum({_WEIGHT}), 6) AS value
    FROM {s.DAILY_SQL} JOIN {s.ZONE_MAP_SQL} USING (buildingid, zonename)
         JOIN {_SIZES_SQL} USING (buildingid, zonename) GROUP BY ALL""")
def q_zone_weighted(spark, sf_dir):
    weights = aggregate.zone_weights(_sizes(spark, sf_dir))
    out = aggregate.aggregate_zones(
        s.daily_zone_series(spark, sf_dir), s.zone_map(spark, sf_dir), "area_weighted", weights
    )
    return out.withColumn("value", F.round("value", 6))


@query(f"""
    SELECT buildingid, zonename, CAST(max(CASE WHEN w < 60 THEN CAST(w AS FLOAT) END) AS DOUBLE) AS area,
           CAST(NULL AS DOUBLE) AS volume
    FROM {_SIZES_SQL} GROUP BY ALL""")
def q_zone_weights(spark, sf_dir):
    return aggregate.zone_weights(_sizes(spark, sf_dir))


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(f"""
    SELECT buildingid, {_LABEL_SQL} AS zonename, datetime,
           {", ".join(f"max(value) FILTER (variablename = 'Zone {t}') AS {t}" for t in _TYPES)}
    FROM {s.DAILY_SQL} JOIN {s.ZONE_MAP_SQL} USING (buildingid, zonename) GROUP BY ALL""")
def q_zone_pivot(spark, sf_dir):
    wide = aggregate.aggregate_zone_table(
        s.daily_zone_series(spark, sf_dir), s.zone_map(spark, sf_dir), [f"Zone {t}" for t in _TYPES], "max"
    )
    return wide.select(
        "buildingid", "zonename", "datetime", *[F.col(f"Zone {t}").alias(t) for t in _TYPES]
    )


@query(f"""
    SELECT buildingid, {_LABEL_SQL} AS zonename, datetime,
           {", ".join(f"round(sum(value * {_WEIGHT}) FILTER (variablename = 'Zone {t}') / sum({_WEIGHT}) FILTER (variablename = 'Zone {t}'), 6) AS {t}" for t in _TYPES)}
    FROM {s.DAILY_SQL} JOIN {s.ZONE_MAP_SQL} USING (buildingid, zonename)
         JOIN {_SIZES_SQL} USING (buildingid, zonename) GROUP BY ALL""")
def q_zone_weighted_pivot(spark, sf_dir):
    """Weighted zone means with one column per variable, in one shuffle of the series."""
    wide = aggregate.aggregate_zone_table(
        s.daily_zone_series(spark, sf_dir),
        s.zone_map(spark, sf_dir),
        [f"Zone {t}" for t in _TYPES],
        "area_weighted",
        weights=aggregate.zone_weights(_sizes(spark, sf_dir)),
    )
    return wide.select(
        "buildingid", "zonename", "datetime", *[F.round(F.col(f"Zone {t}"), 6).alias(t) for t in _TYPES]
    )


@query(f"""
    SELECT buildingid, datetime,
           max(value) FILTER (variablename = 'Zone Mean Air Temperature') AS zone_temperature,
           max(value) FILTER (variablename = 'Site Outdoor Air Drybulb Temperature') AS site_temperature
    FROM (SELECT f.buildingid, date_trunc('day', f.datetime)::TIMESTAMP AS datetime, f.variablename, f.value
          FROM {s.FACTS_SQL} f LEFT JOIN {s.ZONE_MAP_SQL} z
               ON f.buildingid = z.buildingid AND f.zonename = z.zonename
          WHERE (z.aggregation_zone = 2 OR (f.zonename = 'NA' AND f.schedulename = 'NA'
                 AND f.surfacename = 'NA' AND f.systemnodename = 'NA'))
            AND f.datetime >= TIMESTAMP '2024-01-02 00:00:00'
            AND f.datetime < TIMESTAMP '2024-01-28 00:00:00')
    GROUP BY ALL""")
def q_build_training_set(spark, sf_dir):
    facts = s.facts(spark, sf_dir)
    # one value per zone, variable and day
    daily = (
        facts.withColumn("datetime", F.date_trunc("day", "datetime").cast("timestamp_ntz"))
        .groupBy(*[c for c in LONG_COLUMNS if c not in ("value", "timeresolution")])
        .agg(F.max("value").alias("value"))
    )
    out = build_training_set(
        daily,
        s.zone_map(spark, sf_dir),
        None,
        "2024-01-02 00:00:00",
        "2024-01-27 00:00:00",
        2,
        ["Zone Mean Air Temperature", "Site Outdoor Air Drybulb Temperature"],
        how="max",
    )
    return out.select(
        "buildingid",
        "datetime",
        F.col("Zone Mean Air Temperature").alias("zone_temperature"),
        F.col("Site Outdoor Air Drybulb Temperature").alias("site_temperature"),
    )


# Surfaces and nodes have their own map: ten to a zone.
_SURFACE_MAP_SQL = f"""(
    SELECT DISTINCT buildingid, surfacename,
           CAST(floor(CAST(substr(surfacename, 2) AS INTEGER) / 10) AS INTEGER) + 1 AS aggregation_zone
    FROM {s.FACTS_SQL} WHERE surfacename <> 'NA')"""


@query(f"""
    SELECT buildingid, {_LABEL_SQL} AS zonename, variablename,
           date_trunc('day', datetime)::TIMESTAMP AS datetime, max(value) AS value
    FROM {s.FACTS_SQL} JOIN {_SURFACE_MAP_SQL} USING (buildingid, surfacename) GROUP BY ALL""")
def q_surface_aggregate(spark, sf_dir):
    daily = s.facts(spark, sf_dir).withColumn(
        "datetime", F.date_trunc("day", "datetime").cast("timestamp_ntz")
    )
    number = F.substring("surfacename", F.lit(2), F.length("surfacename")).try_cast("int")
    mapping = (
        daily.filter("surfacename <> 'NA'")
        .select("buildingid", "surfacename")
        .distinct()
        .withColumn("aggregation_zone", (F.floor(number / 10) + 1).cast("int"))
    )
    return aggregate.aggregate_zones(daily, mapping, "max", name="surfacename")
