"""The given tables read as simulation data.

``events`` stands for series: user = building, event type = variable, the
number in ``props`` = zone.  ``part`` stands for report rows: size = building,
type = report section, name = zone.  Each frame has its SQL twin.
"""

from pyspark.sql import functions as F

from ..schemas import NA
from .registry import table

ZONE_SQL = "'Z' || json_extract_string(props, '$.k')"


def _zone():
    return F.concat(F.lit("Z"), F.get_json_object("props", "$.k"))


def zone_series(spark, sf_dir):
    """Every event as a zone series value."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("buildingid"),
        F.col("ts").alias("datetime"),
        F.concat(F.lit("Zone "), F.col("event_type")).alias("variablename"),
        _zone().alias("zonename"),
        "value",
    )


ZONE_SERIES_SQL = f"""(
    SELECT user_id AS buildingid, ts AS datetime, 'Zone ' || event_type AS variablename,
           {ZONE_SQL} AS zonename, value
    FROM events)"""


def daily_zone_series(spark, sf_dir):
    """Zone series with the time cut to the day, so that zones share times."""
    return zone_series(spark, sf_dir).withColumn(
        "datetime", F.date_trunc("day", "datetime").cast("timestamp_ntz")
    )


DAILY_SQL = f"(SELECT * REPLACE (date_trunc('day', datetime)::TIMESTAMP AS datetime) FROM {ZONE_SERIES_SQL})"


def zone_map(spark, sf_dir):
    """Four aggregation zones per building, by the zone's number."""
    zones = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("buildingid"), _zone().alias("zonename")
    )
    number = F.substring("zonename", F.lit(2), F.length("zonename")).try_cast("int")
    return zones.distinct().withColumn(
        "aggregation_zone", (F.floor(number / 25) + 1).cast("int")
    )


ZONE_MAP_SQL = f"""(
    SELECT DISTINCT user_id AS buildingid, {ZONE_SQL} AS zonename,
           CAST(floor(CAST(json_extract_string(props, '$.k') AS INTEGER) / 25) AS INTEGER) + 1
               AS aggregation_zone
    FROM events)"""


def facts(spark, sf_dir):
    """Events as time-series facts; the event type decides the family."""
    kind = F.col("event_type")

    def sub(name):
        return F.when(kind == name, _zone()).otherwise(F.lit(NA))

    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("timeseriesdataid"),
        F.col("user_id").alias("buildingid"),
        F.col("ts").alias("datetime"),
        F.when(F.col("value") < 20, 5).otherwise(60).alias("timeresolution"),
        F.when(kind == "click", "Zone Mean Air Temperature")
        .when(kind == "view", "Surface Inside Face Temperature")
        .when(kind == "purchase", "System node Temperature")
        .when(kind == "error", "Schedule Value")
        .otherwise("Site Outdoor Air Drybulb Temperature")
        .alias("variablename"),
        sub("error").alias("schedulename"),
        sub("click").alias("zonename"),
        sub("view").alias("surfacename"),
        sub("purchase").alias("systemnodename"),
        "value",
    )


def _sub_sql(name):
    return f"CASE WHEN event_type = '{name}' THEN {ZONE_SQL} ELSE 'NA' END"


FACTS_SQL = f"""(
    SELECT event_id AS timeseriesdataid, user_id AS buildingid, ts AS datetime,
           CASE WHEN value < 20 THEN 5 ELSE 60 END AS timeresolution,
           CASE event_type WHEN 'click' THEN 'Zone Mean Air Temperature'
                WHEN 'view' THEN 'Surface Inside Face Temperature'
                WHEN 'purchase' THEN 'System node Temperature'
                WHEN 'error' THEN 'Schedule Value'
                ELSE 'Site Outdoor Air Drybulb Temperature' END AS variablename,
           {_sub_sql('error')} AS schedulename, {_sub_sql('click')} AS zonename,
           {_sub_sql('view')} AS surfacename, {_sub_sql('purchase')} AS systemnodename,
           value
    FROM events)"""

FACT_COLUMNS = [
    "buildingid",
    "datetime",
    "timeresolution",
    "variablename",
    "schedulename",
    "zonename",
    "surfacename",
    "systemnodename",
    "value",
]


def keyed_series(spark, sf_dir):
    """Facts with the ledger's key columns."""
    sub = F.coalesce(
        *[
            F.when(F.col(c) != NA, F.col(c))
            for c in ("schedulename", "zonename", "surfacename", "systemnodename")
        ],
        F.lit(NA),
    )
    return facts(spark, sf_dir).select(
        "timeseriesdataid", "buildingid", "variablename", sub.alias("subvariable"), "datetime", "value"
    )


KEYED_SQL = f"""(
    SELECT timeseriesdataid, buildingid, variablename,
           coalesce(nullif(schedulename, 'NA'), nullif(zonename, 'NA'),
                    nullif(surfacename, 'NA'), nullif(systemnodename, 'NA'), 'NA') AS subvariable,
           datetime, value
    FROM {FACTS_SQL})"""

# Report section of each part type.
SECTION = {
    "ECONOMY": "Zone Information",
    "STANDARD": "People Internal Gains Nominal",
    "LARGE": "Lights Internal Gains Nominal",
    "MEDIUM": "ElectricEquipment Internal Gains Nominal",
    "SMALL": "GasEquipment Internal Gains Nominal",
    "PROMO": "OtherEquipment Internal Gains Nominal",
}


def section():
    return F.coalesce(*[F.when(F.col("p_type") == k, v) for k, v in SECTION.items()])


SECTION_SQL = (
    "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SECTION.items()) + " END"
)

# Report columns next to the zone: name and the text of its cell.
REPORT_CELLS = {
    "Name": "p_brand",
    "Schedule Name": "'S' || CAST(p_size AS VARCHAR)",
    "Number": "CAST(p_size AS VARCHAR)",
    "Floor Area {m2}": "CAST(p_retailprice AS VARCHAR)",
}
_REPORT_TEXT = {
    "Name": lambda: F.col("p_brand"),
    "Schedule Name": lambda: F.concat(F.lit("S"), F.col("p_size").cast("string")),
    "Number": lambda: F.col("p_size").cast("string"),
    "Floor Area {m2}": lambda: F.col("p_retailprice").cast("string"),
}


def report_sections(spark, sf_dir):
    """Parts as padded section rows: zone in the second of five columns."""
    names = list(REPORT_CELLS)
    header = [names[0], "Zone Name", *names[1:]]
    cells = [
        F.concat(F.lit(" "), F.col("p_name")) if n == "Zone Name" else _REPORT_TEXT[n]()
        for n in header
    ]
    return table(spark, sf_dir, "part").select(
        F.col("p_size").cast("long").alias("buildingid"),
        section().alias("tablename"),
        F.array(*[F.lit(h) for h in header]).alias("header"),
        F.array(*cells).alias("cells"),
    )


_NUMBERS = ["Number", "Floor Area {m2}"]
REPORT_SQL = (
    "("
    + " UNION ALL ".join(
        f"""SELECT CAST(p_size AS BIGINT) AS buildingid, {SECTION_SQL} AS tablename,
            p_name AS zonename, '{name}' AS variablename,
            {"'NA'" if name in _NUMBERS else cell} AS stringvalue,
            {f"CAST(CAST({cell} AS FLOAT) AS DOUBLE)" if name in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS floatvalue
            FROM part"""
        for name, cell in REPORT_CELLS.items()
    )
    + ")"
)
REPORT_COLUMNS = [
    "buildingid", "tablename", "zonename", "variablename", "stringvalue", "floatvalue",
]
