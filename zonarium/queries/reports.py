"""Queries on report rows."""

from pyspark.sql import functions as F

from ..operators import aggregate, reports
from ..operators.retrieve import retrieve_eio
from . import standins as s
from .registry import query, table


def _report(spark, sf_dir):
    return reports.sections_to_long(s.report_sections(spark, sf_dir), keys=("buildingid",))


def _double(df):
    return df.withColumn("floatvalue", F.col("floatvalue").cast("double"))


@query(f"SELECT * FROM {s.REPORT_SQL}")
def q_eio_to_long(spark, sf_dir):
    return _double(_report(spark, sf_dir))


@query("""
    SELECT p_partkey, CASE WHEN number THEN 'NA' ELSE cell END AS stringvalue,
           CASE WHEN number THEN CAST(trim(replace(cell, '_', '')) AS DOUBLE) END AS floatvalue
    FROM (SELECT p_partkey, cell, regexp_matches(cell, '^\\s*[+-]?((\\d[\\d_]*\\.?[\\d_]*|\\.\\d[\\d_]*)([eE][+-]?\\d+)?)\\s*$') AS number
          FROM (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_brand
                     WHEN 'STANDARD' THEN ' ' || p_size || 'e2 ' WHEN 'LARGE' THEN p_size || '_000'
                     WHEN 'MEDIUM' THEN '-.' || p_size WHEN 'SMALL' THEN p_size || '.0f'
                     ELSE CAST(p_retailprice AS VARCHAR) END AS cell FROM part))""".replace("\\\\", "\\"))
def q_number_or_text(spark, sf_dir):
    from ..functions.scalars import number_or_text

    size = F.col("p_size").cast("string")
    kind = F.col("p_type")
    cell = (
        F.when(kind == "ECONOMY", F.col("p_brand"))
        .when(kind == "STANDARD", F.concat(F.lit(" "), size, F.lit("e2 ")))
        .when(kind == "LARGE", F.concat(size, F.lit("_000")))
        .when(kind == "MEDIUM", F.concat(F.lit("-."), size))
        .when(kind == "SMALL", F.concat(size, F.lit(".0f")))
        .otherwise(F.col("p_retailprice").cast("string"))
    )
    text, number = number_or_text(cell, "double")
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.alias("stringvalue"), number.alias("floatvalue")
    )


@query(f"""
    SELECT zonename, variablename, stringvalue, floatvalue FROM {s.REPORT_SQL}
    WHERE buildingid = 11 AND tablename = 'People Internal Gains Nominal'""")
def q_retrieve_eio(spark, sf_dir):
    return _double(
        retrieve_eio(_report(spark, sf_dir), buildingid=11, tablename="People Internal Gains Nominal")
    )


@query(f"""
    SELECT buildingid, tablename, zonename, stringvalue, floatvalue FROM {s.REPORT_SQL}
    WHERE variablename = 'Name'""")
def q_retrieve_eio_variable(spark, sf_dir):
    return _double(retrieve_eio(_report(spark, sf_dir), variablename="Name"))


# Report lines written from the parts: per file (size) and section an old
# header, the header that counts, and one data line per part.  Red parts lack
# the last cell, blue parts end with a blank cell, new parts have a cell more.
def report_lines(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.concat(F.lit("run"), F.col("p_size").cast("string")).alias("file"),
        s.section().alias("tablename"),
        F.col("p_partkey").alias("line_no"),
        "p_brand",
        "p_name",
        F.col("p_retailprice").cast("string").alias("price"),
    )
    sections = part.select("file", "tablename").distinct()
    headers = sections.select(
        "file",
        F.explode(
            F.array(
                F.struct(
                    F.lit(-2).cast("long").alias("line_no"),
                    F.concat(F.lit("! <"), "tablename", F.lit(">,Zone Name,Old")).alias("value"),
                ),
                F.struct(
                    F.lit(-1).cast("long").alias("line_no"),
                    F.concat(
                        F.lit("! <"), "tablename", F.lit(">,Name, Zone Name,Level {W},Note, ")
                    ).alias("value"),
                ),
            )
        ).alias("h"),
    ).select("file", "h.line_no", "h.value")
    name = F.col("p_name")
    tail = (
        F.when(name.startswith("red "), F.lit(""))
        .when(name.startswith("blue "), F.lit(",note, "))
        .when(name.startswith("new "), F.lit(",note,more"))
        .otherwise(F.lit(",note"))
    )
    body = part.select(
        "file",
        "line_no",
        F.concat(
            F.lit(" "), "tablename", F.lit(","), "p_brand", F.lit(","), name, F.lit(" ,"), "price", tail
        ).alias("value"),
    )
    return headers.unionByName(body)


_PARSED_SQL = f"""
    SELECT 'run' || p_size AS file, {s.SECTION_SQL} AS tablename, p_partkey AS line_no,
           p_brand || '|' || p_name || ' |' || CAST(p_retailprice AS VARCHAR) || '|'
           || CASE WHEN p_name LIKE 'red %' THEN 'NA' ELSE 'note' END AS cells
    FROM part WHERE p_name NOT LIKE 'new %'"""


@query(_PARSED_SQL)
def q_eio_sections(spark, sf_dir):
    padded = reports.pad_sections(reports.match_sections(report_lines(spark, sf_dir)))
    return padded.select("file", "tablename", "line_no", F.concat_ws("|", "cells").alias("cells"))


@query(f"""
    SELECT 'run' || p_size AS file, {s.SECTION_SQL} AS tablename, p_partkey AS line_no,
           'row longer than header' AS reason
    FROM part WHERE p_name LIKE 'new %'""")
def q_eio_quarantine(spark, sf_dir):
    matched = reports.match_sections(report_lines(spark, sf_dir))
    return reports.quarantined(matched).drop("cells")


_RC = ", ".join(s.REPORT_COLUMNS)


@query(
    f"""SELECT DISTINCT {_RC} FROM {s.REPORT_SQL} b WHERE NOT EXISTS (
        SELECT 1 FROM (SELECT * FROM {s.REPORT_SQL} WHERE zonename LIKE '%ring' OR floatvalue < 30) e WHERE """
    + " AND ".join(f"e.{c} IS NOT DISTINCT FROM b.{c}" for c in s.REPORT_COLUMNS)
    + ")"
)
def q_new_eio_rows(spark, sf_dir):
    batch = _report(spark, sf_dir)
    stored = batch.filter("zonename like '%ring' or floatvalue < 30")
    return _double(reports.new_report_rows(batch, stored))


def _zone_lines(spark, sf_dir):
    """One zone line of 31 cells per part; the flag is ``Yes``, ``No`` or `` No``."""
    kind = F.col("p_type")
    flag = F.when(kind == "SMALL", "No").when(kind == "LARGE", " No").otherwise("Yes")
    filler = F.array_repeat(F.col("p_size").cast("string"), 26)
    cells = F.concat(
        F.array(F.lit(" Zone Information"), F.concat(F.lit(" "), "p_name"), F.col("p_brand")),
        filler,
        F.array(flag, F.lit("end ")),
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("run"), F.col("p_size").cast("string")).alias("file"),
        F.col("p_partkey").alias("line_no"),
        F.array_join(cells, ",").alias("value"),
    )


@query("""
    SELECT p_partkey AS line_no, 'Zone Information|' || p_name || '|' || p_brand || '|'
           || repeat(p_size || '|', 26) || 'Yes|end' AS cells
    FROM part WHERE p_type NOT IN ('SMALL', 'LARGE')""")
def q_zone_info(spark, sf_dir):
    kept = reports.zone_information(reports.zone_table_rows(_zone_lines(spark, sf_dir)))
    return kept.select("line_no", F.concat_ws("|", "cells").alias("cells"))


@query("""
    SELECT 'run' || p_size AS file, CAST(count(*) + count(*) FILTER (p_type = 'PROMO') AS BIGINT) AS announced,
           CAST(count(*) AS BIGINT) AS found
    FROM part GROUP BY p_size""")
def q_zone_count(spark, sf_dir):
    zones = _zone_lines(spark, sf_dir)
    counts = (
        table(spark, sf_dir, "part")
        .groupBy("p_size")
        .agg((F.count(F.lit(1)) + F.count_if(F.col("p_type") == "PROMO")).alias("n"))
        .select(
            F.concat(F.lit("run"), F.col("p_size").cast("string")).alias("file"),
            F.lit(-1).cast("long").alias("line_no"),
            F.concat(F.lit(" Zone Summary,"), F.col("n").cast("string")).alias("value"),
        )
    )
    return reports.zone_count_check(zones.unionByName(counts))


_MAP_SQL = """(SELECT DISTINCT CAST(p_size AS BIGINT) AS buildingid, p_name AS zonename,
    CASE WHEN p_name LIKE '%g%' THEN 1 ELSE 2 END AS aggregation_zone FROM part)"""
_KINDS = ["People", "Lights", "ElectricEquipment", "GasEquipment", "OtherEquipment"]


def _part_zone_map(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .select(
            F.col("p_size").cast("long").alias("buildingid"),
            F.col("p_name").alias("zonename"),
            F.when(F.col("p_name").contains("g"), 1).otherwise(2).alias("aggregation_zone"),
        )
        .distinct()
    )


@query(f"""
    SELECT buildingid, 'Aggregation_Zone_Equipment_' || aggregation_zone AS zonename,
           {", ".join(f"round(sum(floatvalue) FILTER (tablename = '{k} Internal Gains Nominal'), 4) AS {k}_Level" for k in _KINDS)}
    FROM {s.REPORT_SQL} JOIN {_MAP_SQL} USING (buildingid, zonename)
    WHERE variablename = 'Number' AND tablename <> 'Zone Information' GROUP BY ALL""")
def q_equipment_levels(spark, sf_dir):
    levels = aggregate.equipment_levels(
        _report(spark, sf_dir), _part_zone_map(spark, sf_dir), "Number", _KINDS
    )
    return levels.select(
        "buildingid", "zonename", *[F.round(f"{k}_Level", 4).alias(f"{k}_Level") for k in _KINDS]
    )


def _schedule_report(spark, sf_dir):
    """Report rows whose schedule "S<n>" is named like the series, "Z<n>"."""
    return _report(spark, sf_dir).withColumn(
        "stringvalue",
        F.when(
            F.col("variablename") == "Schedule Name",
            F.concat(F.lit("Z"), F.substring("stringvalue", F.lit(2), F.length("stringvalue"))),
        ).otherwise(F.col("stringvalue")),
    )


_SCHEDULE_SQL = f"(SELECT * FROM {s.FACTS_SQL} WHERE variablename = 'Schedule Value')"
_USERS_SQL = f"""(
    SELECT DISTINCT buildingid, 'Z' || substr(stringvalue, 2) AS schedulename, zonename AS zone,
           replace(tablename, ' Internal Gains Nominal', '') AS kind
    FROM {s.REPORT_SQL}
    WHERE variablename = 'Schedule Name' AND tablename <> 'Zone Information')"""


@query(f"""
    SELECT timeseriesdataid, buildingid, 'Schedule Value ' || kind AS variablename, schedulename,
           zone AS zonename, datetime, value
    FROM {_SCHEDULE_SQL} f JOIN {_USERS_SQL} u USING (buildingid, schedulename)""")
def q_equipment_schedules(spark, sf_dir):
    return aggregate.equipment_schedules(s.facts(spark, sf_dir), _schedule_report(spark, sf_dir)).select(
        "timeseriesdataid", "buildingid", "variablename", "schedulename", "zonename", "datetime", "value"
    )


# Sizes of the zones that use a schedule; a zone of several parts has the largest.
_AREAS_SQL = f"""(
    SELECT CAST(p_size AS BIGINT) AS buildingid, p_name AS zone,
           CAST(max(CAST(p_retailprice AS FLOAT)) AS DOUBLE) AS area
    FROM part WHERE {s.SECTION_SQL} = 'Zone Information' GROUP BY ALL)"""


@query(f"""
    SELECT f.buildingid, 'Aggregation_Zone_' || aggregation_zone AS zonename,
           'Schedule Value ' || kind AS variablename, datetime, round(avg(value), 8) AS mean,
           round(sum(value), 6) AS sum, min(value) AS min, max(value) AS max,
           round(sum(value * area) / sum(area), 6) AS area_weighted
    FROM {_SCHEDULE_SQL} f JOIN {_USERS_SQL} u USING (buildingid, schedulename)
         JOIN (SELECT buildingid, zonename AS zone, aggregation_zone FROM {_MAP_SQL}) USING (buildingid, zone)
         LEFT JOIN {_AREAS_SQL} USING (buildingid, zone)
    GROUP BY ALL""")
def q_schedule_aggregate(spark, sf_dir):
    """Schedules rolled up into aggregation zones, each counted as often as zones use it."""
    report = _schedule_report(spark, sf_dir)
    out = aggregate.aggregate_schedules(
        s.facts(spark, sf_dir),
        report,
        _part_zone_map(spark, sf_dir),
        ["mean", "sum", "min", "max", "area_weighted"],
        aggregate.zone_weights(report),
    )
    return out.withColumns(
        {"mean": F.round("mean", 8), "sum": F.round("sum", 6), "area_weighted": F.round("area_weighted", 6)}
    )
