"""Queries on folders of model, weather and ledger files, and on jobs that start from them.

The files are written with the ending that the readers look for; what Spark adds
to a file's name is cut from the results.
"""

from pyspark.sql import functions as F

from ..functions import names
from ..functions.scalars import basename
from ..plans.jobs import build_manifest, load_variable
from ..schemas import LEDGER_LAST_TIME, MANIFEST_KEY
from ..session import scratch_path
from ..sources import files, tables
from .registry import query, table
from .storage import _as_double, _outputs_sql, _write_outputs

# Name of a model per kind: each gives a location, but that of a commercial model ends with Spark's addition.
_MODELS = {
    "Commercial": "ASHRAE901_Hospital_STD2013_Denver",
    "Residential": "US+MF+CZ2B+gasfurnace+crawlspace+IECC_2006",
    "Manufactured": "Other_ElPaso_3B_CodeX_gasfurnace",
}
_BROKEN_MODEL = "US+MF+CZ2B+gasfurnace+slab+IECC_2006"
_WEATHER = {"Commercial": "USA_CO_Denver.Intl", "Residential": "USA_AZ_Tucson", "Manufactured": "USA_TX_El.Paso"}


def _write_named(rows, path, name, extension):
    """One file for each ``part`` of the rows, of lines in the order of ``place``."""
    ordered = rows.repartition("part").sortWithinPartitions("part", "place").select("part", "line")
    writer = ordered.write.partitionBy("part").mode("append")
    writer.option("extension", extension).option("mapreduce.output.basename", name).csv(path)


def _part_of(path):
    return F.regexp_extract(path, r"/part=(-?\d+)/", 1).cast("int")


def _plain(name):
    """File or run name without what Spark adds."""
    return F.regexp_replace(name, r"-\d{5}-.*$", "")


_LINE_SQL = f"""CASE c_mktsegment WHEN 'MACHINERY' THEN '{names.HEATING_MARKERS["Gas"]}'
    WHEN 'BUILDING' THEN '{names.HEATING_MARKERS["Water"]}' ELSE c_name END"""


def _model_lines(spark, sf_dir):
    segment = F.col("c_mktsegment")
    line = F.when(segment == "MACHINERY", names.HEATING_MARKERS["Gas"]).when(
        segment == "BUILDING", names.HEATING_MARKERS["Water"]
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("part"), F.col("c_custkey").alias("place"), F.coalesce(line, "c_name").alias("line")
    )


def _write_models(spark, sf_dir):
    """Customers as lines of a model per nation, and files of another ending beside them."""
    root = scratch_path(spark, "models")
    for extension in ("idf", "txt"):
        _write_named(_model_lines(spark, sf_dir), root, "model", extension)
    return root


@query(f"""
    SELECT c_nationkey AS part, string_agg({_LINE_SQL} || chr(10), '' ORDER BY c_custkey) AS text
    FROM customer GROUP BY c_nationkey""")
def q_model_texts(spark, sf_dir):
    """Whole model files."""
    found = files.read_model_text(spark, _write_models(spark, sf_dir))
    return found.select(_part_of(F.col("file")).alias("part"), "text")


@query("""
    SELECT c_nationkey AS part, concat_ws(' & ', CASE WHEN bool_or(c_mktsegment = 'BUILDING') THEN 'Water' END,
           CASE WHEN bool_or(c_mktsegment = 'MACHINERY') THEN 'Gas' END) AS heating
    FROM customer GROUP BY c_nationkey""")
def q_model_heating(spark, sf_dir):
    """Heating tags of model files, found line by line."""
    found = files.model_heating(spark, _write_models(spark, sf_dir))
    return found.select(_part_of(F.col("file")).alias("part"), "heating")


def _nations(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("part"), F.lit(0).alias("place"), F.col("n_name").alias("line")
    )


def _regions(spark, sf_dir):
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("part"), F.lit(0).alias("place"), F.col("r_name").alias("line")
    )


def _write_prototypes(spark, sf_dir):
    """A model per kind and nation, a weather file per kind and region, and files that are neither."""
    root = scratch_path(spark, "prototypes")
    for kind, folder in files.MODEL_FOLDER.items():
        _write_named(_nations(spark, sf_dir), f"{root}/{folder}", _MODELS[kind], "idf")
        _write_named(_nations(spark, sf_dir), f"{root}/{folder}", "notes", "txt")
    broken = f"{root}/{files.MODEL_FOLDER['Residential']}"
    _write_named(_nations(spark, sf_dir), broken, _BROKEN_MODEL, "idf")
    for kind, folder in files.WEATHER_FOLDER.items():
        _write_named(_regions(spark, sf_dir), f"{root}/{folder}", _WEATHER[kind], "epw")
    return root


@query(
    " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{name}' AS name, n_nationkey AS part FROM nation"
        for kind, name in [*_MODELS.items(), ("Residential", _BROKEN_MODEL)]
    )
)
def q_list_models(spark, sf_dir):
    """Model files below their folders, by kind; files of other endings are left out."""
    found = files.list_models(spark, _write_prototypes(spark, sf_dir))
    path = F.col("model_path")
    return found.select("kind", _plain(basename(path)).alias("name"), _part_of(path).alias("part"))


@query(
    " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{name}' AS name, r_regionkey AS part FROM region"
        for kind, name in (
            ("Commercial", "USA_CO_Denver.Intl"), ("Residential", "USA_AZ_Tucson"), ("Manufactured", "USA_TX_ElPaso"),
        )
    )
)
def q_list_weather(spark, sf_dir):
    """Weather files by kind, dotted city names joined."""
    found = files.list_weather(spark, _write_prototypes(spark, sf_dir))
    path = F.col("weather_path")
    return found.select("kind", _plain(basename(path)).alias("name"), _part_of(path).alias("part"))


@query(
    " UNION ALL ".join(
        f"""SELECT 'NA' AS "BuildingID", 'Not Started' AS "Simulation Status", '/results/{run}' AS folder,
            '{weather}' AS weather, n_nationkey AS model_part, r_regionkey AS weather_part FROM nation, region"""
        for run, weather in (
            ("MF_CZ2B_Tucson_gasfurnace_crawlspace_IECC_2006", "USA_AZ_Tucson"),
            ("Other_ElPaso_3B_CodeX_gasfurnace", "USA_TX_ElPaso"),
        )
    )
)
def q_build_manifest(spark, sf_dir):
    """The manifest of all models and their weather files; broken models are left out."""
    manifest = build_manifest(spark, _write_prototypes(spark, sf_dir), "/results/")
    weather = F.col("Weather Filepath")
    return manifest.select(
        "BuildingID",
        "Simulation Status",
        _plain(F.col(MANIFEST_KEY)).alias("folder"),
        _plain(basename(weather)).alias("weather"),
        _part_of(F.col("IDF Filepath")).alias("model_part"),
        _part_of(weather).alias("weather_part"),
    )


@query(f"""
    SELECT CAST(ascii(replace(run, 'run', '')) AS BIGINT) AS buildingid, zonename, datetime, value
    FROM ({_outputs_sql("CAST(CAST({} AS FLOAT) AS DOUBLE)")}) WHERE variablename = 'Zone Air'""")
def q_load_variable(spark, sf_dir):
    """The file of one variable loaded for each building, twice; the second load adds nothing."""
    root = scratch_path(spark, "variable")
    _write_outputs(spark, sf_dir, root)
    tables.ensure_tables(spark, f"{root}/tables")
    flags = [r[0] for r in table(spark, sf_dir, "lineitem").select("l_returnflag").distinct().collect()]
    for flag in flags * 2:
        load_variable(spark, f"{root}/tables", f"{root}/run{flag}/TimeSeriesData/Zone_Air.csv", ord(flag), 2000, 60)
    stored = _as_double(tables.read_table(spark, f"{root}/tables", "timeseriesdata"))
    return stored.select("buildingid", "zonename", "datetime", "value")


@query("""
    SELECT o_custkey AS buildingid, o_orderpriority AS variablename, CAST(o_orderkey AS VARCHAR) AS subvariable,
           'Upload Started' AS status, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) END AS last_datetime
    FROM orders""")
def q_ledger_last_times(spark, sf_dir):
    """Ledger in the published form that gives last times, written as CSV and read back."""
    path = scratch_path(spark, "ledger")
    time = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    lines = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("BuildingID"),
        F.col("o_orderpriority").alias("Variable Name"),
        F.lit("Zone").alias("Variable Type"),
        F.col("o_orderkey").alias("SubVariable Name"),
        F.lit("2000-01-01 00:00:00").alias("Sim Start Datetime"),
        F.when(F.col("o_orderstatus") == "F", time).otherwise("None").alias(LEDGER_LAST_TIME),
    )
    lines.write.csv(path, header=True)
    return files.read_ledger(spark, path).select("buildingid", "variablename", "subvariable", "status", "last_datetime")
