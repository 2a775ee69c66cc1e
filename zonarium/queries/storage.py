"""Queries that go through files and tables: written, loaded and read back.

What is written goes to new folders in the shared scratch folder.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import seconds_to_hhmmss
from ..operators import reports
from ..plans.jobs import load_all, load_eio, load_outputs
from ..schemas import LEDGER_CSV, LEDGER_KEY, MANIFEST_COLUMNS, MANIFEST_KEY, UPLOAD_STARTED
from ..session import scratch_path
from ..sources import files, tables
from . import standins as s
from .registry import query, table
from .reports import report_lines, _PARSED_SQL, _zone_lines
from .runs import _MANIFEST_SQL, _manifest

_COLS = ", ".join(s.FACT_COLUMNS)
# Tables hold values as floats.
_FLOAT_FACTS = f"""
    SELECT buildingid, datetime, timeresolution, variablename, schedulename, zonename, surfacename,
           systemnodename, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM {s.FACTS_SQL}"""


def _as_double(df, column="value"):
    return df.withColumn(column, F.col(column).cast("double"))


@query(_FLOAT_FACTS)
def q_store_series(spark, sf_dir):
    """Facts appended to a table and read back."""
    root = scratch_path(spark, "series")
    tables.ensure_tables(spark, root)
    tables.append_rows(s.facts(spark, sf_dir), root, "timeseriesdata")
    stored = tables.read_table(spark, root, "timeseriesdata")
    return _as_double(stored.select(*s.FACT_COLUMNS))


@query(f"""
    SELECT buildingid, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT
        (datetime, timeresolution, variablename, schedulename, zonename, surfacename, systemnodename, value)) AS BIGINT) AS n_ids
    FROM ({_FLOAT_FACTS}) GROUP BY buildingid""")
def q_fact_ids(spark, sf_dir):
    """Ids of stored facts are hashes of the row: as many as different rows."""
    root = scratch_path(spark, "ids")
    tables.ensure_tables(spark, root)
    tables.append_rows(s.facts(spark, sf_dir), root, "timeseriesdata")
    stored = tables.read_table(spark, root, "timeseriesdata")
    return stored.groupBy("buildingid").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("timeseriesdataid").alias("n_ids")
    )


@query(f"""
    SELECT buildingid, datetime, timeresolution, variablename, schedulename, zonename, surfacename, systemnodename, value,
           count(*) AS n_before, count(*) AS n_after, 'fewer' AS files
    FROM ({_FLOAT_FACTS}) GROUP BY ALL""")
def q_compacted(spark, sf_dir):
    """Facts appended in three loads: rows and files before and after the folders are merged."""
    root = scratch_path(spark, "compacted")
    tables.ensure_tables(spark, root)
    facts = s.facts(spark, sf_dir)
    load = F.pmod(F.xxhash64(*s.FACT_COLUMNS), F.lit(3))
    for n in range(3):
        tables.append_rows(facts.filter(load == n), root, "timeseriesdata")
    columns = ["buildingid", *[c for c in s.FACT_COLUMNS if c != "buildingid"]]
    before = tables.read_table(spark, root, "timeseriesdata")
    tables.compact_table(spark, root, "timeseriesdata")
    after = tables.read_table(spark, root, "timeseriesdata")
    both = before.withColumn("side", F.lit(0)).unionByName(after.withColumn("side", F.lit(1)))
    rows = _as_double(both).groupBy(*columns).agg(
        F.count(F.when(F.col("side") == 0, 1)).alias("n_before"), F.count(F.when(F.col("side") == 1, 1)).alias("n_after")
    )
    n_files = [frame.select("buildingid", F.input_file_name()).distinct().groupBy().count().first()[0] for frame in (before, after)]
    return rows.withColumn("files", F.lit("fewer" if n_files[1] < n_files[0] else "not fewer"))


_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS name, CASE WHEN count(*) = 0 THEN 'empty' ELSE 'filled' END AS state FROM {n}"
        for n in _NAMES
    )
    + " UNION ALL SELECT 'truncated', CASE WHEN count(*) >= 0 THEN 'empty' END FROM events"
    + " UNION ALL SELECT 'absent', CASE WHEN count(*) >= 0 THEN 'missing' END FROM events"
)
def q_table_state(spark, sf_dir):
    """State of the given tables, of a table that was truncated, and of none."""
    root = scratch_path(spark, "state")
    tables.append_rows(s.facts(spark, sf_dir), root, "timeseriesdata")
    tables.truncate_table(spark, root, "timeseriesdata")
    states = {n: tables.path_state(spark, f"{sf_dir}/{n}.parquet") for n in _NAMES}
    states["truncated"] = tables.table_state(spark, root, "timeseriesdata")
    states["absent"] = tables.table_state(spark, root, "eiotabledata")
    words = {(False, None): "missing", (True, True): "empty", (True, False): "filled"}
    return spark.createDataFrame(
        [(name, words[state]) for name, state in states.items()], "name string, state string"
    )


def _runs(spark, sf_dir):
    """A run and its building per return flag."""
    flag = F.col("l_returnflag")
    runs = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("run"), flag).alias("run"), F.ascii(flag).cast("long").alias("buildingid")
    )
    return runs.distinct()


# Output files: per return flag one run with two variables of different headers.
def _write_outputs(spark, sf_dir, root):
    time = F.concat(
        F.lit(" "), F.date_format("l_shipdate", "MM/dd"), F.lit("  "),
        F.format_string("%02d:00:00", F.col("l_linenumber") + F.lit(17)),
    )
    items = table(spark, sf_dir, "lineitem").withColumn("Date/Time", time)
    zone = items.select(
        "l_returnflag",
        "Date/Time",
        F.col("l_quantity").alias("Z.A:Zone Air [C](TimeStep)"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("Z B:Zone Air [C](TimeStep)"),
    )
    site = items.select("l_returnflag", "Date/Time", F.col("l_extendedprice").alias("Env:x"), F.col("l_discount").alias("Other:x"))
    flags = [r[0] for r in items.select("l_returnflag").distinct().collect()]  # one folder for each
    for flag in flags:
        for name, frame in (("Zone_Air", zone), ("Site_Air", site)):
            (
                frame.filter(F.col("l_returnflag") == flag)
                .drop("l_returnflag")
                .write.csv(f"{root}/run{flag}/TimeSeriesData/{name}.csv", header=True, ignoreLeadingWhiteSpace=False)
            )
    return f"{root}/*/TimeSeriesData/*.csv"


_HOUR_SQL = """make_timestamp(2000, month(l_shipdate), day(l_shipdate), 0, 0, 0.0)
    + to_hours(CAST(l_linenumber AS BIGINT) + 17)"""


def _outputs_sql(value="{}"):
    return " UNION ALL ".join(
        f"""SELECT 'run' || l_returnflag AS run, {_HOUR_SQL} AS datetime, '{variable}' AS variablename,
            '{zone}' AS zonename, {value.format(cell)} AS value FROM lineitem"""
        for variable, zone, cell in (
            ("Zone Air", "Z.A", "l_quantity"),
            ("Zone Air", "Z B", "nullif(l_tax, 0)"),
            ("Site Air", "NA", "l_extendedprice"),
        )
    )


@query(_outputs_sql("CAST(CAST({} AS FLOAT) AS DOUBLE)"))
def q_load_outputs(spark, sf_dir):
    """Wide output files loaded twice into a table; the second load adds nothing."""
    root = scratch_path(spark, "outputs")
    pattern = _write_outputs(spark, sf_dir, root)
    runs = _runs(spark, sf_dir)
    tables.ensure_tables(spark, f"{root}/tables")
    for _ in range(2):
        load_outputs(
            spark, f"{root}/tables", files.read_output_lines(spark, pattern), runs, 2000, 60,
            skip_completed=False,
        )
    stored = tables.read_table(spark, f"{root}/tables", "timeseriesdata")
    return _as_double(stored.join(F.broadcast(runs), "buildingid")).select(
        "run", "datetime", "variablename", "zonename", "value"
    )


@query(f"""
    SELECT run, variablename, zonename AS subvariable,
           'Upload Completed' AS status, max(datetime) AS last_datetime, CAST(count(*) AS BIGINT) AS n_rows
    FROM ({_outputs_sql()}) GROUP BY ALL""")
def q_load_ledger(spark, sf_dir):
    """Ledger written by a load in watermark mode."""
    root = scratch_path(spark, "ledger")
    pattern = _write_outputs(spark, sf_dir, root)
    runs = _runs(spark, sf_dir)
    tables.ensure_tables(spark, f"{root}/tables")
    load_outputs(
        spark, f"{root}/tables", files.read_output_lines(spark, pattern), runs, 2000, 60, "watermark"
    )
    ledger = tables.read_table(spark, f"{root}/tables", "ledger")
    return ledger.join(F.broadcast(runs), "buildingid").select(
        "run", "variablename", "subvariable", "status", "last_datetime", "n_rows"
    )


@query("""
    SELECT unnest(['Z.A:Zone Air [C](TimeStep)', 'Z B:Zone Air [C](TimeStep)', 'Env:x', 'Other:x']) AS value,
           count(*) > 0 AS used FROM lineitem""")
def q_column_names(spark, sf_dir):
    """Header names of all output files."""
    root = scratch_path(spark, "names")
    headers, body = files.read_output_csv(spark, _write_outputs(spark, sf_dir, root))
    files.write_column_names(headers, f"{root}/names")
    return spark.read.text(f"{root}/names").withColumn("used", F.lit(not body.isEmpty()))


def _faulty_lines(spark, sf_dir):
    """Output lines of one run per return flag, some of which cannot be loaded.

    The header stands after a blank and has a quoted name with a comma.
    """
    items = table(spark, sf_dir, "lineitem")
    kind = F.col("l_linenumber")
    path = F.concat(F.lit("/run"), "l_returnflag", F.lit("/TimeSeriesData/"))
    cell = F.concat(F.col("l_orderkey").cast("string"), F.lit("."), kind.cast("string"))
    body = items.select(
        F.concat(path, F.when(kind == 7, "Site_Air.csv").otherwise("Zone_Air.csv")).alias("file"),
        F.concat(
            F.when(kind == 2, "someday").otherwise(F.format_string(" 01/02  %02d:00:00", kind)),
            F.lit(","),
            cell,
            F.lit(","),
            F.when(kind == 4, "oops").when(kind == 3, "1,2").otherwise("0.5"),
        ).alias("value"),
    )
    header = items.select(
        F.concat(path, F.lit("Zone_Air.csv")).alias("file"),
        F.lit(' Date/Time,"Z,A:Zone Air [C]",Z B:Zone Air [C]').alias("value"),
    )
    return header.distinct().unionByName(body).unionByName(_strange_files(items, path))


def _strange_files(items, path):
    """Files of a run, and of a kind of variable, that are not known: a header and a line each."""
    names = F.array(
        F.concat(F.lit("/other"), "l_returnflag", F.lit("/TimeSeriesData/Zone_Air.csv")), F.concat(path, F.lit("Boiler_Rate.csv"))
    )
    found = items.select("l_returnflag").distinct().select(F.explode(names).alias("file"))
    return found.select("file", F.explode(F.array(F.lit("Date/Time,Z:x"), F.lit(" 01/02  01:00:00,1"))).alias("value"))


def _load_faulty(spark, sf_dir, label, mode="dedupe"):
    """(tables' folder, runs) after the faulty lines were loaded twice."""
    root = scratch_path(spark, label)
    runs = _runs(spark, sf_dir)
    tables.ensure_tables(spark, root)
    for _ in range(2):
        load_outputs(spark, root, _faulty_lines(spark, sf_dir), runs, 2000, 60, mode, skip_completed=False)
    return root


@query("""
    SELECT CASE WHEN l_linenumber <> 7 THEN CAST(ascii(l_returnflag) AS BIGINT) ELSE -1 END AS buildingid,
           CASE l_linenumber WHEN 2 THEN 'unreadable time' WHEN 3 THEN 'more cells than the header'
                WHEN 4 THEN 'unreadable number' ELSE 'no header' END AS reason,
           CAST(count(DISTINCT l_orderkey || l_returnflag) AS BIGINT) AS n_lines
    FROM lineitem WHERE l_linenumber IN (2, 3, 4, 7) GROUP BY ALL
    UNION ALL
    SELECT -1, unnest(['unknown run', 'unknown variable']), CAST(count(DISTINCT l_returnflag) AS BIGINT) FROM lineitem""")
def q_rejected_outputs(spark, sf_dir):
    """Different output lines that could not be loaded, by building (-1: unknown) and reason.

    Files of an unknown run or kind of variable are listed once, by their header line.
    """
    root = _load_faulty(spark, sf_dir, "rejected")
    found = tables.read_rejected(spark, root, "timeseries_rejected")
    building = F.coalesce("buildingid", F.lit(-1)).alias("buildingid")
    return found.groupBy(building, "reason").agg(F.count(F.lit(1)).alias("n_lines"))


@query("""
    WITH kept AS (
        SELECT CAST(ascii(l_returnflag) AS BIGINT) AS buildingid, l_linenumber, zonename
        FROM lineitem, (VALUES ('Z,A'), ('Z B')) z(zonename)
        WHERE l_linenumber NOT IN (2, 3, 7) AND NOT (l_linenumber = 4 AND zonename = 'Z B'))
    SELECT buildingid, zonename AS subvariable, 'Upload Started' AS status, CAST(count(*) AS BIGINT) AS n_rows
    FROM kept GROUP BY ALL""")
def q_faulty_ledger(spark, sf_dir):
    """Ledger of columns with rejected lines: their good rows are stored, they are not completed."""
    root = _load_faulty(spark, sf_dir, "faulty")
    ledger = tables.read_table(spark, root, "ledger")
    return ledger.select("buildingid", "subvariable", "status", "n_rows")


@query("""
    SELECT CAST(ascii(l_returnflag) AS BIGINT) AS buildingid, CASE WHEN l_linenumber < 4 THEN 'ZA' ELSE 'ZB' END AS zonename,
           make_timestamp(2000, 1, 2, 0, 0, 0.0) + to_hours(CAST(l_linenumber AS BIGINT)) AS datetime,
           CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS value
    FROM lineitem WHERE l_linenumber <> 1
    UNION ALL
    SELECT -1, 'no header', NULL, CAST(count(DISTINCT l_returnflag || '/' || l_extendedprice) AS DOUBLE)
    FROM lineitem WHERE l_linenumber = 1""")
def q_two_headers(spark, sf_dir):
    """Outputs of two kinds appended to one file: each line is read under the last header before it.

    What stands before the first header is rejected; its lines are counted in a row of their own.
    """
    root = scratch_path(spark, "headers")
    items = table(spark, sf_dir, "lineitem")
    file = F.concat(F.lit("/run"), "l_returnflag", F.lit("/TimeSeriesData/Zone_Air.csv"))
    place = lambda block, row: F.struct(
        F.lit(block).cast("long").alias("block") if isinstance(block, int) else block.cast("long").alias("block"),
        row.cast("long").alias("row"),
    )
    body = items.select(
        file.alias("file"),
        F.format_string(" 01/02  %02d:00:00,%s", F.col("l_linenumber"), F.col("l_extendedprice").cast("string")).alias("value"),
        place(F.col("l_linenumber"), F.col("l_orderkey")).alias("line_no"),
    )
    files_ = items.select(file.alias("file")).distinct()
    headers = [
        files_.select("file", F.lit(f"Date/Time,{zone}:Zone Air [C]").alias("value"), place(block, F.lit(-1)).alias("line_no"))
        for block, zone in ((2, "ZA"), (4, "ZB"))
    ]
    runs = _runs(spark, sf_dir)
    tables.ensure_tables(spark, root)
    load_outputs(spark, root, headers[0].unionByName(headers[1]).unionByName(body), runs, 2000, 60)
    stored = _as_double(tables.read_table(spark, root, "timeseriesdata"))
    lost = tables.read_rejected(spark, root, "timeseries_rejected").groupBy("reason").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return stored.select("buildingid", "zonename", "datetime", "value").unionByName(
        lost.select(
            F.lit(-1).cast("long").alias("buildingid"), F.col("reason").alias("zonename"),
            F.lit(None).cast("timestamp_ntz").alias("datetime"), "value",
        )
    )


@query("""
    SELECT 'run' || l_returnflag AS run, 'Complete' AS state, CAST(3 * count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY ALL
    UNION ALL SELECT 'runDone', 'Uploaded', CAST(0 AS BIGINT) FROM lineitem HAVING count(*) > 0
    UNION ALL SELECT 'runLate', 'Incomplete', CAST(0 AS BIGINT) FROM lineitem HAVING count(*) > 0""")
def q_load_all(spark, sf_dir):
    """All runs of a manifest loaded twice, by state and stored rows.

    One run is uploaded already, one has no results yet, and there are neither models nor reports.
    """
    root = scratch_path(spark, "all")
    _write_outputs(spark, sf_dir, f"{root}/results")
    flags = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("run"), "l_returnflag").alias("run")).distinct()
    others = spark.createDataFrame([("runDone",), ("runLate",)], "run string")
    state = F.when(F.col("run") == "runDone", "Uploaded").otherwise("Not Started")
    values = [F.lit("NA"), F.lit("/models/m.idf"), F.lit("w"), F.concat(F.lit(f"{root}/results/"), "run"), state]
    manifest = flags.unionByName(others).select(*[v.alias(c) for v, c in zip(values, MANIFEST_COLUMNS)])
    files.write_manifest(manifest, f"{root}/manifest")
    for _ in range(2):
        load_all(spark, f"{root}/tables", f"{root}/manifest", f"{root}/results", f"{root}/models", 2000, 60)
    counts = tables.read_table(spark, f"{root}/tables", "timeseriesdata").groupBy("buildingid").agg(F.count(F.lit(1)).alias("n"))
    runs = files.read_manifest(spark, f"{root}/manifest").select(
        F.element_at(F.split(MANIFEST_KEY, "/"), -1).alias("run"),
        F.col("Simulation Status").alias("state"),
        F.col("BuildingID").try_cast("long").alias("buildingid"),
    )
    return runs.join(counts, "buildingid", "left").select("run", "state", F.coalesce("n", F.lit(0)).alias("n_rows"))


@query(_outputs_sql("CAST(CAST({} AS FLOAT) AS DOUBLE)"))
def q_reload_after_break(spark, sf_dir):
    """A load by time that broke off before its ledger was written, run again: each row once."""
    root = scratch_path(spark, "broken")
    lines = files.read_output_lines(spark, _write_outputs(spark, sf_dir, root))
    runs = _runs(spark, sf_dir)
    tables.ensure_tables(spark, f"{root}/tables")
    load_outputs(spark, f"{root}/tables", lines, runs, 2000, 60, "watermark")
    begun = tables.read_table(spark, f"{root}/tables", "ledger").select(
        *LEDGER_KEY,
        F.lit(UPLOAD_STARTED).alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("last_datetime"),
        F.lit(None).cast("long").alias("n_rows"),
        F.lit(None).cast("long").alias("elapsed_seconds"),
    )
    tables.replace_table(begun, f"{root}/tables", "ledger")
    load_outputs(spark, f"{root}/tables", lines, runs, 2000, 60, "watermark")
    stored = tables.read_table(spark, f"{root}/tables", "timeseriesdata")
    return _as_double(stored.join(F.broadcast(runs), "buildingid")).select(
        "run", "datetime", "variablename", "zonename", "value"
    )


@query("""
    SELECT o_custkey AS buildingid, o_orderpriority AS variablename, 'NA' AS subvariable,
           CASE WHEN bool_or(o_orderkey % 3 = 1) THEN 'Upload Completed' WHEN bool_or(o_orderkey % 3 = 0) THEN 'Upload Started'
                ELSE 'None' END AS status,
           max(CASE WHEN o_orderkey % 3 = 1 THEN o_orderdate END) AS last_datetime,
           max(CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey END) AS n_rows,
           'same' AS compacted
    FROM orders GROUP BY ALL""")
def q_ledger_log(spark, sf_dir):
    """Ledger made of several changes, each with some keys and fields, before and after its log is folded."""
    root = scratch_path(spark, "log")
    tables.ensure_tables(spark, root)
    orders = table(spark, sf_dir, "orders").withColumn("kind", F.col("o_orderkey") % 3)
    key = [F.col("o_custkey").alias("buildingid"), F.col("o_orderpriority").alias("variablename"), F.lit(None).cast("string").alias("subvariable")]
    keys = ["buildingid", "variablename", "subvariable"]
    tables.change_ledger(orders.filter("kind = 0").select(*key).distinct().withColumn("status", F.lit(UPLOAD_STARTED)), root)
    counted = orders.filter("kind = 2").select(*key, "o_orderkey").groupBy(*keys).agg(F.max("o_orderkey").alias("n_rows"))
    tables.change_ledger(counted, root)
    dated = orders.filter("kind = 1").select(*key, "o_orderdate").groupBy(*keys).agg(F.max("o_orderdate").alias("last_datetime"))
    tables.change_ledger(dated.withColumn("status", F.lit("Upload Completed")), root)
    columns = [*LEDGER_KEY, "status", "last_datetime", "n_rows"]
    before = tables.read_table(spark, root, "ledger").select(*columns)
    kept = scratch_path(spark, "before")
    before.write.parquet(kept)
    tables.compact_ledger(spark, root)
    after = tables.read_table(spark, root, "ledger").select(*columns)
    both = spark.read.parquet(kept).withColumn("side", F.lit(1)).unionByName(after.withColumn("side", F.lit(2)))
    return both.groupBy(*columns).agg(F.when(F.sum("side") == 3, "same").otherwise("other").alias("compacted"))


@query(_FLOAT_FACTS.replace("CAST(CAST(value AS FLOAT) AS DOUBLE)", "value"))
def q_bundle(spark, sf_dir):
    """Facts written as a bundle, split by building, and read back."""
    path = scratch_path(spark, "bundle")
    facts = s.facts(spark, sf_dir).select(*s.FACT_COLUMNS)
    files.write_bundle(facts, path)
    types = {f.name: f.dataType for f in facts.schema}
    schema = T.StructType([T.StructField(c, types[c]) for c in s.FACT_COLUMNS])
    return spark.read.schema(schema).parquet(path).select(*s.FACT_COLUMNS)


def _write_reports(spark, sf_dir, root):
    """Report lines as files: one folder per run, after an introduction line."""
    lines = report_lines(spark, sf_dir).select(
        F.concat("file", F.lit("/OutputFiles")).alias("folder"), "line_no", "value"
    )
    intro = lines.select("folder").distinct().select(
        "folder", F.lit(-9).cast("long").alias("line_no"), F.lit("Zone Information,intro").alias("value")
    )
    # a run's report is one file in the order of its lines, whose first line is an introduction
    ordered = lines.unionByName(intro).repartition("folder").sortWithinPartitions("folder", "line_no")
    ordered.select("folder", "value").write.partitionBy("folder").text(root)


@query(f"""
    SELECT DISTINCT replace(file, 'run', '')::BIGINT AS buildingid, tablename, c.zonename, c.variablename,
           c.stringvalue, CAST(CAST(c.floatvalue AS FLOAT) AS DOUBLE) AS floatvalue
    FROM (SELECT file, tablename, trim(string_split(cells, '|')[2]) AS zonename,
                 string_split(cells, '|') AS x FROM ({_PARSED_SQL})) p,
         LATERAL (SELECT p.zonename AS zonename, unnest(['Name', 'Level {{W}}', 'Note']) AS variablename,
                         unnest([x[1], 'NA', x[4]]) AS stringvalue,
                         unnest([NULL, x[3], NULL]) AS floatvalue) c""")
def q_load_reports(spark, sf_dir):
    """Report files loaded twice into the report table."""
    root = scratch_path(spark, "reports")
    _write_reports(spark, sf_dir, f"{root}/files")
    lines = files.read_eio(spark, f"{root}/files/*")
    run = F.regexp_extract("file", r"folder=(run\d+)", 1)
    lines = lines.withColumn("file", F.concat(F.lit("/"), run, F.lit("/OutputFiles/report.eio")))
    runs = (
        table(spark, sf_dir, "part")
        .select(F.col("p_size").cast("long").alias("buildingid"))
        .distinct()
        .withColumn("run", F.concat(F.lit("run"), F.col("buildingid").cast("string")))
    )
    tables.ensure_tables(spark, f"{root}/tables")
    for _ in range(2):
        load_eio(spark, f"{root}/tables", lines, runs)
    stored = tables.read_table(spark, f"{root}/tables", "eiotabledata")
    return _as_double(stored.drop("eiotabledataid"), "floatvalue")


@query(f"""
    SELECT CAST(p_size AS BIGINT) AS buildingid, {s.SECTION_SQL} AS tablename, 'row longer than header' AS reason,
           CAST(count(*) AS BIGINT) AS n_rows
    FROM part WHERE p_name LIKE 'new %' GROUP BY ALL
    UNION ALL
    SELECT CAST(p_size AS BIGINT), 'HotWaterEquipment Internal Gains Nominal', 'no header', CAST(count(*) AS BIGINT)
    FROM part GROUP BY ALL""")
def q_rejected_reports(spark, sf_dir):
    """Report rows that could not be loaded, by building, section and reason."""
    root = scratch_path(spark, "rejected")
    headless = table(spark, sf_dir, "part").select(
        F.concat(F.lit("run"), F.col("p_size").cast("string")).alias("file"),
        (-F.col("p_partkey")).alias("line_no"),
        F.concat(F.lit(" HotWaterEquipment Internal Gains Nominal,Z,"), F.col("p_partkey").cast("string")).alias("value"),
    )
    lines = report_lines(spark, sf_dir).unionByName(headless)
    lines = lines.withColumn("file", F.concat(F.lit("/"), "file", F.lit("/OutputFiles/report.eio")))
    runs = (
        table(spark, sf_dir, "part")
        .select(F.col("p_size").cast("long").alias("buildingid"))
        .distinct()
        .withColumn("run", F.concat(F.lit("run"), F.col("buildingid").cast("string")))
    )
    tables.ensure_tables(spark, root)
    for _ in range(2):
        load_eio(spark, root, lines, runs)
    found = tables.read_rejected(spark, root, "eio_rejected")
    return found.groupBy("buildingid", "tablename", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
    SELECT split_part(p_name, ' ', 2) AS buildingtype, 'Zone Information,' || p_name || ',' || p_brand || ','
           || repeat(p_size || ',', 26) || 'Yes,end' AS value
    FROM part WHERE p_type NOT IN ('SMALL', 'LARGE')
    UNION ALL
    SELECT DISTINCT split_part(p_name, ' ', 2), '! <Zone Information>,Zone Name,Brand' FROM part""")
def q_zone_info_files(spark, sf_dir):
    """Zone rows under their header line, written per building type and read back."""
    path = scratch_path(spark, "zones")
    part = table(spark, sf_dir, "part")
    run = F.concat(F.lit("ASHRAE_2013_Rome_"), F.element_at(F.split("p_name", " "), -1))
    header = part.select(
        run.alias("file"), (-F.col("p_partkey")).alias("line_no"), F.lit(" ! <Zone Information>, Zone Name,Brand").alias("value")
    )
    headers = reports.zone_header_rows(header).withColumn("run", F.col("file"))
    rows = reports.zone_information(reports.zone_table_rows(_zone_lines(spark, sf_dir)))
    word = F.element_at(F.split(F.get("cells", F.lit(1)), " "), -1)
    files.write_zone_info(rows.withColumn("run", F.concat(F.lit("ASHRAE_2013_Rome_"), word)), path, headers)
    return spark.read.text(path)


@query(f"SELECT * EXCLUDE (o_orderkey) FROM {_MANIFEST_SQL}")
def q_manifest_file(spark, sf_dir):
    """Manifest written as CSV and read back."""
    path = scratch_path(spark, "manifest")
    files.write_manifest(_manifest(spark, sf_dir), path)
    return files.read_manifest(spark, path).select(*MANIFEST_COLUMNS)


@query("""
    SELECT o_custkey AS buildingid, o_orderpriority AS variablename, CAST(o_orderkey AS VARCHAR) AS subvariable,
           CASE WHEN o_orderstatus = 'F' THEN 'Upload Completed' ELSE 'Upload Started' END AS status,
           CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE -1 END AS elapsed_seconds
    FROM orders""")
def q_ledger_file(spark, sf_dir):
    """Ledger in its published form written as CSV and read back."""
    path = scratch_path(spark, "ledger")
    done = F.col("o_orderstatus") == "F"
    values = [
        F.col("o_custkey"),
        F.col("o_orderpriority"),
        F.col("o_orderkey").cast("string"),
        F.when(done, "Upload Completed").otherwise("Upload Started"),
        F.when(done, seconds_to_hhmmss(F.col("o_totalprice"))).otherwise("None"),
    ]
    lines = table(spark, sf_dir, "orders").select(
        *[v.alias(f.name) for v, f in zip(values, LEDGER_CSV)]
    )
    lines.write.csv(path, header=True)
    seconds = F.coalesce("elapsed_seconds", F.lit(-1)).alias("elapsed_seconds")
    return files.read_ledger(spark, path).select(
        "buildingid", "variablename", "subvariable", "status", seconds
    )
