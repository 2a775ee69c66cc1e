"""Readers and writers of the files around a simulation run."""

from pyspark.sql import functions as F

from ..functions.names import COMMERCIAL, HEATING_MARKERS, MANUFACTURED, RESIDENTIAL
from ..functions.scalars import (
    WEATHER_WORDS,
    WEATHER_WORDS_MANUFACTURED,
    basename,
    hhmmss_to_seconds,
    normalise_variable,
    normalise_weather,
)
from ..operators.reshape import DATE_COLUMN, quoted, split_output_lines
from ..schemas import LEDGER, LEDGER_CSV, LEDGER_LAST_TIME, MANIFEST, UPLOAD_STARTED
from .folders import any_path, many_buildings, replace_folder, settle, write_by_building

# Folders of the model and weather files, per kind of model.
MODEL_FOLDER = {
    COMMERCIAL: "Commercial_Prototypes",
    MANUFACTURED: "Manufactured_Prototypes",
    RESIDENTIAL: "Residential_Prototypes",
}
WEATHER_FOLDER = {
    COMMERCIAL: "TMY3_WeatherFiles_Commercial",
    MANUFACTURED: "TMY3_WeatherFiles_Manufactured",
    RESIDENTIAL: "TMY3_WeatherFiles_Residential",
}

# A separator that does not occur in text files: every line is one value.
_NO_SEPARATOR = "\u0001"


def decoded(path):
    """File path of the scan's metadata without percent codes."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def run_of(file):
    """Run name: the folder above the run's output folders."""
    return F.regexp_extract(
        file, r"([^/\\]+)[/\\](?:TimeSeriesData|OutputFiles|Sim_OutputFiles)[/\\]", 1
    )


def variable_of(file):
    """Variable name of an output file, or of a folder of parts named like one."""
    return normalise_variable(F.regexp_extract(file, r"([^/\\]+\.csv)(?:[/\\]|$)", 1))


def _lines(reader, path):
    # The path is left as the scan gives it: decoding it for each line would
    # cost more than reading the line.
    return reader.load(path).select("value", F.col("_metadata.file_path").alias("file"))


def _line_no():
    """Place of a line in its file: start of its split, then row in the task."""
    return F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    ).alias("line_no")


def _of_files(scan, only):
    """Rows of some files of a scan, given by their paths as the scan writes them; others are not opened."""
    return scan if only is None else scan.filter(F.col("_metadata.file_path").isin(list(only)))


def read_output_lines(spark, path, only=None):
    """Lines of wide output files: ``value``, ``file`` and ``line_no``; ``only`` names the files to read.

    Each file has its own header, so the files are read as text; big files are
    split like any text file.  ``line_no`` orders the lines of one file, also
    over its splits.
    """
    lines = _of_files(spark.read.format("text").load(path), only)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), _line_no())


def with_file_names(files):
    """``run`` and ``variablename`` from the path in ``file``; for one row per file."""
    path = decoded(F.col("file"))
    return files.withColumns({"run": run_of(path), "variablename": variable_of(path)})


def read_output_csv(spark, path):
    """Wide output files as (headers, body); see ``split_output_lines``.

    The headers carry ``run`` and ``variablename``.
    """
    headers, body = split_output_lines(read_output_lines(spark, path))
    return with_file_names(headers), body


def read_output_frame(spark, path, columns, value_type="double"):
    """Output files that share one header, as a wide frame."""
    fields = [f"{quoted(c)} {'string' if c == DATE_COLUMN else value_type}" for c in columns]
    return spark.read.csv(path, schema=", ".join(fields), header=True)


def read_eio(spark, path, only=None):
    """Lines of report files without the first line of each file; ``only`` names the files to read.

    ``line_no`` orders the lines of one file, also when the file is read in
    several splits.
    """
    reader = (
        spark.read.format("csv")
        .schema("value string")
        .option("header", True)
        .option("sep", _NO_SEPARATOR)
        .option("quote", "")
    )
    lines = _of_files(reader.load(path), only)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), _line_no())


def with_run_name(rows):
    """``run`` from the path in ``file``."""
    return rows.withColumn("run", run_of(decoded(F.col("file"))))


def read_model_text(spark, path):
    """Whole model files, one row each: ``file`` and ``text``."""
    return (
        spark.read.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.idf")
        .load(path)
        .select(decoded(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("text"))
    )


def model_heating(spark, path, names="*.idf"):
    """Heating tags per model file, found line by line; ``names`` is a pattern of file names.

    No file is read, and none is missed, where there is no such folder.  The markers are single lines, so files of any size are read in splits and
    only one flag per marker is shuffled.
    """
    if not any_path(spark, path):
        return spark.createDataFrame([], "file string, heating string")
    names = names if names != "*" else "*.idf"
    lines = _lines(
        spark.read.format("text")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", names),
        path,
    )
    found = lines.groupBy("file").agg(
        *[F.bool_or(F.col("value").contains(mark)).alias(tag) for tag, mark in HEATING_MARKERS.items()]
    )
    return found.select(
        decoded(F.col("file")).alias("file"),
        F.concat_ws(" & ", *[F.when(F.col(tag), tag) for tag in HEATING_MARKERS]).alias("heating"),
    )


def read_manifest(spark, path):
    """Manifest of runs, all columns as text."""
    settle(spark, path.rstrip("/"))
    return spark.read.csv(path, schema=MANIFEST, header=True)


def write_manifest(manifest, path):
    """Replace the manifest; the old one goes when the new one is complete."""
    replace_folder(manifest.sparkSession, path, lambda new: manifest.write.csv(new, header=True))


def read_ledger(spark, path):
    """Load ledger in the form of ``schemas.LEDGER``, from either published form.

    One form has a status and a duration per line, the other the last time that
    was uploaded; which it is stands in the header line.
    """
    raw = spark.read.csv(path, header=True)  # all columns as text
    if LEDGER_LAST_TIME in raw.columns:
        sub = "SubVariable Name"
        last = F.col(LEDGER_LAST_TIME).try_cast("timestamp_ntz")
        # The last time alone does not tell that a series is complete.
        values = {"last_datetime": last, "status": F.lit(UPLOAD_STARTED)}
    else:
        raw = spark.read.csv(path, schema=LEDGER_CSV, header=True)
        sub = "Subvariable Name"
        values = {
            "status": F.col("Upload Status"),
            "elapsed_seconds": hhmmss_to_seconds(F.col("Upload Time")),
        }
    values |= {
        "buildingid": F.col("BuildingID"),
        "variablename": F.col("Variable Name"),
        "subvariable": F.col(sub),
    }
    return raw.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER]
    )


def list_files(spark, root, pattern):
    """Paths below ``root``; the content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path")
    )


def list_models(spark, root):
    """Model files by kind."""
    frames = [
        list_files(spark, f"{root}/{folder}", "*.idf").select(
            F.lit(kind).alias("kind"), F.col("path").alias("model_path")
        )
        for kind, folder in MODEL_FOLDER.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def list_weather(spark, root):
    """Weather files by kind, the dotted city names of the file name joined."""
    frames = []
    for kind, folder in WEATHER_FOLDER.items():
        words = WEATHER_WORDS_MANUFACTURED if kind == MANUFACTURED else WEATHER_WORDS
        path = F.col("path")
        name = basename(path)
        parent = F.substring(path, F.lit(1), F.length(path) - F.length(name))
        frames.append(
            list_files(spark, f"{root}/{folder}", "*").select(
                F.lit(kind).alias("kind"),
                F.concat(parent, normalise_weather(name, words)).alias("weather_path"),
            )
        )
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def column_names(headers):
    """Every value-column header of the output files, as one text column."""
    return headers.select(F.explode(F.slice("header", 2, F.size("header"))).alias("value"))


def write_column_names(headers, path, distinct=True):
    names = column_names(headers)
    (names.distinct() if distinct else names).write.mode("overwrite").text(path)


def write_zone_info(rows, path, headers=None):
    """Zone rows as comma-separated text, one folder per building type.

    ``rows`` has ``run`` and the array ``cells``; the building type is the
    fourth part of the run name.  ``headers`` has the same columns; each
    different header line stands once before the rows of its building type.
    Lines are dealt by ranges of type and text, so a large type is split.
    """
    kind = F.get(F.split("run", "_"), F.lit(3)).alias("buildingtype")
    line = F.concat_ws(",", "cells").alias("value")
    lines = rows.select(kind, F.lit(1).alias("place"), line)
    if headers is not None:
        lines = lines.unionByName(headers.select(kind, F.lit(0).alias("place"), line).distinct())
    order = ["buildingtype", "place", "value"]
    lines.repartitionByRange(*order).sortWithinPartitions(*order).drop("place").write.mode(
        "overwrite"
    ).partitionBy("buildingtype").text(path)


def write_bundle(long, path):
    """Processed series of any number of runs, one folder per building, or per bucket of very many buildings.

    Rows are sorted by building, variable and time, so that a reader skips row
    groups of others (see ``write_by_building``).
    """
    write_by_building(long, path, ["buildingid", "variablename", "datetime"], many_buildings(long))
