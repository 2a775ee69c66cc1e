"""Wide output frames to the long time-series form, and back."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import (
    format_datetime,
    normalise_variable,
    split_cells,
    subvariable,
    subvariable_columns,
    variable_family,
)
from ..schemas import NA, SUBVARIABLE_COLUMNS
from .joins import lookup_join

DATE_COLUMN = "Date/Time"

LONG_COLUMNS = [
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


# Families whose files hold one series.
SITE_PREFIXES = ("Facility", "Site")


def quoted(name):
    """Column name that may hold dots and brackets, as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def kept_position(family, position):
    """Whether a value column counts (position 1 is the first after the time).

    Facility and site files have one series, so only their first column does;
    a file of an unknown family has none.
    """
    return family.isNotNull() & ((family != "site") | (position == 1))


def to_long(wide, variablename, year=None, timeresolution=None, value_columns=None):
    """Wide frame to long rows, one per time and value column.

    ``wide`` holds ``buildingid``, the time and the value columns.  The time
    is either a ``datetime`` column or the text column ``Date/Time``, read
    with ``year``.  The name of each value column up to its first colon gives
    the schedule, zone, surface or node, by the family of ``variablename``.
    Unpivoting is one ``Expand`` and no shuffle; empty cells stay, as NULL.
    For a list of variable names the frame is scanned, and its times are read,
    once; each row is then repeated for every name.
    """
    if value_columns is None:
        fixed = {"buildingid", "datetime", "timeresolution", DATE_COLUMN}
        value_columns = [c for c in wide.columns if c not in fixed]
    if "datetime" in wide.columns:
        time = F.col("datetime")
    else:
        time = format_datetime(year, F.col(quoted(DATE_COLUMN)))
    resolution = (
        F.col("timeresolution") if "timeresolution" in wide.columns else F.lit(timeresolution)
    )
    names = [variablename] if isinstance(variablename, str) else list(variablename)
    one_series = [n.replace("_", " ").strip().startswith(SITE_PREFIXES) for n in names]
    first = value_columns[0] if value_columns else None
    if all(one_series):
        value_columns = value_columns[:1]  # nothing else is scanned

    narrow = wide.select(
        "buildingid",
        time.alias("datetime"),
        resolution.cast("int").alias("timeresolution"),
        *[F.col(quoted(c)).cast("double").alias(c) for c in value_columns],
    )
    long = narrow.unpivot(
        ["buildingid", "datetime", "timeresolution"],
        [quoted(c) for c in value_columns],
        "_column",
        "value",
    )
    kinds = F.array(
        *[
            F.struct(
                normalise_variable(F.lit(n)).alias("name"),
                variable_family(F.lit(n)).alias("family"),
                F.lit(one).alias("one"),
            )
            for n, one in zip(names, one_series)
        ]
    )
    family = F.col("kind.family")
    named = long.select("*", F.explode(kinds).alias("kind")).filter(
        family.isNotNull() & (~F.col("kind.one") | (F.col("_column") == F.lit(first)))
    )
    return named.select(
        "buildingid",
        "datetime",
        "timeresolution",
        F.col("kind.name").alias("variablename"),
        *subvariable_columns(family, subvariable(F.col("_column"))),
        "value",
    )


_HEADER = r'^[\s\ufeff]*"?\s*Date/Time'


def split_output_lines(lines):
    """Lines of output files as (headers, body).

    A line that starts with ``Date/Time``, perhaps after blanks, a byte order
    mark or a quote, is a header.  Names may be quoted.  ``headers`` has a row
    per header with the array ``header`` and the columns that come from the
    file's path; ``body`` has the other lines.

    A file may hold several outputs, one after another.  Where the lines have
    ``line_no``, a header counts from its place, ``since``, up to the next one
    of its file, ``until`` (NULL: to the end), also where the file is read in
    several splits: only header lines are moved and sorted.  Lines without
    places are read under the one header of their file.
    """
    is_header = F.col("value").contains(DATE_COLUMN) & F.col("value").rlike(_HEADER)
    keys = [c for c in lines.columns if c not in ("value", "line_no")]
    found = lines.filter(is_header).withColumn("header", split_cells(F.col("value")))
    if "line_no" in lines.columns:
        order = Window.partitionBy("file").orderBy("line_no")
        headers = found.select(
            *keys, F.col("line_no").alias("since"), F.lead("line_no").over(order).alias("until"), "header"
        )
    else:
        headers = found.select(*keys, "header").distinct()
    body = lines.filter(~is_header & (F.trim("value") != ""))
    return headers, body


NO_HEADER = "no header"
MANY_HEADERS = "more than one header"
BAD_TIME = "unreadable time"
LONG_LINE = "more cells than the header"
BAD_NUMBER = "unreadable number"
UNKNOWN_RUN = "unknown run"
UNKNOWN_VARIABLE = "unknown variable"


def header_sections(headers, wanted):
    """One row per file: ``sections``, each header's place with what is wanted of it.

    ``columns`` of a section is NULL where nothing of its header is wanted.
    """
    place = ["since", "until"] if "since" in headers.columns else []
    keys = ["file", *place[:1]]
    columns = ["buildingid", "variablename", "width", "columns"]
    joined = headers.select("file", *place).join(wanted.select(*keys, *columns), keys, "left")
    sections = joined.groupBy(F.concat("file", F.lit("")).alias("file"))
    return sections.agg(F.collect_list(F.struct(*place, *columns)).alias("sections"))


def parsed_cells(lines, headers, wanted, year):
    """Body lines of many output files as one row per wanted cell, good or not.

    ``headers`` are those of ``split_output_lines``; ``wanted`` has ``file``
    (and ``since``), ``buildingid``, ``variablename``, ``width``, the number of
    cells of the header, and ``columns``, the value columns that are wanted
    (see ``collect_columns``).  ``reason`` is NULL for a cell that can be
    stored; else ``file`` and ``line`` say where it comes from.  A line that is
    bad as a whole has a row for each wanted column, or one if it has no header.

    A line finds its header in the list of its file, so that lines are not
    multiplied; only whole lines are moved when the headers are too many to
    broadcast.  The time is read once per line.
    """
    ordered = "since" in headers.columns
    place = ["line_no"] if ordered else []
    joined = lookup_join(lines.select("file", "value", *place), header_sections(headers, wanted), "file", how="left")
    if ordered:

        def here(x):
            return (x["since"] < F.col("line_no")) & (x["until"].isNull() | (F.col("line_no") < x["until"]))

        # Most files have one header; its place is compared without a pass over the list.
        only = F.get("sections", F.lit(0))
        section = F.when(F.size("sections") == 1, F.when(here(only), only)).otherwise(F.get(F.filter("sections", here), F.lit(0)))
        many = F.lit(False)
    else:
        section, many = F.get("sections", F.lit(0)), F.coalesce(F.size("sections") > 1, F.lit(False))
    found = joined.select("file", "value", section.alias("section"), many.alias("many"))
    lost = F.when(F.col("many"), MANY_HEADERS).when(F.col("section").isNull(), NO_HEADER)
    # Where the header is known and nothing of it is wanted, nothing is left to do.
    used = found.withColumn("lost", lost).filter("lost IS NOT NULL OR section.columns IS NOT NULL")
    split = used.withColumn("cells", split_cells(F.col("value")))
    timed = split.withColumn("datetime", format_datetime(year, F.get("cells", F.lit(0))))
    fault = (
        F.when(F.col("lost").isNotNull(), F.col("lost"))
        .when(F.col("datetime").isNull(), BAD_TIME)
        .when(F.size("cells") > F.col("section.width"), LONG_LINE)
    )
    each = timed.withColumn("fault", fault).select(
        "file", "value", "datetime", "cells", "fault", "section.buildingid", "section.variablename",
        F.explode_outer(F.when(F.col("lost").isNull(), F.col("section.columns"))).alias("column"),
    )
    cell = F.trim(F.get(F.col("cells"), F.col("column.position")))
    read = each.withColumn("cell", cell).withColumn("number", F.col("cell").try_cast("double"))
    reason = F.coalesce("fault", F.when((F.col("cell") != "") & F.col("number").isNull(), BAD_NUMBER))
    bad = F.col("reason").isNotNull()
    return read.withColumn("reason", reason).select(
        "buildingid",
        "variablename",
        "datetime",
        *[F.col(f"column.{c}").alias(c) for c in SUBVARIABLE_COLUMNS],
        F.when(~bad, F.col("number")).alias("value"),
        "reason",
        F.when(bad, F.col("file")).alias("file"),
        F.when(bad, F.col("value")).alias("line"),
    )


def good_rows(parsed, timeresolution):
    """Long rows of the cells of ``parsed_cells`` that can be stored; an empty cell is NULL."""
    rows = parsed.filter("reason IS NULL").withColumn("timeresolution", F.lit(timeresolution).cast("int"))
    return rows.select(*LONG_COLUMNS)


def rejected_lines(parsed):
    """Lines of ``parsed_cells`` that are not stored wholly or in part, with the reason."""
    lines = parsed.filter("reason IS NOT NULL").select(
        "file", "buildingid", "variablename", F.col("line").alias("value"), "reason"
    )
    return lines.distinct()


def rejected_files(headers, runs):
    """Files, by their header lines, of a run or of a kind of variable that is not known."""
    known = runs.select("run", F.lit(True).alias("known")).distinct()
    reason = F.when(F.col("known").isNull(), UNKNOWN_RUN).when(
        variable_family(F.col("variablename")).isNull(), UNKNOWN_VARIABLE
    )
    found = lookup_join(headers, known, "run", "left").withColumn("reason", reason).filter("reason IS NOT NULL")
    return found.select(
        "file", F.lit(None).cast("long").alias("buildingid"), "variablename", F.concat_ws(",", "header").alias("value"), "reason"
    ).distinct()


def header_columns(headers):
    """One row per file and wanted value column: ``position`` and ``subvariable``.

    ``headers`` has ``file``, ``variablename`` and the array ``header``.
    """
    family = variable_family(F.col("variablename"))
    return (
        headers.select("*", F.posexplode("header").alias("position", "name"))
        .filter((F.col("position") > 0) & kept_position(family, F.col("position")))
        .withColumn(
            "subvariable",
            F.when(family == "site", F.lit(NA)).otherwise(subvariable(F.col("name"))),
        )
        .drop("header")
    )


def collect_columns(columns, keys):
    """Rows of ``header_columns`` back to one row per header, for ``parsed_cells``.

    The four sub-name columns are settled here, once per column of a header.
    """
    names = subvariable_columns(variable_family(F.col("variablename")), F.col("subvariable"))
    return columns.groupBy(*keys).agg(
        F.collect_list(F.struct("position", *names)).alias("columns")
    )


def pivot_variables(long, keys, variables, value="value", how=F.first):
    """One column per variable; the list of variables is given, so no extra job."""
    return long.groupBy(*keys).pivot("variablename", list(variables)).agg(how(value))
