"""Sectioned report text to long report rows."""

from pyspark.sql import functions as F

from ..functions.scalars import number_or_text, strip
from ..schemas import EIO_KEY, NA
from ..session import checkpointed
from .joins import lookup_join
from .rows import last_by, minus_existing

# The report sections that are kept, in matching order.
CATEGORIES = [
    "Zone Information",
    "Zone Internal Gains Nominal",
    "People Internal Gains Nominal",
    "Lights Internal Gains Nominal",
    "ElectricEquipment Internal Gains Nominal",
    "GasEquipment Internal Gains Nominal",
    "HotWaterEquipment Internal Gains Nominal",
    "SteamEquipment Internal Gains Nominal",
    "OtherEquipment Internal Gains Nominal",
]

ZONE_COLUMN = "Zone Name"


def first_category(line):
    """First category the line contains, NULL if none."""
    return F.coalesce(*[F.when(line.contains(k), k) for k in CATEGORIES])


def all_categories(line):
    """Array of every category the line contains."""
    return F.array_compact(F.array(*[F.when(line.contains(k), k) for k in CATEGORIES]))


def section_cells(line):
    """Cells after the first token; a last cell of one blank is dropped."""
    text = F.rtrim(line, F.lit("\r\n"))
    text = F.when(text.endswith(", "), F.left(text, F.length(text) - 2)).otherwise(text)
    cells = F.split(text, ",")
    return F.slice(cells, F.lit(2), F.size(cells))


def section_headers(lines):
    """One header per file and section: a comment line that names the section.

    Of several headers the last one counts.  Column names are trimmed here,
    once per header.
    """
    line = F.col("value")
    found = lines.filter(line.contains("!")).select(
        "file",
        first_category(line).alias("tablename"),
        "line_no",
        F.transform(section_cells(line), strip).alias("header"),
    )
    return last_by(
        found.filter(F.col("tablename").isNotNull()), ["file", "tablename"], "line_no", ["header"]
    )


def section_lines(lines):
    """Data lines with their cells, one row for each section whose name a line contains."""
    line = F.col("value")
    return lines.filter(~line.contains("!")).select(
        "file",
        "line_no",
        section_cells(line).alias("cells"),
        F.explode(all_categories(line)).alias("tablename"),
    )


def match_sections(lines, headers=None):
    """Data lines with the header of their section.

    ``lines`` has ``file``, ``line_no`` and ``value``.  A data line belongs to
    every section whose name it contains and that has a header.  ``headers``
    are those of ``section_headers``, perhaps with more columns, stored once,
    as finding them reads all lines.
    """
    if headers is None:
        headers = checkpointed(section_headers(lines))
    return lookup_join(section_lines(lines), headers, ["file", "tablename"], "inner", ["line_no"])


def without_header(lines, headers):
    """Data lines of sections that have no header in their file, with the reason."""
    keys = headers.select("file", "tablename").distinct()
    missing = lookup_join(section_lines(lines), keys, ["file", "tablename"], "left_anti")
    return missing.select("file", "tablename", "line_no", "cells", F.lit("no header").alias("reason"))


def problem(header, cells):
    """Why a data row cannot be used, NULL if it can."""
    return F.when(F.size(cells) > F.size(header), "row longer than header").when(
        F.array_position(header, ZONE_COLUMN) == 0, "no zone column"
    )


def quarantined(matched):
    """Rows of ``match_sections`` that are left out, with the reason."""
    return matched.select(
        "file", "tablename", "line_no", "cells", problem(F.col("header"), F.col("cells")).alias("reason")
    ).filter(F.col("reason").isNotNull())


def pad_sections(matched):
    """Usable rows, short ones filled up with ``'NA'`` to the header's width."""
    return matched.filter(problem(F.col("header"), F.col("cells")).isNull()).withColumn(
        "cells",
        F.transform("header", lambda _, i: F.coalesce(F.get("cells", i), F.lit(NA))),
    )


def sections_to_long(sections, keys=("file",)):
    """Padded section rows to (zone, variable, value) rows.

    Every column but the zone becomes a row.  A number goes to ``floatvalue``
    with ``'NA'`` as text, anything else to ``stringvalue`` with no number.
    """
    zone_at = (F.array_position("header", ZONE_COLUMN) - 1).cast("int")
    text, number = number_or_text(F.col("cell"))
    return (
        sections.select(
            *keys,
            "tablename",
            strip(F.get("cells", zone_at)).alias("zonename"),
            zone_at.alias("zone_at"),
            F.posexplode(F.arrays_zip("header", "cells")).alias("position", "pair"),
        )
        .filter(F.col("position") != F.col("zone_at"))
        .select(
            *keys,
            "tablename",
            "zonename",
            F.col("pair.header").alias("variablename"),
            F.col("pair.cells").alias("cell"),
        )
        .select(
            *keys,
            "tablename",
            "zonename",
            "variablename",
            text.alias("stringvalue"),
            number.alias("floatvalue"),
        )
    )


def new_report_rows(batch, existing):
    """Report rows not stored yet, each once; NULL numbers compare as equal."""
    return minus_existing(
        batch.select(*EIO_KEY), existing.select(*EIO_KEY), keep_copies=False
    )


# Fixed values of the zone table: its line prefix and the flag field.
ZONE_SUMMARY = "Zone Summary"
ZONE_INFORMATION = "Zone Information"
ZONE_FLAG_FIELD = 29


def zone_information(rows):
    """Trimmed zone rows whose flag field is not ``No``.

    ``rows`` has the array ``cells``, counted from the line's first token.
    """
    flag = strip(F.get("cells", F.lit(ZONE_FLAG_FIELD)))
    return rows.filter(F.coalesce(flag, F.lit("")) != "No").withColumn(
        "cells", F.transform("cells", strip)
    )


def zone_table_rows(lines):
    """Zone rows of report lines as ``file``, ``line_no`` and the array ``cells``."""
    line = F.col("value")
    return lines.filter(strip(line).startswith(ZONE_INFORMATION + ",")).select(
        "file", "line_no", F.split(strip(line), ",").alias("cells")
    )


def zone_header_rows(lines):
    """Header line of the zone section of each file, as ``file``, ``line_no`` and trimmed ``cells``."""
    line = strip(F.col("value"))
    found = lines.filter(line.startswith("!") & line.contains(f"<{ZONE_INFORMATION}>"))
    cells = F.transform(F.split(line, ","), strip)
    return last_by(found.select("file", "line_no", cells.alias("cells")), ["file"], "line_no", ["line_no", "cells"])


def zone_count_check(lines):
    """Per file: number of zones announced and number of zone rows found."""
    line = strip(F.col("value"))
    announced = F.when(
        line.startswith(ZONE_SUMMARY + ","), F.get(F.split(line, ","), F.lit(1)).try_cast("long")
    )
    found = line.startswith(ZONE_INFORMATION + ",").cast("long")
    return lines.groupBy("file").agg(
        F.max(announced).alias("announced"), F.sum(found).alias("found")
    )
