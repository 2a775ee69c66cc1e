"""Text, time and number expressions."""

from pyspark.sql import functions as F

from ..schemas import NA

_BLANKS = " \t\r\n\x0b\x0c"

# What counts as a number in report cells: sign, digits with single
# underscores between them, exponent, or one of the words inf / infinity / nan.
NUMBER_PATTERN = (
    r"^\s*[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)
_NAN_PATTERN = r"^\s*[+-]?[nN][aA][nN]\s*$"


def strip(c):
    """Trim all white space, not only the space character."""
    return F.trim(c, F.lit(_BLANKS))


def basename(path):
    """Last part of a path written with either kind of slash."""
    return F.element_at(F.split(path, r"[/\\]"), -1)


_DATE_TIME = r"^\s*\d{1,2}/\d{1,2}  +\d{1,2}:\d{1,2}:\d{1,2}\s*$"


# A cell after a comma: quoted, with doubled quotes inside, or plain.
_CELL = r',("[^"]*(?:""[^"]*)*"[^,]*|[^,]*)'
_QUOTED = r'(?s)^\s*"(.*)"\s*$'


def split_cells(line):
    """Cells of a comma-separated line; a quoted cell may hold commas.

    Lines without a quote are split at every comma, which costs less.
    """
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))
    inside = lambda c: F.replace(F.regexp_extract(c, _QUOTED, 1), F.lit('""'), F.lit('"'))
    plain = F.transform(cells, lambda c: F.when(c.rlike(_QUOTED), inside(c)).otherwise(c))
    return F.when(F.contains(line, F.lit('"')), plain).otherwise(F.split(line, ","))


def format_datetime(year, text):
    """``MM/DD  HH:MM:SS`` of a simulation year as a timestamp without zone.

    Hour 24 is midnight of the next day.  Month and day may lack the leading
    zero; date and time are two blanks apart.  Anything else, such as
    29 February of a common year, gives NULL.
    """
    trimmed = strip(text)
    date = F.replace(F.substring_index(trimmed, " ", 1), F.lit("/"), F.lit("-"))
    time = F.substring_index(trimmed, " ", -1)
    year = F.lpad(F.lit(year).cast("string"), 4, "0")
    midnight_after = time.startswith("24:")
    clock = F.when(midnight_after, "00:00:00").otherwise(time)
    # NULL for other text; kept apart, so that the parts are computed only once.
    valid = F.when(text.rlike(_DATE_TIME), "")
    # Spark reads one or two digits for each part of a timestamp.
    iso = F.concat(year, F.lit("-"), date, F.lit(" "), clock, valid)
    return iso.try_cast("timestamp_ntz") + F.make_dt_interval(midnight_after.cast("int"))


def seconds_to_hhmmss(seconds):
    """Whole seconds as ``HH:MM:SS``; hours are not wrapped at a day."""
    s = F.floor(seconds).cast("long")
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600).cast("long"),
        F.floor(F.pmod(s, F.lit(3600)) / 60).cast("long"),
        F.pmod(s, F.lit(60)),
    )


def hhmmss_to_seconds(text):
    """``H:MM:SS`` back to seconds; other text, such as ``None``, gives NULL."""
    pattern = r"^(\d+):(\d{2}):(\d{2})$"
    h, m, s = (F.regexp_extract(strip(text), pattern, i).try_cast("long") for i in range(1, 4))
    return h * 3600 + m * 60 + s


def is_number(text):
    """Whether a report cell is a number (see ``NUMBER_PATTERN``)."""
    return text.rlike(NUMBER_PATTERN)


def to_number(text, dtype="float"):
    """Report cell as a number, NULL where the cell is not one."""
    digits = F.replace(strip(text), F.lit("_"), F.lit(""))
    return F.when(text.rlike(_NAN_PATTERN), F.lit(float("nan")).cast(dtype)).when(
        is_number(text), digits.try_cast(dtype)
    )


def number_or_text(text, dtype="float"):
    """(stringvalue, floatvalue): a number has ``'NA'`` as text, text has no number."""
    number = is_number(text)
    return F.when(number, F.lit(NA)).otherwise(text), to_number(text, dtype)


def normalise_variable(name):
    """File or bundle name as a variable name: blanks for underscores, no ``.csv``."""
    return strip(F.replace(F.replace(name, F.lit("_"), F.lit(" ")), F.lit(".csv"), F.lit("")))


def variable_filename(variable):
    """Variable name as the name of its output file."""
    return F.concat(F.replace(variable, F.lit(" "), F.lit("_")), F.lit(".csv"))


def variable_family(name):
    """schedule, site, zone, surface or node; NULL for an unknown family."""
    v = normalise_variable(name)
    return (
        F.when(v == "Schedule Value", "schedule")
        .when(v.startswith("Facility") | v.startswith("Site"), "site")
        .when(v.startswith("Zone"), "zone")
        .when(v.startswith("Surface"), "surface")
        .when(v.startswith("System node"), "node")
    )


def subvariable(header):
    """Column header up to the first colon."""
    return strip(F.substring_index(header, ":", 1))


FAMILY_COLUMN = {
    "schedule": "schedulename",
    "zone": "zonename",
    "surface": "surfacename",
    "node": "systemnodename",
}


def subvariable_columns(family, sub):
    """The four sub-name columns: one holds ``sub``, the other three ``'NA'``."""
    return [
        F.when(family == kind, sub).otherwise(F.lit(NA)).alias(column)
        for kind, column in FAMILY_COLUMN.items()
    ]


def ledger_subvariable(row_schedule, row_zone, row_surface, row_node):
    """The one sub-name of a long row that is not ``'NA'``, else ``'NA'``."""
    names = [row_schedule, row_zone, row_surface, row_node]
    return F.coalesce(*[F.when(c != NA, c) for c in names], F.lit(NA))


WEATHER_WORDS = {
    # Dotted city names in weather file names.
    "San.Diego": "SanDiego",
    "International.Falls": "InternationalFalls",
    "Great.Falls": "GreatFalls",
    "New.York": "NewYork",
    "El.Paso": "ElPaso",
    "Port.Angeles": "PortAngeles",
}

WEATHER_WORDS_MANUFACTURED = {
    # Fixed values for the weather files of manufactured homes.
    "San.Francisco": "SanFrancisco",
    "El.Paso": "ElPaso",
}


def normalise_weather(name, words=WEATHER_WORDS):
    """Weather file name with its dotted city names joined."""
    for dotted, joined in words.items():
        name = F.replace(name, F.lit(dotted), F.lit(joined))
    return name
