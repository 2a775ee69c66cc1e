"""Fixed schemas of the tables, the manifest and the load ledger."""

from pyspark.sql import types as T

NA = "NA"


def _fields(spec):
    return T.StructType([T.StructField(name, dtype) for name, dtype in spec])


_S, _L, _I, _F, _TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.FloatType(),
    T.TimestampNTZType(),
)

BUILDING_ATTRIBUTES = [
    "buildingcategory",
    "buildingtype",
    "buildingstandard",
    "buildingstandardyear",
    "buildinglocation",
    "buildingheatingtype",
    "buildingfoundationtype",
    "buildingclimatezone",
    "buildingprototype",
    "buildingconfiguration",
]

BUILDINGS = _fields([("buildingid", _L)] + [(c, _S) for c in BUILDING_ATTRIBUTES])

SUBVARIABLE_COLUMNS = ["schedulename", "zonename", "surfacename", "systemnodename"]

TIMESERIES = _fields(
    [
        ("timeseriesdataid", _L),
        ("buildingid", _L),
        ("datetime", _TS),
        ("timeresolution", _I),
        ("variablename", _S),
        *[(c, _S) for c in SUBVARIABLE_COLUMNS],
        ("value", _F),
    ]
)

EIO = _fields(
    [
        ("eiotabledataid", _L),
        ("buildingid", _L),
        ("tablename", _S),
        ("zonename", _S),
        ("variablename", _S),
        ("stringvalue", _S),
        ("floatvalue", _F),
    ]
)

# Business columns: everything but the surrogate id.
TIMESERIES_KEY = TIMESERIES.fieldNames()[1:]
EIO_KEY = EIO.fieldNames()[1:]

MANIFEST_COLUMNS = [
    "BuildingID",
    "IDF Filepath",
    "Weather Filepath",
    "Completed Simulation FolderPath",
    "Simulation Status",
]
MANIFEST_KEY = "Completed Simulation FolderPath"
MANIFEST = _fields([(c, _S) for c in MANIFEST_COLUMNS])

LEDGER_KEY = ["buildingid", "variablename", "subvariable"]
LEDGER = _fields(
    [
        ("buildingid", _L),
        ("variablename", _S),
        ("subvariable", _S),
        ("status", _S),
        ("last_datetime", _TS),
        ("n_rows", _L),
        ("elapsed_seconds", _L),
    ]
)

# Ledger in its published five-column text form.
LEDGER_CSV = _fields(
    [
        ("BuildingID", _L),
        ("Variable Name", _S),
        ("Subvariable Name", _S),
        ("Upload Status", _S),
        ("Upload Time", _S),
    ]
)

# Column that tells the six-column text form from it.
LEDGER_LAST_TIME = "Last Uploaded Datetime"

ZONE_MAP = _fields([("buildingid", _L), ("zonename", _S), ("aggregation_zone", _I)])

UPLOAD_STARTED = "Upload Started"
UPLOAD_COMPLETED = "Upload Completed"

NOT_STARTED = "Not Started"
INCOMPLETE = "Incomplete"
COMPLETE = "Complete"
UPLOADED = "Uploaded"
