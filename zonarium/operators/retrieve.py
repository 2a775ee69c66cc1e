"""Filtered reads.  The result is a lazy frame: no sort, no limit, no collect."""

from pyspark.sql import functions as F

from ..schemas import NA, SUBVARIABLE_COLUMNS


def retrieve_timeseries(
    facts,
    buildingid=None,
    start=None,
    end=None,
    timeresolution=None,
    variable=None,
    subvariabletype=None,
    subvariable=None,
):
    """Time-series rows by building, period (both ends included), step, variable
    and one sub-name.

    An argument that is ``None`` (or otherwise false) filters nothing, nor
    does an unknown ``subvariabletype`` or the sub-name ``'NA'``.  Columns
    fixed by a filter are left out, a filtered sub-name is shown.
    """
    by_subname = subvariabletype in SUBVARIABLE_COLUMNS and bool(subvariable) and subvariable != NA

    columns = ["timeseriesdataid"]
    if not buildingid:
        columns.append("buildingid")
    if variable is None:
        columns.append("variablename")
    if by_subname:
        columns.append(subvariabletype)
    columns += ["datetime", "value"]

    out = retrieve_rows(facts, buildingid, start, end)
    if timeresolution:
        out = out.filter(F.col("timeresolution") == timeresolution)
    if variable:
        out = out.filter(F.col("variablename") == variable)
    if by_subname:
        out = out.filter(F.col(subvariabletype) == F.lit(subvariable))
    return out.select(*columns)


def retrieve_eio(facts, buildingid=None, tablename=None, zonename=None, variablename=None):
    """Report rows by building, section, zone and variable.

    Only columns that are not filtered are shown, then the two values.
    """
    wanted = {
        "buildingid": buildingid,
        "tablename": tablename,
        "zonename": zonename,
        "variablename": variablename,
    }
    out = facts
    for column, value in wanted.items():
        if value:
            out = out.filter(F.col(column) == value)
    shown = [column for column, value in wanted.items() if value is None]
    return out.select(*shown, "stringvalue", "floatvalue")


def training_rows(facts, buildingid, start, end, zone):
    """Rows of one zone together with the rows that belong to no zone, in one scan."""
    period = retrieve_rows(facts, buildingid, start, end)
    return period.filter(F.col("zonename").isin(zone, NA)).select(
        "timeseriesdataid", "variablename", "zonename", "datetime", "value"
    )


def retrieve_rows(facts, buildingid=None, start=None, end=None):
    """All columns of the rows of a building and period."""
    out = facts
    if buildingid:
        out = out.filter(F.col("buildingid") == buildingid)
    if start:
        out = out.filter(F.col("datetime") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        out = out.filter(F.col("datetime") <= F.lit(end).cast("timestamp_ntz"))
    return out
