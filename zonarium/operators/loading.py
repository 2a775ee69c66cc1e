"""What is new in a batch, and what the ledger says about it."""

from pyspark.sql import functions as F

from ..functions.scalars import ledger_subvariable, seconds_to_hhmmss
from ..schemas import LEDGER_KEY, NA, SUBVARIABLE_COLUMNS, UPLOAD_COMPLETED
from .joins import lookup_join
from .rows import last_by, minus_existing

# Building ids are passed to the scan as a list up to this many.
MAX_LISTED_BUILDINGS = 10_000
# And variable names up to this many.
MAX_LISTED_VARIABLES = 1_000


def with_subvariable(long):
    """Long rows with the ledger's ``subvariable`` column."""
    return long.withColumn("subvariable", ledger_subvariable(*map(F.col, SUBVARIABLE_COLUMNS)))


def of_buildings(facts, buildings):
    """Facts of some buildings, so that the scan skips the other partitions.

    ``buildings`` is what ``buildings_of`` gives: a list goes to the scan as a
    filter, a frame is joined and prunes the partitions at run time.
    """
    if buildings is None:
        return facts
    if isinstance(buildings, list):
        return facts.filter(F.col("buildingid").isin(buildings))
    return lookup_join(facts, buildings, "buildingid", "left_semi")


def buildings_of(batch):
    """Building ids of a batch: a list, or a frame if there are too many to list."""
    distinct = batch.select("buildingid").distinct()
    ids = [row.buildingid for row in distinct.limit(MAX_LISTED_BUILDINGS + 1).collect()]
    return ids if len(ids) <= MAX_LISTED_BUILDINGS else distinct


def of_variables(facts, variables):
    """Facts of some variables: a list goes to the scan as a filter, ``None`` filters nothing."""
    return facts if variables is None else facts.filter(F.col("variablename").isin(variables))


def variables_of(batch):
    """Variable names of a batch as a list, ``None`` if there are too many to list."""
    names = [r[0] for r in batch.select("variablename").distinct().limit(MAX_LISTED_VARIABLES + 1).collect()]
    return names if len(names) <= MAX_LISTED_VARIABLES else None


def of_year(facts, year):
    """Facts from the year's start to the midnight that ends it."""
    first = F.lit(f"{int(year):04d}-01-01").cast("timestamp_ntz")
    last = F.lit(f"{int(year) + 1:04d}-01-01").cast("timestamp_ntz")
    return facts.filter((F.col("datetime") >= first) & (F.col("datetime") <= last))


def new_rows(batch, existing, buildings=None):
    """Batch rows not stored yet, compared on all their columns.

    Repeated rows of the batch are kept.  ``buildings`` limits the scan of the
    existing rows; it does not change the result, as the building is one of
    the compared columns.
    """
    stored = of_buildings(existing, buildings).select(*batch.columns)
    return minus_existing(batch, stored)


def last_datetime(facts, keys=LEDGER_KEY):
    """Last loaded time per key."""
    return facts.groupBy(*keys).agg(F.max("datetime").alias("last_datetime"))


def open_keys(keys, ledger):
    """Keys whose last load did not end, or whose ledger line lacks the number of rows."""
    return not_loaded(keys, ledger.filter(F.col("n_rows").isNotNull()))


def series_state(keys, ledger, facts, keys_open=None):
    """Last loaded time and number of stored rows of each of ``keys`` that has any.

    Of a completed series both stand in the ledger; a load that broke off after
    its rows were stored has no line there, so open series are counted in the
    facts.  ``facts`` is a function of the open keys and is not called if there
    are none: then no fact is read.
    """
    still = open_keys(keys, ledger) if keys_open is None else keys_open
    known = lookup_join(
        lookup_join(ledger.select(*LEDGER_KEY, "last_datetime", "n_rows"), keys, LEDGER_KEY, "left_semi"),
        still, LEDGER_KEY, "left_anti",
    )
    if still.isEmpty():
        return known
    counted = lookup_join(with_subvariable(facts(still)), still, LEDGER_KEY, "left_semi", spread=["datetime"])
    return known.unionByName(
        counted.groupBy(*LEDGER_KEY).agg(F.max("datetime").alias("last_datetime"), F.count(F.lit(1)).alias("n_rows"))
    )


def last_ledger_line(ledger, keys, order, columns=("last_datetime",)):
    """Values of the last ledger line per key, in the order of ``order``."""
    return last_by(ledger, list(keys), order, list(columns))


def after_watermark(batch, marks, keys=LEDGER_KEY):
    """Batch rows later than the last loaded time of their key.

    A key without a mark keeps all its rows.  A row older than the mark is
    skipped even if it was never loaded; use ``new_rows`` to accept it.
    """
    known = marks.filter(F.col("last_datetime").isNotNull()).select(*keys, "last_datetime")
    joined = lookup_join(batch, known, list(keys), "left", spread=["datetime"])
    mark = F.col("last_datetime")
    return joined.filter(mark.isNull() | (F.col("datetime") > mark)).select(*batch.columns)


def not_loaded(rows, ledger, keys=LEDGER_KEY):
    """Rows whose key has no completed ledger line.

    With fewer ``keys`` the missing ones match any value.
    """
    done = ledger.filter(F.col("status") == UPLOAD_COMPLETED).select(*keys).distinct()
    return lookup_join(rows, done, list(keys), "left_anti")


def upsert_ledger(ledger, updates):
    """Ledger with the updates applied; a field left NULL keeps its old value.

    New keys are added; their status is ``'None'`` until it is set.  A missing
    subvariable is ``'NA'``.
    """
    fields = [c for c in ledger.columns if c not in LEDGER_KEY]
    sub = F.coalesce("subvariable", F.lit(NA))
    old = ledger.withColumn("subvariable", sub).alias("o")
    new = updates.withColumn("subvariable", sub).alias("u")
    present = set(updates.columns)
    merged = old.join(new, LEDGER_KEY, "full")
    values = []
    for c in fields:
        options = [F.col(f"u.{c}")] if c in present else []
        options.append(F.col(f"o.{c}"))
        if c == "status":
            options.append(F.lit("None"))
        values.append(F.coalesce(*options).alias(c))
    return merged.select(*LEDGER_KEY, *values)


def building_status(ledger):
    """Per building: ``Complete`` once every ledger line is completed."""
    done = F.bool_and(F.coalesce(F.col("status") == UPLOAD_COMPLETED, F.lit(False)))
    return ledger.groupBy("buildingid").agg(
        F.when(done, "Complete").otherwise("Incomplete").alias("building_status")
    )


def load_durations(ledger, keys=("buildingid",)):
    """Number, mean and longest duration of the timed loads."""
    seconds = F.col("elapsed_seconds")
    summary = ledger.groupBy(*keys).agg(
        F.count(seconds).alias("n_loads"),
        F.avg(seconds).alias("avg_seconds"),
        F.max(seconds).alias("max_seconds"),
    )
    return summary.withColumn("longest", seconds_to_hhmmss(F.col("max_seconds")))


def orphans(facts, buildings):
    """Facts whose building is not in the dimension."""
    return lookup_join(facts, buildings.select("buildingid"), "buildingid", "left_anti")


def with_building(facts, buildings):
    """Facts whose building is in the dimension."""
    return lookup_join(facts, buildings.select("buildingid"), "buildingid", "left_semi")
