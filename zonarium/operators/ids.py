"""Surrogate ids."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import checkpointed


def row_id(columns):
    """Id of a fact row: a hash of its business columns, needing no shuffle.

    Repeated rows share it.  Which columns are NULL is hashed too, as the hash
    itself passes over NULLs.
    """
    nulls = F.concat(*[F.isnull(c).cast("string") for c in columns])
    return F.xxhash64(*columns, nulls)


def serial_ids(df, id_column, order, start=0):
    """Number the rows ``start + 1, start + 2, ...`` in the order of ``order``.

    A global ``row_number`` would sort everything in one task.  Here the rows
    are range partitioned and sorted, numbered within their partition, and
    shifted by the row counts of the partitions before it; only those counts
    (one row per partition) meet in one place.  The sorted rows are
    checkpointed, so both steps see the same partitions even if an executor is
    lost in between.
    """
    position = F.monotonically_increasing_id()  # partition number, then row in partition
    placed = checkpointed(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.shiftright(position, 33).alias("_part"),
            position.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    number = F.col("_row") + F.col("_offset") + F.lit(start + 1)
    return placed.join(F.broadcast(offsets), "_part").select(
        number.cast("long").alias(id_column), *df.columns
    )
