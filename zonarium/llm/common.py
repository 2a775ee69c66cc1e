"""Helpers the operators of this subpackage share."""

from pyspark.sql import functions as F

from zonarium.session import scratch_path

#: Rows of a stored table that are worth a task and a file of their own.
ROWS_PER_FILE = 20_000


def read(spark, sf_dir, name, *columns):
    """Table ``name`` below ``sf_dir``, with the given columns only."""
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def stored(df, label, rows=None, per_file=ROWS_PER_FILE):
    """``df`` written once to the shared folder and read again.

    Cuts the lineage: a lost executor costs a reread and not a recomputation.
    ``rows``: a bound on the rows of ``df``, if one is known.  Few rows then go to few
    files, however many partitions the session's settings make of them: each file costs
    the executor several calls to the shared folder, on a local one processes as well.
    """
    if rows is not None:
        df = df.coalesce(blocks_of(rows, per_file, least=1))
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_hash(column):
    """crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def text_or_empty(column):
    return F.coalesce(F.col(column), F.lit(""))


def blocks_of(rows, per_block, least=1):
    """Number of blocks that hold ``per_block`` rows each."""
    return max(least, -(-int(rows) // per_block))
