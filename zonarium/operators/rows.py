"""Set-like operators on whole rows."""

from pyspark.sql import functions as F

# Copies of one row up to this number are written out where they are; more are
# cut into pieces of this size, which are spread over the tasks.
COPIES_PER_PIECE = 10_000

_COPIES, _SEEN, _PIECE = "_copies", "_seen", "_piece"


def minus_existing(batch, existing, keep_copies=True):
    """Rows of ``batch`` that ``existing`` does not hold.

    All columns of ``batch`` are compared, in the types ``existing`` has: a
    value is rounded the way it is stored.  NULL equals NULL, NaN equals NaN.
    With ``keep_copies`` a row that occurs n times in the batch comes back n
    times, otherwise once.

    Written as one grouped count over both sides instead of an anti join: the
    map-side partial aggregate folds copies of a row before the only shuffle,
    so neither repeated batch rows nor repeated existing rows make a hot task.
    """
    columns = batch.columns
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    types = {f.name: f.dataType for f in existing.schema}
    typed = [F.col(c).cast(types[c]).alias(c) for c in columns]
    both = batch.select(*typed, one.alias(_COPIES), zero.alias(_SEEN)).unionByName(
        existing.select(*columns, zero.alias(_COPIES), one.alias(_SEEN))
    )
    fresh = (
        both.groupBy(*columns)
        .agg(F.sum(_COPIES).alias(_COPIES), F.max(_SEEN).alias(_SEEN))
        .filter(F.col(_SEEN) == 0)
        .drop(_SEEN)
    )
    return repeat_rows(fresh, _COPIES) if keep_copies else fresh.drop(_COPIES)


def repeat_rows(df, count, per_piece=COPIES_PER_PIECE):
    """Each row repeated ``count`` times; ``count`` itself is dropped.

    A row with very many copies is cut into pieces that are redistributed
    before they are written out.  Their number of partitions is fixed, as the
    pieces are small only until then.
    """
    columns = [c for c in df.columns if c != count]
    n = F.col(count)

    def written_out(rows):
        return rows.withColumn(_PIECE, F.explode(F.sequence(F.lit(1), n))).select(*columns)

    few = written_out(df.filter(n <= per_piece))
    last = F.floor((n - 1) / per_piece).cast("long")
    pieces = (
        df.filter(n > per_piece)
        .withColumn(_PIECE, F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn(count, F.least(n - F.col(_PIECE) * per_piece, F.lit(per_piece).cast("long")))
        .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns, _PIECE)
        .drop(_PIECE)
    )
    return few.unionByName(written_out(pieces))


def last_by(df, keys, order, columns):
    """One row per key: the values of ``columns`` where ``order`` is largest."""
    return df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in columns])


def first_by(df, keys, order, columns):
    """One row per key: the values of ``columns`` where ``order`` is smallest."""
    return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in columns])
