"""Lookup join of a big frame with a keyed, smaller one."""

import math

from pyspark.sql import functions as F

from ..session import checkpointed

MAX_BROADCAST_BYTES = 64 << 20
# A key that holds more than this share of the rows is spread over pieces of this share.
HOT_SHARE = 0.001
# Keys that the sketch counts at once; it finds every key above 3.5 / TRACKED_KEYS of the rows.
TRACKED_KEYS = 16_384

# Operators that pass rows on as they come.
_PASSING = {"Project", "Filter", "Union"}

_SALT, _KEY, _PIECES = "_salt", "_key", "_pieces"


def plain_key(name):
    """String column ``name`` without the conditions known to hold for it.

    A key that other columns were derived from and filtered on takes those
    conditions along, even through a checkpoint.  In a join the optimizer
    would test them on each row of the other side as well, which for a path
    means decoding it and matching patterns for each line of its file.
    """
    return F.concat(F.col(name), F.lit("")).alias(name)


def text_size(df):
    """Size of the rows in bytes, written as text; one pass, one row back."""
    row = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    return df.select(row.alias("b")).agg(F.sum("b")).first()[0] or 0


def is_derived(df):
    """Whether the rows come out of joins, groups or sorts, and not just out of stored data."""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        children = node.children()
        if children.size() and node.nodeName() not in _PASSING:
            return True
        nodes += [children.apply(k) for k in range(children.size())]
    return False


def fits_broadcast(df, max_bytes=MAX_BROADCAST_BYTES):
    """Whether ``df`` was measured to be small enough to send to every executor."""
    return text_size(df) <= max_bytes


def hot_keys(big, on, share=HOT_SHARE):
    """Hashes of the keys that hold more than ``share`` of the rows, and the pieces to spread them over.

    One pass of a mergeable sketch of frequent items; at most 1 / ``share`` rows
    come back.
    """
    top = F.expr(f"approx_top_k({_KEY}, {int(1 / share)}, {TRACKED_KEYS})")
    found = big.select(F.xxhash64(*on).alias(_KEY)).agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    piece = found.n * share
    return [(r["item"], math.ceil(r["count"] / piece)) for r in found.top or () if r["count"] > piece]


def spread_join(big, small, on, how, spread):
    """Shuffled join in which the rows of hot keys are spread over pieces.

    The rows of ``small`` that have such a key are repeated once for each of its
    pieces; all others stand once.
    """
    hot = hot_keys(big, on)
    if not hot:
        return big.join(small, on, how)
    pieces = F.broadcast(big.sparkSession.createDataFrame(hot, f"{_KEY} long, {_PIECES} int"))  # at most 1 / HOT_SHARE rows
    types = {f.name: f.dataType for f in big.schema}
    n = F.coalesce(_PIECES, F.lit(1))
    salted = (
        big.withColumn(_KEY, F.xxhash64(*on))
        .join(pieces, _KEY, "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(*spread), n).cast("int"))
        .drop(_KEY, _PIECES)
    )
    # Hashes depend on the type, so the key is hashed in the type it has in ``big``.
    repeated = (
        small.withColumn(_KEY, F.xxhash64(*[F.col(c).try_cast(types[c]) for c in on]))
        .join(pieces, _KEY, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), n - 1)))
        .drop(_KEY, _PIECES)
    )
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def lookup_join(big, small, on, how="left", spread=None, max_bytes=MAX_BROADCAST_BYTES):
    """Join ``big`` with ``small`` on the columns ``on``.

    ``how`` is one of inner, left, left_semi and left_anti.  ``small`` is
    measured: up to ``max_bytes`` it is broadcast and ``big`` does not move.  What
    joins or groups give is stored before, so that it is computed once only.
    Beyond that both sides are shuffled, and the keys that hold much of ``big``,
    found by a sketch, are spread over as many pieces as they need, so that no
    key of ``big`` lands in one task.  ``spread`` names the columns the piece is
    taken from (all columns by default).
    """
    on = [on] if isinstance(on, str) else list(on)
    if is_derived(small):
        small = checkpointed(small)
    if fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), on, how)
    return spread_join(big, small, on, how, spread or big.columns)
