"""Approximate nearest neighbours by collision counting.

Vectors are scaled to length one, so the nearest by cosine is the nearest by
distance.  An index is a set of random projections, each a sorted array of the
vectors' values.  A query opens a window around its own value in every array;
virtual rehashing widens all windows step by step with the search radius.  A
vector that lies in the windows of enough projections (the collision threshold)
is verified by its exact cosine.  The search ends when the k-th best verified
distance is within the radius, when a nearer vector would have been met but for
a small chance, or when all vectors are verified.

The index is built in shards of a bounded number of values; queries go to every
shard in blocks.  Every shard's best k of a query are merged by a ranking per
query over k rows a shard.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows without an id; vectors of another dimension
are no candidates; rows of equal id are one (the least vector); a query's own id
is no candidate; ties go to the smaller id; with fewer than k candidates all are
given; an empty table gives an empty result; other columns are ignored.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonarium.llm.common import blocks_of, stored

NEAREST = 5
PROJECTIONS = 32
#: Share of the projections in whose windows a vector must lie to be verified.
THRESHOLD = 0.53
#: Half a window's width for radius 1: a vector at the radius lies in it with chance 0.68.
HALF_WIDTH = 1.0
FIRST_RADIUS, GROWTH = 0.2, 1.15
#: Vector components in a shard and in a block of queries.
SHARD_VALUES = 1 << 19
SCHEMA = "query_id long, vec_id long, score double"


class Index:
    """Sorted projections of the rows of a matrix (vectors of length one)."""

    def __init__(self, unit, projections=PROJECTIONS, seed=11):
        self.unit = unit
        self.lines = np.random.default_rng(seed).standard_normal((unit.shape[1], projections))
        values = (unit @ self.lines).T
        order = np.argsort(values, axis=1, kind="stable")
        self.order = order.ravel()
        # The arrays stand one after the other; an offset keeps them apart in one sorted whole.
        self.offsets = np.arange(projections) * (4 * np.abs(values).max(initial=1.0) + 64)
        self.values = (np.take_along_axis(values, order, axis=1) + self.offsets[:, None]).ravel()
        self.needed = int(np.ceil(THRESHOLD * projections))

    def first_radius(self, k, sample=32):
        """Where most searches can start: less than the k-th distances of some rows of the index."""
        rows = np.linspace(0, len(self.unit) - 1, min(sample, len(self.unit))).astype(int)
        near = self.unit @ self.unit[rows].T
        kth = np.partition(near, max(0, len(near) - k - 1), axis=0)[max(0, len(near) - k - 1)]
        return max(FIRST_RADIUS, float(np.quantile(np.sqrt(np.maximum(2 - 2 * kth, 0)), 0.25)))

    def search(self, query, k, barred=None, radius=FIRST_RADIUS):
        """(rows, cosines) of at least the k nearest found; ``barred``: a row that is no candidate."""
        n, m = len(self.unit), len(self.offsets)
        waiting = np.ones(n, bool)
        candidates = n
        if barred is not None:
            waiting[barred] = False
            candidates -= 1
        k = min(k, candidates)
        if not k:
            return np.zeros(0, int), np.zeros(0)
        at = query @ self.lines + self.offsets
        low = high = np.searchsorted(self.values, at)
        ends = np.arange(m + 1) * n
        counts, rows, scores, found, best = np.zeros(n, np.int64), [], [], 0, np.zeros(0)
        while found < candidates:
            width = HALF_WIDTH * radius
            left = np.clip(np.searchsorted(self.values, at - width), ends[:-1], low)
            right = np.clip(np.searchsorted(self.values, at + width, side="right"), high, ends[1:])
            parts = [self.order[a:b] for a, b in zip(left.tolist(), low.tolist())]
            parts += [self.order[a:b] for a, b in zip(high.tolist(), right.tolist())]
            counts += np.bincount(np.concatenate(parts), minlength=n)
            low, high = left, right
            new = np.flatnonzero(waiting & (counts >= self.needed))
            if len(new):
                waiting[new] = False
                # Many rows cost less as one product over all than gathered.
                own = (self.unit @ query)[new] if 8 * len(new) > n else self.unit[new] @ query
                rows.append(new)
                scores.append(own)
                found += len(new)
                best = np.concatenate([best, own])
                best = np.partition(best, len(best) - k)[-k:] if len(best) > k else best
            # Distance of the k-th best, squared: 2 - 2 cosine.
            if found >= k and 2 - 2 * best.min() <= radius * radius:
                break
            radius *= GROWTH
        return np.concatenate(rows), np.concatenate(scores)


def cosines(vectors, query):
    """Cosine of each row with the query in double precision; equal rows give equal values."""
    dots = (vectors * query).sum(axis=1)
    return dots / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def nearest_in(ids, vectors, query_ids, queries, k=NEAREST):
    """Frame (query_id, vec_id, score): the k nearest found of each query."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    index = Index(unit)
    start = index.first_radius(k)
    place = {i: r for r, i in enumerate(ids.tolist())}
    out = []
    for i, q in zip(query_ids.tolist(), queries):
        rows, near = index.search(q / np.sqrt((q * q).sum()), k, place.get(i), start)
        if not len(rows):
            continue
        if len(rows) > k:  # all that may tie with the k-th in exact arithmetic
            rows = rows[near >= np.partition(near, len(near) - k)[-k] - 1e-9]
        exact = cosines(vectors[rows], q)
        best = np.lexsort((ids[rows], -exact))[:k]
        out.append(pd.DataFrame({"query_id": i, "vec_id": ids[rows][best], "score": exact[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def usable(table, vec_id="vec_id", vector="embedding"):
    """Rows that take part: id, vector (doubles), dimension."""
    rows = table.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("vector", lambda x: x != 0)
    return (
        rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & fine & some)
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("size", F.size("vector"))
    )


def nearest_neighbours(table, is_query, vec_id="vec_id", vector="embedding", k=NEAREST, shard_values=SHARD_VALUES):
    """Per query its k nearest found: query_id, rank (from 1), vec_id, score.

    ``is_query``: function from the id column to a boolean column.
    """
    rows = stored(usable(table, vec_id, vector), "vectors")
    queries = rows.filter(is_query(F.col("id")))
    most = rows.agg(F.max("size")).first()[0] or 1
    per = max(1, shard_values // most)
    shards, blocks = blocks_of(rows.count(), per), blocks_of(queries.count(), per)
    dealt = lambda frame, name, n: frame.withColumn(name, F.pmod(F.xxhash64("id", F.lit(name)), F.lit(n)))
    every = lambda name, n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    left = dealt(rows, "shard", shards).select("*", every("block", blocks))
    right = dealt(queries, "block", blocks).select("*", every("shard", shards))

    def pair(own, asked):
        if not len(own) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        return nearest_in(
            own["id"].to_numpy(), np.stack(own["vector"].to_list()), asked["id"].to_numpy(), np.stack(asked["vector"].to_list()), k
        ).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["size", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda a, b: pair(a, b), SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
