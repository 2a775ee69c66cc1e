"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has 64 bits, each the majority of that bit over the XXH64 of
its word shingles.  Fingerprints that differ in at most ``DISTANCE`` bits are linked.

Cut the 64 bits into m parts and give part i a threshold t_i >= -1 with
sum(t_i + 1) = DISTANCE + 1.  Two fingerprints within the distance then differ in at
most t_i bits of some part i; a part with -1 need not be looked at.  So:

1. Equal fingerprints are one from the start.
2. m follows from the number of fingerprints: few wide parts cost probes, many
   narrow ones cost candidates.  Bits that are correlated over all fingerprints
   share a part, so that what is skewed stands in few parts.
3. Every fingerprint has thresholds of its own: a dynamic programme over the parts
   takes the allocation of the least cost, probes made plus candidates expected.
   Candidates are estimated from histograms of all fingerprints, cut into blocks of
   ``BLOCK_BITS`` bits and convolved over distances.
4. Every fingerprint is filed under its value in every part and probes all values
   within its thresholds.  What meets is verified on all 64 bits.
5. A value with very many fingerprints is split into blocks, and pairs of blocks go
   to different tasks.  A task gives out a forest of links, never the pairs.

Defined results: a null text is empty; a text without words has fingerprint zero and
is linked like any other; one of fewer words than a shingle has one shingle; repeated
rows and ids are rows of their own; a component without any id has a null
component_id; an empty table gives an empty result; other columns are ignored.
"""

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from zonarium.llm.common import stored, text_or_empty
from zonarium.llm.components import connected_components

BITS = 64
WORDS = 4
SEED = 42
DISTANCE = 4
#: Bits of a histogram's block.
BLOCK_BITS = 12
#: Fingerprints of one value that one task compares with each other.
GROUP = 2048
#: Cost of a row that is shuffled, in comparisons of two fingerprints.
ROW_COST = 300
#: Shingles whose bits are counted at a time.
AT_A_TIME = 1 << 15
_DATA, _BOTH, _PROBE = 0, 1, 2


def shingle_hashes(text, size=WORDS, seed=SEED):
    """XXH64 of every run of ``size`` words, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, white space of ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops)), np.uint64, len(starts))


def bits_of(fingerprints):
    """One row of 64 zeros and ones per fingerprint, the lowest bit first."""
    return np.unpackbits(np.ascontiguousarray(fingerprints, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprint(text, size=WORDS, seed=SEED):
    """Fingerprint of a text in UTF-8 bytes."""
    hashes = shingle_hashes(text, size, seed)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), AT_A_TIME):
        counts += bits_of(hashes[at : at + AT_A_TIME]).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents, doc_id="doc_id", text="text", size=WORDS, seed=SEED):
    """Columns doc_id and fp (the fingerprint as a signed number) of every document."""
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, size, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    return source.mapInArrow(run, "doc_id long, fp long")


def ball(width, radius):
    """Number of values within ``radius`` bits of a value."""
    return sum(comb(width, e) for e in range(radius + 1))


def part_widths(m):
    return [BITS // m + (k < BITS % m) for k in range(m)]


def number_of_parts(n, distance=DISTANCE):
    """The number of parts of the least cost for ``n`` fingerprints of even bits."""

    def cost(m):
        left = distance + 1  # parts are given thresholds one after another, as evenly as can be
        total = 0
        for k, w in enumerate(part_widths(m)):
            t = left // (m - k) - 1
            left -= t + 1
            if t >= 0:
                total += ball(w, t) * ROW_COST + n * ball(w, t) / 2.0**w
        return total + m * ROW_COST

    return min(range(2, distance + 2), key=cost)


def correlations(unique):
    """Matrix of the correlation of every two bits over all fingerprints."""

    def run(batches):
        total = np.zeros((BITS, BITS))
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            total += bits.T @ bits
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j].astype(np.int64))], names=["i", "j", "n"]
        )

    both = np.zeros((BITS, BITS))
    # One row per pair of bits comes back.
    for i, j, c in unique.select("fp").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n")).collect():
        both[i, j] = both[j, i] = c
    return both


def grouped_bits(both, n, m):
    """The bits of every part: each part starts with the bit that is most correlated
    with any other left, and takes the bits most correlated with those it has."""
    share = np.diag(both) / n
    spread = np.sqrt(np.maximum(np.outer(share * (1 - share), share * (1 - share)), 1e-18))
    strength = np.abs(both / n - np.outer(share, share)) / spread
    np.fill_diagonal(strength, 0)
    left, parts = list(range(BITS)), []
    for width in part_widths(m):
        first = max(left, key=lambda b: (strength[b, left].max(), -b))
        part = [first]
        left.remove(first)
        while len(part) < width:
            best = max(left, key=lambda b: (strength[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def values_of(bits, part):
    """Value of each row of bits in the given places."""
    return bits[:, part].astype(np.uint64) @ (np.uint64(1) << np.arange(len(part), dtype=np.uint64))


def blocks_of_part(part):
    return [part[k : k + BLOCK_BITS] for k in range(0, len(part), BLOCK_BITS)]


def histograms(unique, parts):
    """Per part, per block of its bits, the number of fingerprints of each value."""
    blocks = [(p, b, places) for p, part in enumerate(parts) for b, places in enumerate(blocks_of_part(part))]

    def run(batches):
        counts = [np.zeros(1 << len(places), np.int64) for _, _, places in blocks]
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy(zero_copy_only=False))
            for (_, _, places), count in zip(blocks, counts):
                count += np.bincount(values_of(bits, places).astype(np.int64), minlength=len(count))
        for (p, b, _), count in zip(blocks, counts):
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(at), p, np.int32)),
                    pa.array(np.full(len(at), b, np.int32)),
                    pa.array(at.astype(np.int32)),
                    pa.array(count[at]),
                ],
                names=["part", "block", "value", "n"],
            )

    sums = unique.select("fp").mapInArrow(run, "part int, block int, value int, n long").groupBy("part", "block", "value").agg(F.sum("n"))
    out = [[np.zeros(1 << len(places), np.int64) for places in blocks_of_part(part)] for part in parts]
    for p, b, v, c in sums.collect():  # at most 64 / BLOCK_BITS times 2^BLOCK_BITS rows, and one block a part more
        out[p][b][v] = c
    return out


def at_distances(histogram, width, distance):
    """[value, e]: share of all fingerprints whose block differs from the value in e bits."""
    near = np.zeros((1 << width, distance + 1))
    near[:, 0] = histogram / max(1, histogram.sum())
    at = np.arange(1 << width)
    for bit in range(width):
        flipped = near[at ^ (1 << bit)]
        near[:, 1:] += flipped[:, :-1]
    return near


class Allocation:
    """Thresholds of every fingerprint's parts, by a dynamic programme on estimated costs."""

    def __init__(self, parts, histogram, n, distance=DISTANCE):
        self.parts, self.n, self.distance = parts, n, distance
        self.near = [
            [at_distances(h, len(places), distance) for h, places in zip(own, blocks_of_part(part))]
            for own, part in zip(histogram, parts)
        ]

    def costs(self, bits):
        """[row, part, t + 1]: cost of threshold t; nothing for -1."""
        out = np.zeros((len(bits), len(self.parts), self.distance + 2))
        for p, part in enumerate(self.parts):
            share = None
            for places, near in zip(blocks_of_part(part), self.near[p]):
                own = near[values_of(bits, places).astype(np.int64)]
                if share is None:
                    share = own
                else:
                    share = np.stack([(share[:, : e + 1] * own[:, e::-1]).sum(axis=1) for e in range(self.distance + 1)], axis=1)
            rows = np.array([ball(len(part), t) - 1 for t in range(self.distance + 1)])
            out[:, p, 1:] = rows * ROW_COST + self.n * np.cumsum(share, axis=1)
        return out

    def thresholds(self, bits):
        """[row, part]: thresholds of the least total cost; sum(t + 1) is distance + 1."""
        costs = self.costs(bits)
        n, m, choices = costs.shape
        total = self.distance + 1
        best = np.full((n, total + 1), np.inf)
        best[:, 0] = 0
        taken = []
        for p in range(m):
            now = np.full((n, total + 1), np.inf)
            which = np.zeros((n, total + 1), np.int64)
            for c in range(choices):
                offer = best[:, : total + 1 - c] + costs[:, p, c, None]
                better = offer < now[:, c:]
                now[:, c:][better] = offer[better]
                which[:, c:][better] = c
            best = now
            taken.append(which)
        left = np.full(n, total)
        out = np.empty((n, m), np.int64)
        for p in range(m - 1, -1, -1):
            out[:, p] = taken[p][np.arange(n), left]
            left -= out[:, p]
        return out - 1


def masks_within(width, radius):
    """Values of 1 to ``radius`` set bits, as masks that turn a value into its neighbours."""
    levels, last = [], [(0, -1)]
    for _ in range(radius):
        last = [(v | 1 << b, b) for v, top in last for b in range(top + 1, width)]
        levels += [v for v, _ in last]
    return np.array(levels, np.uint64)


def filed(unique, allocation):
    """Rows (part, value, fp, kind): where a fingerprint is filed, and where it is looked for."""
    parts = allocation.parts

    def rows(p, values, fps, kind):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(fps), p, np.int32)),
                pa.array(values.view(np.int64)),
                pa.array(fps),
                pa.array(np.broadcast_to(np.asarray(kind, np.int32), len(fps))),
            ],
            names=["part", "value", "fp", "kind"],
        )

    def run(batches):
        masks = {}
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(all_fps), 1000):
                fps = all_fps[at : at + 1000]
                bits = bits_of(fps)
                limits = allocation.thresholds(bits)
                for p, part in enumerate(parts):
                    values = values_of(bits, part)
                    yield rows(p, values, fps, np.where(limits[:, p] >= 0, _BOTH, _DATA))
                    for t in np.unique(limits[:, p][limits[:, p] > 0]).tolist():
                        if (len(part), t) not in masks:
                            masks[len(part), t] = masks_within(len(part), t)
                        flips = masks[len(part), t]
                        wide = limits[:, p] == t
                        near = (values[wide, None] ^ flips[None, :]).ravel()
                        yield rows(p, near, np.repeat(fps[wide], len(flips)), _PROBE)

    return unique.select("fp").mapInArrow(run, "part int, value long, fp long, kind int")


def links(probes, data, distance):
    """Places (i, j) of probes and data within the distance."""
    left, right = [], []
    step = max(1, (1 << 20) // max(1, len(data)))
    for at in range(0, len(probes), step):
        i, j = np.nonzero(np.bitwise_count(probes[at : at + step, None] ^ data[None, :]) <= distance)
        left.append(i + at)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def least_labels(n, left, right):
    """Least place of the component of every place."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


def _forest(fps, kinds, blocks, one, two, distance):
    """Links of a group's fingerprints as (fp, least fp) of each part that hangs together."""
    probes, data = np.flatnonzero(kinds != _DATA), np.flatnonzero(kinds != _PROBE)
    pairs = [(probes, data)] if one == two else [
        (probes[blocks[probes] == a], data[blocks[data] == b]) for a, b in ((one, two), (two, one))
    ]
    left, right = [], []
    for p, d in pairs:
        if len(p) and len(d):
            i, j = links(fps[p], fps[d], distance)
            left.append(p[i])
            right.append(d[j])
    if not left:
        return None
    left, right = np.concatenate(left), np.concatenate(right)
    other = fps[left] != fps[right]
    left, right = left[other], right[other]
    if not len(left):
        return None
    label = least_labels(len(fps), left, right)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def verified(groups, distance):
    """Rows (part, value, one, two, block, fp, kind), whole groups in one task -> links (a, b)."""

    def run(batches):
        held = None
        names = ["part", "value", "one", "two"]

        def found(rows):
            marks = np.concatenate([[0], np.flatnonzero((rows[names].to_numpy()[1:] != rows[names].to_numpy()[:-1]).any(axis=1)) + 1])
            columns = [rows[c].to_numpy() for c in ("fp", "kind", "block", "one", "two")]
            return marks, columns

        def forest_of(columns, a, b):
            fps, kinds, blocks, one, two = (c[a:b] for c in columns)
            return _forest(fps.view(np.uint64), kinds, blocks, one[0], two[0], distance)

        def frames(edges):
            if edges:
                yield pd.DataFrame({"a": np.concatenate([e[0] for e in edges]).view(np.int64), "b": np.concatenate([e[1] for e in edges]).view(np.int64)})

        for batch in batches:
            whole = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(whole):
                continue
            marks, columns = found(whole)
            edges = [e for a, b in zip(marks, marks[1:]) if b - a > 1 and (e := forest_of(columns, a, b)) is not None]
            yield from frames(edges)
            held = whole.iloc[marks[-1] :]
        if held is not None and len(held) > 1:
            _, columns = found(held)
            edge = forest_of(columns, 0, len(held))
            yield from frames([edge] if edge is not None else [])

    return (
        groups.select("part", "value", "one", "two", "block", "fp", "kind")
        .repartition("part", "value", "one", "two")
        .sortWithinPartitions("part", "value", "one", "two")
        .mapInPandas(run, "a long, b long")
    )


def near_links(unique, distance=DISTANCE, group=GROUP, parts=None):
    """Links (a, b) that connect what the pairs of fingerprints within ``distance`` connect.

    ``unique``: different fingerprints, as ``fp``.  ``parts`` overrides their number.
    """
    n = unique.count()
    if n < 2:
        return unique.sparkSession.createDataFrame([], "a long, b long")
    places = grouped_bits(correlations(unique), n, parts or number_of_parts(n, distance))
    allocation = Allocation(places, histograms(unique, places), n, distance)
    rows = stored(filed(unique, allocation), "filed")
    # A value is of use if it has another fingerprint, one of the two looking for it.
    met = (
        rows.groupBy("part", "value")
        .agg(F.count("*").alias("n"), F.count_if(F.col("kind") != _DATA).alias("probes"), F.count_if(F.col("kind") != _PROBE).alias("data"))
        .filter("n > 1 AND probes > 0 AND data > 0")
        .select("part", "value", F.ceil(F.col("n") / group).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")).cast("int")
    groups = (
        rows.join(stored(met, "values"), ["part", "value"])
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("one", F.least("block", "other"))
        .withColumn("two", F.greatest("block", "other"))
    )
    return verified(groups, distance)


def near_duplicates(documents, doc_id="doc_id", text="text", distance=DISTANCE, size=WORDS, seed=SEED, group=GROUP, parts=None):
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id.

    ``component_id`` is the least id among the documents that links reach.
    """
    rows = stored(fingerprints(documents, doc_id, text, size, seed), "fingerprints")
    unique = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "unique")
    labels = connected_components(stored(near_links(unique, distance, group, parts), "links"))
    named = stored(
        unique.join(labels.withColumnRenamed("key", "fp"), "fp", "left").select("fp", "rep", F.coalesce("label", "fp").alias("label")),
        "named",
    )
    least = stored(named.groupBy("label").agg(F.min("rep").alias("component_id")), "least")
    of_fingerprint = stored(named.join(least, "label").select("fp", "component_id"), "components")
    return rows.join(of_fingerprint, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
