"""Document fingerprints: content-defined chunks and their digests.

A gear hash runs over the bytes of a text; a chunk ends where the hash has enough
zero bits.  Chunk sizes are normalised: up to the normal size a boundary needs
more zero bits, beyond it fewer, and no chunk is longer than the greatest size.
The fingerprint is the set of chunk digests, each with the bytes it stands for.
A change moves the boundaries next to it only, so an edited text shares the
chunks of its unchanged parts, wherever these have moved.

Likeness is the bytes in chunks that both have, over the bytes of the longer
text; containment is the same over the bytes of the first.

Defined results: a null text is empty; an empty text has an empty fingerprint;
two empty texts have likeness 1, an empty and another text 0; repeated chunks
count as often as both have them; equal texts have equal fingerprints; the
document after the last is the first, which is the document itself if there is
only one; repeated ids are ordered by their text; null ids come last; an empty
table gives an empty result; other columns are ignored.
"""

import hashlib
import json
import math
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from zonarium.llm.common import blocks_of

LEAST, NORMAL, MOST = 16, 48, 192
#: Zero bits that a boundary needs before and after the normal size.
BITS_BEFORE, BITS_AFTER = 6, 4
GEAR = np.random.default_rng(20240501).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Rows a task handles in one go.
ROWS_PER_BLOCK = 5_000
#: Ranges of ids at most; beyond, ranges grow (they are sorted with spilling and streamed).
MOST_RANGES = 16_384
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def gear_hash(data):
    """Gear hash at each byte, over that and the 31 bytes before it."""
    value = GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < 32:
        value[width:] += value[:-width] << np.uint32(width)
        width *= 2
    return value


def chunks(data):
    """Ends of the chunks of a byte string."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    top = gear_hash(data)
    easy = np.flatnonzero(top < np.uint32(1 << (32 - BITS_AFTER)))
    hard = easy[top[easy] < np.uint32(1 << (32 - BITS_BEFORE))].tolist()
    easy = easy.tolist()
    hard.append(n)
    easy.append(n)
    ends, start, h, e = [], 0, 0, 0
    while n - start > LEAST:
        first, turn, last = start + LEAST - 1, start + NORMAL - 1, min(start + MOST, n) - 1
        while hard[h] < first:
            h += 1
        cut = hard[h]
        if cut >= turn:
            while easy[e] < turn:
                e += 1
            cut = min(easy[e], last)
        cut = min(cut, last)
        ends.append(cut + 1)
        start = cut + 1
    if start < n:
        ends.append(n)
    return ends


def chunk_set(text):
    """Counter of (digest, length) of the chunks of a text."""
    data = text.encode()
    out, start = [], 0
    digest = xxhash.xxh64_intdigest
    for end in chunks(data):
        out.append((digest(data[start:end]), end - start))
        start = end
    return Counter(out)


def to_string(found):
    """A fingerprint as text: digest and length of each chunk, sorted, with its count if over 1."""
    return " ".join(
        f"{digest:016x}:{length:x}" + (f"*{count:x}" if count > 1 else "")
        for (digest, length), count in sorted(found.items())
    )


def from_string(text):
    found = Counter()
    for part in (text or "").split():
        head, _, count = part.partition("*")
        digest, _, length = head.partition(":")
        found[(int(digest, 16), int(length, 16))] = int(count or "1", 16)
    return found


def _shared(a, b):
    if len(b) < len(a):
        a, b = b, a
    get = b.get
    return sum(key[1] * min(n, get(key, 0)) for key, n in a.items() if key in b)


def _bytes(a):
    return sum(key[1] * n for key, n in a.items())


def likeness(a, b):
    most = max(_bytes(a), _bytes(b))
    return _shared(a, b) / most if most else 1.0


def containment(a, b):
    """Share of the bytes of ``a`` that stand in chunks of ``b``."""
    own = _bytes(a)
    return _shared(a, b) / own if own else 1.0


def fingerprints(documents, doc_id="doc_id", text="text"):
    """Columns doc_id, fingerprint."""

    def run(batches):
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "fingerprint": [to_string(chunk_set(t or "")) for t in batch["text"]]}
            )

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInPandas(run, "doc_id long, fingerprint string")


def edited(text, following):
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _measures(ids, texts, followings):
    """Rows of SCHEMA; each text is fingerprinted once, as its neighbour stands beside it."""
    rows, known = [], (None, None)
    for i, text, following in zip(ids, texts, followings):
        own = known[1] if known[0] == text else chunk_set(text)
        other = chunk_set(following)
        known = (following, other)
        changed = edited(text, following)
        marked = chunk_set(changed)
        rows.append(
            (
                i,
                len(text),
                hashlib.sha256(changed.encode()).hexdigest(),
                to_string(own),
                to_string(marked),
                likeness(own, marked),
                likeness(own, other),
            )
        )
    frame = pd.DataFrame(rows, columns=[part.split()[0] for part in SCHEMA.split(", ")])
    return frame.astype({"doc_id": "Int64"})


def _range_of(place, cuts):
    """Number of cuts below a place, in two steps so that few are compared."""
    side = max(1, math.isqrt(len(cuts)))
    coarse, fine = cuts[::side], [cuts[k + 1 : k + side] for k in range(0, len(cuts), side)]
    below = lambda marks: F.size(F.filter(marks, lambda c: c < place))
    group = below(F.from_json(F.lit(json.dumps(coarse)), "array<double>"))
    inside = F.from_json(F.lit(json.dumps(fine)), "array<array<double>>")
    return F.when(group == 0, 0).otherwise(
        (group - 1) * side + 1 + F.coalesce(below(F.get(inside, group - 1)), F.lit(0))
    ).cast("int")


def fingerprint_edits(documents, doc_id="doc_id", text="text", rows_per_block=ROWS_PER_BLOCK):
    """Fingerprints of every text and of its edited text; see SCHEMA for the columns.

    The next document by descending id is a neighbour in a range partitioning:
    ranges of ids are fixed from their quantiles, and the first row of each range
    is also sent to the range before it, marked as a look-ahead.  The texts are
    shuffled once.
    """
    source = documents.select(
        # Null ids come after all others.
        F.coalesce(-F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("place"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    total = source.count()
    if not total:
        return documents.sparkSession.createDataFrame([], SCHEMA)
    ranges = min(blocks_of(total, rows_per_block), MOST_RANGES)
    cuts = source.approxQuantile("place", [k / ranges for k in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    cuts = sorted(set(cuts))
    dealt = source.withColumn("range", _range_of(F.col("place"), cuts))
    heads = {r[0]: r[1] for r in dealt.groupBy("range").agg(F.min("place")).collect()}  # one row per range
    order = sorted(heads)
    # The head of a range is looked ahead to from the range before; the first range's from the last.
    ahead = documents.sparkSession.createDataFrame(
        [(heads[r], order[k - 1]) for k, r in enumerate(order)], "head long, before int"
    )
    own = F.struct("range", F.lit(0).alias("look"))
    copied = (
        dealt.join(F.broadcast(ahead), F.col("place") == F.col("head"), "left")  # at most MOST_RANGES rows
        .withColumn("also", F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("range"), F.lit(1).alias("look"))))
        .select("place", "doc_id", "text", F.explode(F.array_compact(F.array(own, "also"))).alias("to"))
    )
    rows = copied.select("place", "doc_id", "text", "to.range", "to.look")

    def run(batches):
        """Rows come by range, then look-aheads after the range's own, each in order."""
        held, now = None, None
        for batch in batches:
            ids, texts, followings = [], [], []
            for row in batch.itertuples(index=False):
                if row.range != now:
                    held, now = None, row.range
                if held is not None:
                    ids.append(held[0])
                    texts.append(held[1])
                    followings.append(row.text)
                # Of the look-ahead rows only the first counts.
                held = (row.doc_id, row.text) if row.look == 0 else None
            if ids:
                yield _measures(ids, texts, followings)

    return (
        rows.repartitionById(len(cuts) + 1, "range")
        .sortWithinPartitions("range", "look", "place", "text")
        .select("range", "look", "doc_id", "text")
        .mapInPandas(run, SCHEMA)
    )
