"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted and optimised jointly.  Pieces are placed
longest first.  A piece goes to the open bin it fills best; if none holds it, a
bin of the least cost is opened: for every permitted length the cost of a bin is
divided by the tokens it can still be filled with (this piece and the shorter
pieces to come), and the cheapest wins.  At the end each bin is downsized to the
shortest permitted length that holds its contents.

A document longer than the longest bin is cut into pieces of that length and a
rest; no token is dropped.  Packing is done in blocks of a bounded number of
pieces, dealt out evenly whatever their ids, so no key can fill one task.

Defined results: a null length counts as 0; a document of length 0 has one row
with piece 0 and no bin; repeated rows are packed each; null ids are packed like
others; an empty table gives an empty result; other columns are ignored.
"""

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from zonarium.llm.common import blocks_of

#: Permitted sequence lengths, in tokens.
CAPACITIES = (512, 1024, 2048, 4096)
#: Fixed cost of a sequence, in tokens.
OVERHEAD = 32
#: Length at which attention costs as much as everything else.
QUADRATIC_AT = 16384
#: Pieces packed together.
BLOCK_PIECES = 50_000
SCHEMA = "doc_id long, piece int, bin_id string, capacity int, start int, n_tokens int, piece_start long"


def bin_cost(capacity, overhead=OVERHEAD, quadratic_at=QUADRATIC_AT):
    return overhead + capacity + capacity * capacity / quadratic_at


def pack(lengths, capacities=CAPACITIES, cost=bin_cost):
    """Bin, start and bin capacity of each piece; lengths descend and fit the longest bin.

    Open bins are kept by room left; one integer holds which rooms occur, so the
    tightest room for a piece is found with a shift.
    """
    capacities = sorted(capacities)
    still = sum(lengths)
    rooms, has = {}, 0
    used, placed = [], []
    for n in lengths:
        still -= n
        fits = has >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            stack = rooms[room]
            at = stack.pop()
            if not stack:
                has &= ~(1 << room)
        else:
            # ``still`` is what shorter pieces can add to the bin.
            room = min((c for c in capacities if c >= n), key=lambda c: (cost(c) / min(c, n + still), c))
            at = len(used)
            used.append(0)
        placed.append((at, used[at]))
        used[at] += n
        room -= n
        if room:
            rooms.setdefault(room, []).append(at)
            has |= 1 << room
    sizes = [next(c for c in capacities if c >= u) for u in used]
    return [(at, start, sizes[at]) for at, start in placed]


def pack_documents(documents, length, doc_id="doc_id", capacities=CAPACITIES, block_pieces=BLOCK_PIECES):
    """Pack every document; ``length`` is a column with its number of tokens.

    One row per piece: doc_id, piece (from 0), bin_id, capacity of the bin, start
    in the bin, n_tokens, piece_start (first token of the piece in its document).
    """
    top = max(capacities)
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(length.cast("long"), F.lit(0)).alias("n")
    )
    pieces = rows.select(
        "doc_id",
        "n",
        F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / top).cast("int") - 1, F.lit(0)))).alias("piece"),
    ).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * top).alias("piece_start"),
        F.least(F.col("n") - F.col("piece").cast("long") * top, F.lit(top)).cast("int").alias("n_tokens"),
    )

    def run(batches):
        task, block, held, count = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            while count >= block_pieces:
                whole = pd.concat(held)
                yield packed(whole[:block_pieces], task, block)
                held, count, block = [whole[block_pieces:]], count - block_pieces, block + 1
        if count:
            yield packed(pd.concat(held), task, block)

    def packed(frame, task, block):
        frame = frame.reset_index(drop=True).sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True])
        full = frame[frame.n_tokens > 0]
        found = pack(full.n_tokens.tolist(), capacities)
        out = pd.DataFrame(
            {
                "bin_id": [f"{task}-{block}-{at}" for at, _, _ in found],
                "start": [start for _, start, _ in found],
                "capacity": [size for _, _, size in found],
            },
            index=full.index,
        ).astype({"start": "int32", "capacity": "int32"})
        joined = pd.concat(
            [full.assign(**{c: out[c] for c in out}), frame[frame.n_tokens <= 0]], ignore_index=True
        )
        return joined.astype({"start": "Int32", "capacity": "Int32"})[
            ["doc_id", "piece", "bin_id", "capacity", "start", "n_tokens", "piece_start"]
        ]

    # Dealt out row by row; Spark sorts before it does so, hence a repeated task gets the same rows.
    blocks = blocks_of(pieces.count(), block_pieces)
    return pieces.repartition(blocks).mapInPandas(run, SCHEMA)


def word_count(text):
    """Number of words between white space, as a column; null or empty: 0."""
    trimmed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^[ \t\n\r\x0B\f]+", "")
    return F.when(trimmed == "", 0).otherwise(
        F.size(F.split(trimmed, r"[ \t\n\r\x0B\f]+")) - F.when(F.col(text).rlike(r"[ \t\n\r\x0B\f]$"), 1).otherwise(0)
    )
