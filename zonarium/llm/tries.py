"""Exact duplicate texts by compressed tries over adaptive ranges of text prefixes.

``prefix_cuts`` cuts all texts, in byte order, into ranges of bounded weight: prefixes
are counted over all texts, and only those that hold too much are counted on, past
all bytes that their texts share.  ``mark_copies`` deals the texts to these ranges and
inserts them whole into a compressed trie that holds the least id at a text's end.

Every task first has a trie of its own rows.  A row whose text it has met under a
smaller id is a copy, whatever other tasks hold; of the rest one row for each text
goes on.  So a text that a third of all rows share is sent once for each task.
"""

from bisect import bisect_right
from os.path import commonprefix
from zlib import crc32

import pyarrow as pa
from pyspark.sql import functions as F

from zonarium.llm.common import stored

#: Bytes of a prefix that are counted on in one round.
STEP = 3
#: Bytes beyond them, to see how far the texts of a prefix go on alike; where all do, four times as many in the next round.
AHEAD = 32
#: Bytes of every text that are kept for counting; more only where ranges need them.
HEAD = 256
#: Bytes of texts in a range at most (unless copies of one text hold more), and below which none is cut.
RANGE_BYTES = 64 << 20
LEAST_RANGE = 4 << 20
#: What a row weighs besides its text.
ROW_BYTES = 64
#: Bytes of different texts that a task holds before it sends them on.
HELD_BYTES = 16 << 20


def common_length(label, text, at):
    """Number of bytes that ``label`` and ``text`` from ``at`` have in common."""
    most = min(len(label), len(text) - at)
    low, step = 0, 8
    while low < most:
        high = min(low + step, most)
        if label[low:high] == text[at + low : at + high]:
            low, step = high, step * 2
        elif high - low == 1:
            break
        else:
            step = max(1, (high - low) // 2)
    return low


class TextTrie:
    """Compressed trie of byte strings; a node is [label, children by first byte, what it holds]."""

    def __init__(self):
        self.root, self.bytes = [b"", None, None], 0

    def node(self, text):
        """The node at which ``text`` ends, made if there is none."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            children = node[1]
            child = children.get(text[at]) if children else None
            if child is None:
                leaf = [text[at:], None, None]
                if children is None:
                    node[1] = children = {}
                children[text[at]] = leaf
                self.bytes += n - at + ROW_BYTES
                return leaf
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            k = common_length(label, text, at)
            upper = [label[:k], {label[k]: child}, None]
            child[0] = label[k:]
            children[text[at]] = upper
            node, at = upper, at + k
        return node

    def held(self):
        """(text, what its node holds) for every text, in byte order."""
        path, todo = [], [(0, self.root)]
        while todo:
            depth, node = todo.pop()
            del path[depth:]
            path.append(node[0])
            if node[2] is not None:
                yield b"".join(path), node[2]
            if node[1]:
                todo.extend((depth + 1, node[1][b]) for b in sorted(node[1], reverse=True))


class LeastIds:
    """A trie that holds, for each text, the rows of the least id that was met."""

    def __init__(self):
        self.trie = TextTrie()

    def add(self, text, doc, part, mask, n):
        """Rows (doc, part, mask, n) that are now known to be copies."""
        node = self.trie.node(text)
        held = node[2]
        if held is None:
            node[2] = [doc, mask, {part: n}]
        elif doc > held[0]:
            return ((doc, part, mask, n),)
        elif doc == held[0]:
            held[2][part] = held[2].get(part, 0) + n
        else:
            copies = [(held[0], p, held[1], c) for p, c in held[2].items()]
            node[2] = [doc, mask, {part: n}]
            return copies
        return ()

    def rest(self):
        """(text, doc, part, mask, n) of the least ids, in byte order of the texts."""
        for text, (doc, mask, parts) in self.trie.held():
            for part, n in parts.items():
                yield text, doc, part, mask, n


def prefix_cuts(texts, limit=None):
    """Sorted first prefixes of the ranges of ``texts`` (column ``text``, binary); the first is empty.

    A range holds at most twice ``limit`` bytes, or only copies of one text.
    """
    spark = texts.sparkSession

    def heads_of(source, size):
        return stored(
            source.select(F.substring("text", 1, size).alias("head"), (F.octet_length("text") + ROW_BYTES).cast("long").alias("weight")),
            "heads",
        )

    size = HEAD
    heads = heads_of(texts, size)
    total = heads.agg(F.sum("weight")).first()[0] or 0
    if limit is None:
        limit = min(RANGE_BYTES, max(LEAST_RANGE, total // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts, opened = [b""], {b"": AHEAD} if total > limit else {}
    while opened:
        longest = max(len(prefix) + STEP + ahead for prefix, ahead in opened.items())
        if longest > size:
            size = 4 * longest
            heads = heads_of(texts.filter(_under(opened)), size)
        counted = heads.mapInArrow(
            _children(sorted(opened.items())), "open int, child binary, weight long, low binary, high binary"
        )
        # The children of a prefix are at most 256^STEP, each from a task once.
        starts = (
            counted.repartitionById(len(opened), "open")
            .sortWithinPartitions("open", "child")
            .mapInArrow(_starts(limit), "open int, child binary, heavy boolean, low binary, high binary")
        )
        found = starts.collect()  # in proportion to total / limit
        cuts += [bytes(r.child) for r in found]
        last, opened = sorted(opened.items()), {}
        for r in found:
            if r.heavy:
                low, high, ahead = bytes(r.low), bytes(r.high), last[r.open][1]
                if low != high:
                    opened[commonprefix([low, high])] = AHEAD
                elif len(low) == len(r.child) + ahead:
                    opened[low] = 4 * ahead
                # Else the texts end here: copies of one text only.
    return sorted(set(cuts))


def _under(opened):
    """Whether a text starts with one of the prefixes."""
    size = {}
    for prefix in opened:
        size.setdefault(len(prefix), []).append(bytearray(prefix))
    found = F.lit(False)
    for n, prefixes in size.items():
        found = found | F.substring("text", 1, n).isin(prefixes)
    return found


def _children(opened):
    """Weight, lowest and highest start of the texts below each (prefix, bytes ahead), by their next bytes."""
    prefixes = [prefix for prefix, _ in opened]

    def run(batches):
        found = {}
        for batch in batches:
            for head, weight in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k = bisect_right(prefixes, head) - 1
                if k < 0 or not head.startswith(prefixes[k]):
                    continue
                prefix, ahead = opened[k]
                child = head[: len(prefix) + STEP]
                start = head[: len(child) + ahead]
                held = found.get((k, child))
                if held is None:
                    found[k, child] = [weight, start, start]
                else:
                    held[0] += weight
                    if start < held[1]:
                        held[1] = start
                    elif start > held[2]:
                        held[2] = start
        keys, values = list(found), list(found.values())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in keys], pa.int32()),
                pa.array([c for _, c in keys], pa.binary()),
                pa.array([v[0] for v in values], pa.int64()),
                pa.array([v[1] for v in values], pa.binary()),
                pa.array([v[2] for v in values], pa.binary()),
            ],
            names=["open", "child", "weight", "low", "high"],
        )

    return run


_STARTS = pa.schema(
    [("open", pa.int32()), ("child", pa.binary()), ("heavy", pa.bool_()), ("low", pa.binary()), ("high", pa.binary())]
)


def _starts(limit):
    """Of the children of each prefix, in order, those at which a range starts."""

    def run(batches):
        now, slots, found = None, None, []

        def close():
            """Puts the child that has been summed up into the range before it, or starts one."""
            nonlocal slots
            opened, child, weight, low, high = now
            heavy = weight > limit
            before = slots if slots and slots[0] == opened else None
            total = (before[1] if before else 0) + (0 if heavy else weight)
            if heavy or before is None or before[2] or total // limit != before[1] // limit:
                found.append((opened, child, heavy, low, high))
            slots = (opened, total, heavy)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and row[:2] == (now[0], now[1]):
                    now = [*row[:2], now[2] + row[2], min(now[3], row[3]), max(now[4], row[4])]
                    continue
                if now is not None:
                    close()
                now = list(row)
            yield _batch(found, _STARTS)
            found.clear()
        if now is not None:
            close()
        yield _batch(found, _STARTS)

    return run


_SENT = pa.schema(
    [("range", pa.int32()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("text", pa.binary())]
)
_DONE = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])


def _batch(rows, schema):
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def mark_copies(documents, mask_of, copy_bit, cuts=None, held_bytes=HELD_BYTES):
    """Columns doc_id, part, mask, n: per document, or n alike, its mask.

    ``documents``: doc_id, part, text.  ``mask_of(text bytes, code points)`` gives the other
    bits; ``copy_bit`` is set where a smaller id has the same text.  A row without an id
    is no copy and has none.
    """
    if cuts is None:
        cuts = prefix_cuts(documents.select(F.col("text").cast("binary").alias("text")))
    shared = documents.sparkSession.sparkContext.broadcast(cuts)  # in proportion to bytes / RANGE_BYTES

    def deal(batches):
        cuts = shared.value

        def sent(ids):
            return [(bisect_right(cuts, text) - 1, doc, part, mask, n, text) for text, doc, part, mask, n in ids.rest()]

        def settled(rows):
            # The same range each time a task is run.
            return [(crc32(f"{doc},{part}".encode()) % len(cuts), doc, part, mask, n, None) for doc, part, mask, n in rows]

        ids = LeastIds()
        for batch in batches:
            done = {}
            texts = batch.column(2)
            for doc, part, text, points in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts.cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()
            ):
                mask = mask_of(text, points)
                if doc is None:
                    done[doc, part, mask] = done.get((doc, part, mask), 0) + 1
                    continue
                for d, p, m, n in ids.add(text, doc, part, mask, 1):
                    done[d, p, m | copy_bit] = done.get((d, p, m | copy_bit), 0) + n
                if ids.trie.bytes > held_bytes:
                    yield _batch(sent(ids), _SENT)
                    ids = LeastIds()
            yield _batch(settled([(*k, n) for k, n in done.items()]), _SENT)
        yield _batch(sent(ids), _SENT)

    def settle(batches):
        ids = LeastIds()
        for batch in batches:
            out = []
            for doc, part, mask, n, text in zip(*(batch.column(k).to_pylist() for k in range(1, 6))):
                if text is None:
                    out.append((doc, part, mask, n))
                else:
                    out.extend((d, p, m | copy_bit, c) for d, p, m, c in ids.add(text, doc, part, mask, n))
            yield _batch(out, _DONE)
        yield _batch([(doc, part, mask, n) for _, doc, part, mask, n in ids.rest()], _DONE)

    dealt = documents.select("doc_id", "part", "text", F.length("text").alias("points")).mapInArrow(
        deal, "range int, doc_id long, part string, mask int, n long, text binary"
    )
    return dealt.repartitionById(len(cuts), "range").mapInArrow(settle, "doc_id long, part string, mask int, n long")
