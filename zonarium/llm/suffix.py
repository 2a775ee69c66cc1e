"""Removal of repeated byte strings, found with suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere is
removed.  Sorting all suffixes of a corpus in one array would need one machine;
here strings are first dealt to shards such that equal strings meet:

1. The anchor of a string is the place of the least hash among its runs of
   ``GRAM`` bytes, so equal strings have equal anchors.  Neighbouring strings
   mostly share theirs; a range of string starts with one anchor, and the bytes
   these strings cover, is a piece.  Pieces are a few bytes per hundred of text.
2. Pieces whose anchor run occurs once hold no repeated string.  Equal pieces
   (same anchor and bytes, by two independent 64-bit hashes) are counted as one.
3. Of the rest, one piece of each kind goes to a shard of its anchor.  A shard
   drops starts whose strings hold bytes about the anchor that no other piece has,
   sorts the suffixes at the other starts by prefix doubling, as far as a string
   reaches, and marks starts whose string has an equal neighbour.
4. An anchor with more than ``MOST`` different pieces (a passage in very many
   documents) does not go to a shard: its pieces are halved, and each half is
   keyed by all bytes its strings share, until the groups are small or equal.
   That is exact, and needs at most as many rounds as there are halvings.

Copies of a text need no treatment of their own: their pieces are equal.

Passages are found in the same way, with words (by 64-bit hashes of their bytes) in
place of bytes: sequences of ``PASSAGE_WORDS`` words that also stand in another
document.  Rows equal in id and text are one document here.  A piece that only its
own document repeats counts once, and what is found in one place of it holds for all.

Defined results: a null text is empty; texts shorter than ``LENGTH`` lose
nothing; repeated rows repeat each other; a null id is an id; matches never
cross texts; an empty table gives an empty result; other columns are ignored by
``repeated_spans`` and kept by ``remove_repeats``.
"""

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonarium.llm.common import blocks_of, stored, text_or_empty
from zonarium.llm.sais import ranks_to

LENGTH = 400
#: A passage: over 50 words, and as many bytes as 51 words rarely fall short of.
PASSAGE_LENGTH = 200
PASSAGE_WORDS = 51
GRAM = 128
WORD_GRAM = 16
#: Bytes of a symbol: strings consist of bytes, passages of hashes of words.
BYTE, WORD = 1, 8
#: Different pieces of one anchor that go to one shard.
MOST = 512
#: Pieces in a shard; what is sorted of them is mostly about half a megabyte.
SHARD_PIECES = 2000
#: Ranges of a piece's starts whose common bytes are compared before sorting.
RANGES = 32
#: Bytes anchors are looked for in at a time; longer texts overlap.
WINDOW = 1 << 20
#: Bytes of texts that are taken together, so that no array operation works on a few only.
CHUNK = 1 << 17
_rng = np.random.default_rng(20240731)
_VALUES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
_WORD_FACTORS = [0x9E6C63D0876A9A47, 0xE7037ED1A0B428DB]
_BASES = [0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1]


class _Powers:
    """Powers of the bases and of their inverses, as long as has been needed."""

    def __init__(self):
        self.size, self.up, self.down = 0, [], []

    def upto(self, n):
        if n > self.size:
            size = max(n, 1 << 16, 2 * self.size)
            self.up, self.down = [], []
            for base in _BASES:
                for store, x in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
                    powers = np.full(size, x, np.uint64)
                    powers[0] = 1
                    store.append(np.multiply.accumulate(powers))
            self.size = size
        return self.up, self.down


def _prefix_hashes(data, which, powers):
    up, _ = powers.upto(len(data) + 1)
    if data.dtype == np.uint8:
        values = _VALUES[which].take(data)
    else:  # hashes of words
        values = data * np.uint64(_WORD_FACTORS[which])
        values ^= values >> np.uint64(32)
    out = np.zeros(len(data) + 1, np.uint64)
    values *= up[which][: len(data)]
    np.cumsum(values, out=out[1:])
    return out


def _mixed(value):
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(29)
    return value


def _between(prefix, which, start, end, powers):
    """Hash of the symbols from start to end, wherever they stand."""
    return _mixed((prefix[end] - prefix[start]) * powers.upto(1)[1][which][start])


def _grams(prefix, which, gram, powers):
    """Hashes of all runs of ``gram`` symbols."""
    value = prefix[gram:] - prefix[:-gram]
    return _mixed(value * powers.upto(1)[1][which][: len(value)])


def word_places(data):
    """Where the words of a text start and end; they are what white space parts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _together(texts):
    """Texts with a space after each but the last, about ``CHUNK`` bytes at a time: first text, starts, ends, bytes."""
    first = 0
    while first < len(texts):
        after, size = first + 1, len(texts[first])
        while after < len(texts) and size + len(texts[after]) < CHUNK:
            size += len(texts[after]) + 1
            after += 1
        sizes = np.array([len(t) for t in texts[first:after]])
        ends = np.cumsum(sizes + 1) - 1
        yield first, ends - sizes, ends, np.frombuffer(b" ".join(texts[first:after]), np.uint8)
        first = after


def _words(data, starts, ends, prefix, powers):
    """A 64-bit hash for each word of texts with these prefix hashes; where the words of each start and end."""
    first, last = word_places(data)
    return _between(prefix, 0, first, last, powers), np.searchsorted(first, starts), np.searchsorted(first, ends)


def pieces(data, length, gram, powers, prefix=None, starts=None, ends=None):
    """Pieces of a text: first and last string start, anchor, anchor hash, piece hash.

    ``data``: bytes or hashes of words, in which all places are counted; ``prefix``:
    their prefix hashes, if known; ``starts``, ``ends``: of the texts in it, if it
    holds several.
    """
    n = len(data)
    if n < length:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    powers.upto(n + 1)
    grams = _grams(_prefix_hashes(data, 0, powers) if prefix is None else prefix, 0, gram, powers)
    width = length - gram + 1
    anchors = []
    for at in range(0, n - length + 1, WINDOW):
        own = grams[at : at + WINDOW + width - 1]
        m = len(own)
        # The least hash, of equal ones the first: the place stands in the low bits.
        keys = (own & ~np.uint64(0x3FFFFF)) | np.arange(m, dtype=np.uint64)
        padded = np.full(-(-m // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:m] = keys
        tiles = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(tiles, axis=1).ravel()
        behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
        count = m - width + 1
        least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        anchors.append((least & np.uint64(0x3FFFFF)).astype(np.int64) + at)
    anchor = np.concatenate(anchors)
    new = np.ones(len(anchor), bool)
    np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
    if starts is not None:  # a text's first string, and the first one that would cross its end
        new[starts[starts < len(new)]] = True
        crossing = np.maximum(ends - length + 1, starts)
        new[crossing[crossing < len(new)]] = True
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(anchor)) - 1
    if starts is not None:
        inside = low + length <= ends[np.searchsorted(starts, low, side="right") - 1]
        low, high = low[inside], high[inside]
    at = anchor[low]
    second = _prefix_hashes(data, 1, powers)
    whole = _between(second, 1, low, high + length, powers)
    # Where the strings stand about the anchor belongs to the piece.
    whole = (whole ^ (at - low).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)) * np.uint64(0x9FB21C651E98DF25)
    return [low, high, at, grams[at], whole ^ whole >> np.uint64(31)]


def _all_pieces(rows, strings):
    def run(batches):
        powers = _Powers()
        for batch in batches:
            parts = [[] for _ in range(7)]
            rids = batch.column(0).to_numpy()
            for first, starts, ends, data in _together(batch.column(1).cast(pa.binary()).to_pylist()):
                prefix = _prefix_hashes(data, 0, powers)
                for width, (length, gram) in strings.items():
                    if width == BYTE:
                        own, found = starts, pieces(data, length, gram, powers, prefix, starts, ends)
                    else:
                        words, own, last = _words(data, starts, ends, prefix, powers)
                        found = pieces(words, length, gram, powers, None, own, last)
                    if len(found[0]):
                        text = np.searchsorted(own, found[0], side="right") - 1
                        parts[0].append(rids[first + text])
                        parts[1].append(np.full(len(text), width, np.int32))
                        for store, values in zip(parts[2:5], found):
                            store.append(values - own[text])
                        for store, values in zip(parts[5:], found[3:]):
                            store.append(values)
            if parts[0]:
                rid, width, low, high, at, key, whole = map(np.concatenate, parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rid),
                        pa.array(width),
                        pa.array(low.astype(np.int32)),
                        pa.array(high.astype(np.int32)),
                        pa.array(at.astype(np.int32)),
                        pa.array(key.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                    ],
                    names=["rid", "width", "low", "high", "anchor", "key", "whole"],
                )

    return rows.mapInArrow(run, "rid long, width int, low int, high int, anchor int, key long, whole long")


def _starts(texts, spans, length):
    """All texts' symbols in one array, each one's text and place in it, and the starts of strings within the spans."""
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
    own = (place >= spans[owner, 0]) & (place <= spans[owner, 1]) & (place + length <= sizes[owner])
    return owner, place, np.flatnonzero(own)


def mark_repeats(texts, spans, length):
    """Starts in each text, within its span of starts, whose string also starts in another place.

    ``texts``: byte strings whose spans of starts are different places.
    """
    owner, place, starts = _starts(texts, spans, length)
    marked = np.zeros(len(owner), bool)
    ranks = ranks_to(np.frombuffer(b"".join(texts), np.uint8), starts, length)
    marked[starts] = np.bincount(ranks)[ranks] > 1
    return marked, owner, place


def mark_passages(texts, spans, length, owners):
    """Starts in each text, within its span, whose words also start in a text of another owner.

    ``texts``: hashes of words.
    """
    owner, place, starts = _starts(texts, spans, length)
    marked = np.zeros(len(owner), bool)
    ranks = ranks_to(np.concatenate(texts), starts, length)
    whose = np.unique(np.asarray(owners), return_inverse=True)[1][owner[starts]]
    some = np.zeros(len(starts), np.int64)
    some[ranks] = whose  # one owner of each string
    shared = np.zeros(len(starts), bool)
    shared[ranks[whose != some[ranks]]] = True
    marked[starts] = shared[ranks]
    return marked, owner, place


def _runs(starts, length):
    """(from, to) of the bytes that strings at ascending starts cover, in maximal runs."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length) + 1
    return list(zip(starts[np.concatenate([[0], cut])].tolist(), (starts[np.append(cut - 1, len(starts) - 1)] + length).tolist()))


def _worth_sorting(rows, length, gram, width):
    """(row, from, to) of the starts in each row's data that may have an equal string.

    A piece's starts fall into ranges by their distance from the anchor.  All strings
    of a range hold the same bytes about the anchor; if no other piece of the anchor
    has these bytes there, the range has no repeat.
    """
    step = -(-(length - gram + 1) // RANGES)
    low, high, anchor, key = (np.array(rows[n], np.int64) for n in ("low", "high", "anchor", "key"))
    data = np.frombuffer(b"".join(rows["data"]), np.uint8 if width == BYTE else np.uint64)
    sizes = high - low + length
    base = np.cumsum(sizes) - sizes
    at, last = anchor - low, high - low
    lowest = (at - last) // step
    ranges = at // step + 1 - lowest
    row = np.repeat(np.arange(len(low)), ranges)
    k = np.arange(len(row)) - (np.cumsum(ranges) - ranges - lowest)[row]
    near, far = k * step, np.minimum(k * step + step - 1, length - gram)
    # Equal hashes of other bytes only cost sorting.
    powers = _Powers()
    core = _between(_prefix_hashes(data, 0, powers), 0, (base + at)[row] - near, (base + at)[row] - far + length, powers)
    core = _mixed(core ^ key.astype(np.uint64)[row] * np.uint64(0xA24BAED4963EE407)) ^ k.astype(np.uint64)
    _, kind, seen = np.unique(core, return_inverse=True, return_counts=True)
    kept = seen[kind] > 1
    row, near, far = row[kept], near[kept], far[kept]
    if not len(row):
        return []
    first, final = np.maximum(0, at[row] - far), np.minimum(last[row], at[row] - near)
    heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    return list(zip(row[heads].tolist(), np.minimum.reduceat(first, heads).tolist(), np.maximum.reduceat(final, heads).tolist()))


def _shard(strings):
    def run(rows):
        rows = rows.sort_values(["rid", "low"]).reset_index(drop=True)
        width = int(rows["width"].iloc[0])
        length, gram = strings[width]
        open_places = _worth_sorting(rows, length, gram, width)
        out = []
        if open_places:
            data, rids, lows = rows["data"].tolist(), rows["rid"].tolist(), rows["low"].tolist()
            places, single = rows["place"].tolist(), rows["single"].tolist()
            texts = [data[row][a * width : (b + length) * width] for row, a, b in open_places]
            spans = np.array([(0, b - a) for _, a, b in open_places])
            if width == BYTE:
                marked, owner, place = mark_repeats(texts, spans, length)
            else:
                # A piece that is not single stands for other documents than any that is.
                codes = pd.factorize(rows["rid"])[0]
                owners = [codes[row] if single[row] else -1 - row for row, _, _ in open_places]
                marked, owner, place = mark_passages([np.frombuffer(t, np.uint64) for t in texts], spans, length, owners)
            edges = np.searchsorted(owner, np.arange(len(texts) + 1))
            for k, (row, first, _) in enumerate(open_places):
                if single[row]:
                    inside = slice(edges[k], edges[k + 1])
                    low = lows[row] + first
                    out.extend((rids[row], width, places[row], low + a, low + b) for a, b in _runs(place[inside][marked[inside]], length))
        return pd.DataFrame(out, columns=["rid", "width", "place", "begin", "end"]).astype("int64")

    return run


def _with_counts(rows, kinds, most):
    """rows joined with n of their kind (key and whole), and kinds, of_key and singles of their key.

    The counts are written first: both sides of the join are then plain exchanges
    that Spark can split where one key is very common.  There are at most ``most`` kinds.
    """
    kinds = stored(kinds, "kinds", most)
    different = kinds.count()
    keys = kinds.groupBy(F.col("key").alias("of")).agg(
        F.count("*").alias("kinds"), F.sum("n").alias("of_key"), F.count_if(F.col("n") == 1).alias("singles")
    )
    keys = stored(keys.filter("of_key > 1"), "keys", different)
    counts = stored(kinds.join(keys, F.col("key") == F.col("of")).drop("of"), "counts", different)
    return rows.join(counts, ["key", "whole"])


def _halved(rows, strings):
    """Pieces of too common anchors, each cut in two at a place fixed by the anchor.

    The key of a half is the hash of all bytes that its strings must share.
    """
    numbers = ("width", "place", "low", "high", "anchor", "near", "far")

    def run(batches):
        for batch in batches:
            out = {name: [] for name in ("rid", *numbers, "key", "whole", "data")}
            for row in batch.to_pylist():
                middle = (row["near"] + row["far"]) // 2
                width, length = row["width"], strings[row["width"]][0]
                cut = lambda a, b: row["data"][(a - row["low"]) * width : (b - row["low"]) * width]  # noqa: B023, E731
                for near, far in ((row["near"], middle), (middle + 1, row["far"])):
                    low, high = max(row["low"], row["anchor"] - far), min(row["high"], row["anchor"] - near)
                    if near > far or low > high:
                        continue
                    data = cut(low, high + length)
                    # Strings start ``near`` to ``far`` symbols before the anchor; all cover these:
                    core = cut(row["anchor"] - near, row["anchor"] - far + length)
                    mark = f"{row['key']},{near},{far}".encode()
                    digest = hashlib.blake2b(core, digest_size=8, key=mark[:64]).digest()
                    kind = hashlib.blake2b(data, digest_size=8, key=f"{row['anchor'] - low}".encode()).digest()
                    for name, value in (
                        ("rid", row["rid"]), ("width", width), ("place", row["place"]), ("low", low), ("high", high),
                        ("anchor", row["anchor"]), ("near", near), ("far", far), ("data", data),
                        ("key", int.from_bytes(digest, "big", signed=True)),
                        ("whole", int.from_bytes(kind, "big", signed=True)),
                    ):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema(
                    [("rid", pa.int64())]
                    + [(n, pa.int32()) for n in numbers]
                    + [("key", pa.int64()), ("whole", pa.int64()), ("data", pa.binary())]
                ),
            )

    return rows.select("rid", *numbers, "key", "data").mapInArrow(
        run, f"rid long, {', '.join(f'{n} int' for n in numbers)}, key long, whole long, data binary"
    )


def _cut(rows, strings):
    """Texts with their pieces' places -> the pieces with their symbols."""

    def run(batches):
        powers = _Powers()
        names = ("width", "low", "high", "anchor", "key", "n", "kinds")
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy()
            places = batch.column(2).flatten()
            width, low, high = (places.field(n).to_numpy() for n in names[:3])
            edges = np.concatenate([[0], np.cumsum(sizes)])
            data = []
            for first, starts, ends, text in _together(batch.column(1).cast(pa.binary()).to_pylist()):
                after = first + len(starts)
                inside = slice(edges[first], edges[after])
                of = np.repeat(np.arange(len(starts)), sizes[first:after])
                symbols = {BYTE: (text, starts)}
                if WORD in strings:
                    symbols[WORD] = _words(text, starts, ends, _prefix_hashes(text, 0, powers), powers)[:2]
                for k, w, a, b in zip(of.tolist(), width[inside].tolist(), low[inside].tolist(), high[inside].tolist()):
                    whole, own = symbols[w]
                    data.append(whole[own[k] + a : own[k] + b + strings[w][0]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), sizes)),
                    *(places.field(n) for n in names),
                    pa.array(data, pa.binary()),
                ],
                names=["rid", *names, "data"],
            )

    return rows.mapInArrow(
        run, "rid long, width int, low int, high int, anchor int, key long, n long, kinds long, data binary"
    )


def _in_shards(rows, strings):
    """Spans of repeated strings of pieces that are single, found in shards of whole keys."""
    shards = blocks_of(rows.count(), SHARD_PIECES * len(strings))
    return (
        rows.select(
            "rid", "width", "place", "key", "low", "high", "anchor", "data",
            (F.col("n") == 1).alias("single"), F.pmod("key", F.lit(shards)).alias("shard"),
        )
        .groupBy("width", "shard")
        .applyInPandas(lambda rows: _shard(strings)(rows), "rid long, width int, place int, begin long, end long")
    )


def _spans_found(rows, strings, most):
    """Rows (rid, text) -> (rid, width, begin, end) of repeated strings; spans of a text may overlap.

    ``strings``: bytes of a symbol -> symbols of a string, and of a run that can be an anchor.
    """
    in_others = lambda: (F.max("width") > BYTE) & (F.min("rid") == F.max("rid"))
    found = stored(_all_pieces(rows, strings), "pieces")
    # Strings of bytes may repeat in their own text, passages only in other documents.
    twice = found.groupBy("key").agg(F.count("*").alias("of"), in_others().alias("own"))
    twice = twice.filter("of > 1 AND NOT own").select("key")
    again = stored(found.join(stored(twice, "keys", found.count() // 2), "key"), "again")
    repeated = again.count()
    # Row and place as one number, which hash aggregation takes.  Of a kind in several rows two may have
    # the least one, by chance; both then stand for it.
    one = F.col("rid").bitwiseAND(F.lit(-1 << 31)).bitwiseOR(F.col("low").cast("long"))
    kinds = again.groupBy("key", "whole").agg(
        F.when(in_others(), F.lit(1)).otherwise(F.count("*")).alias("n"), F.min(one).alias("best")
    )
    hits = stored(_with_counts(again, kinds, repeated), "hits", repeated)
    length = F.element_at(F.create_map(*(F.lit(x) for w, (size, _) in strings.items() for x in (w, size))), F.col("width"))
    covered = lambda kind, place: kind.select(
        "rid", "width", place, F.col("low").cast("long").alias("begin"), (F.col("high") + length).cast("long").alias("end")
    )
    spans = [covered(hits.filter("n > 1"), F.col("low").alias("place"))]
    # One of each kind, if there are singles beside it.
    of_kind = one == F.col("best")
    to_cut = hits.filter("singles > 0 AND kinds > 1").filter(of_kind)
    places = (
        to_cut
        .dropDuplicates(["rid", "width", "low"])
        .groupBy("rid")
        .agg(F.collect_list(F.struct("width", "low", "high", "anchor", "key", "n", "kinds")).alias("places"))
    )
    texts = rows.join(places, "rid").select("rid", "text", "places").dropDuplicates(["rid"])
    left = stored(_cut(texts, strings), "shards", to_cut.count(), SHARD_PIECES).withColumn("place", F.col("low"))
    reach = F.element_at(F.create_map(*(F.lit(x) for w, (size, gram) in strings.items() for x in (w, size - gram))), F.col("width"))
    left = left.withColumn("near", F.lit(0)).withColumn("far", reach)
    while True:
        spans.append(stored(_in_shards(left.filter(F.col("kinds") <= most), strings), "spans"))
        common = left.filter(F.col("kinds") > most)
        halved = 2 * common.count()
        if not halved:
            break
        # A kind whose other rows were set aside stands for them: it counts as two.
        halves = _halved(common.filter("n = 1"), strings).withColumn("n0", F.lit(1))
        stand_ins = _halved(common.filter("n > 1"), strings).withColumn("n0", F.lit(2))
        halves = halves.unionByName(stand_ins)
        halves = stored(halves, "halves", halved)
        kinds = halves.groupBy("key", "whole").agg(
            F.when(in_others() & (F.max("n0") == 1), F.lit(1)).otherwise(F.sum("n0")).alias("n"),
            F.min(F.struct("n0", "rid", "low")).alias("best"),
        )
        now = stored(_with_counts(halves, kinds, halved), "halves", halved)
        spans.append(covered(now.filter("n > 1 AND n0 = 1"), "place"))
        left = now.filter(
            "singles > 0 AND kinds > 1 AND (n = 1 OR (n0 = best.n0 AND rid = best.rid AND low = best.low))"
        ).select("rid", "width", "place", "low", "high", "anchor", "near", "far", "key", "n", "kinds", "data")
    whole, *others = spans
    for more in others:
        whole = whole.unionByName(more)
    if WORD in strings:
        # Other places of the same piece in its document; whole pieces that repeat have none.
        place = F.col("best").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
        twins = hits.filter(F.col("n") == 1).filter((F.col("width") == WORD) & ~of_kind).select(
            "rid", "width", place.alias("place"), (F.col("low") - place).alias("shift")
        )
        found = reduce(DataFrame.unionByName, others).filter(F.col("width") == WORD)
        there = found.join(twins, ["rid", "width", "place"])
        there = there.select("rid", "width", "place", *((F.col(c) + F.col("shift")).alias(c) for c in ("begin", "end")))
        whole = whole.unionByName(there)
    return whole.drop("place")


def repeated_spans(rows, length=LENGTH, gram=None, most=MOST):
    """Rows (rid, text) -> (rid, begin, end): bytes to remove; spans of a text may overlap."""
    return _spans_found(rows, _strings(length, gram), most).drop("width")


def _strings(length, gram=None, passage_words=None):
    strings = {BYTE: (length, gram or max(1, min(GRAM, length // 3)))}
    if passage_words:
        strings[WORD] = (passage_words, max(1, min(WORD_GRAM, passage_words // 3)))
    return strings


def merged(spans):
    """Sorted, joined spans of one text."""
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def kept_bytes(data, spans):
    at, parts = 0, []
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts)


def _with_spans(documents, doc_id, text, strings, most):
    """Documents with the spans of each text in ``__spans``."""
    marked = documents.withColumn(
        "__rid", F.xxhash64(F.col(doc_id).cast("string"), text_or_empty(text), F.lit("row"))
    )
    rows = marked.select(F.col("__rid").alias("rid"), text_or_empty(text).alias("text"))
    spans = _spans_found(rows, strings, most)
    by_text = spans.groupBy(F.col("rid").alias("__rid")).agg(
        F.collect_set(F.struct("width", "begin", "end")).alias("__spans")
    )
    return marked.join(by_text, "__rid", "left").drop("__rid")


def _of_width(spans, width):
    """Joined spans of the strings whose symbols have that many bytes."""
    return merged([(s["begin"], s["end"]) for s in (() if spans is None else spans) if s["width"] == width])


def _of_batch(column):
    """The joined spans of each row of a batch: (row, width) -> runs, for rows that have any."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    width, begin, end = (c.to_numpy() for c in column.flatten().flatten())
    if not len(begin):
        return {}
    group = np.repeat(np.arange(len(sizes)), sizes) * (WORD + 1) + width
    # Groups lie one after the other, with a gap, so that one running maximum serves all.
    reach = int(end.max()) + 1
    order = np.lexsort((begin, group))
    group, begin, end = group[order], begin[order], end[order]
    far = np.maximum.accumulate(end + group * reach)
    heads = np.flatnonzero(np.concatenate([[True], begin[1:] + group[1:] * reach > far[:-1]]))
    out = {}
    last = far[np.append(heads[1:], len(far)) - 1] - group[heads] * reach
    for g, a, b in zip(group[heads].tolist(), begin[heads].tolist(), last.tolist()):
        out.setdefault(divmod(g, WORD + 1), []).append((a, b))
    return out


def passages(data, spans):
    """Runs of words as runs of a text's bytes."""
    if not spans:
        return []
    starts, ends = word_places(np.frombuffer(data, np.uint8))
    return [(int(starts[a]), int(ends[b - 1])) for a, b in spans]


def removal_report(documents, doc_id="doc_id", text="text", length=LENGTH, most=MOST, passage_words=None):
    """Columns doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    With ``passage_words``, also n_passages and passage_bytes: the maximal runs of words
    that sequences of so many words cover which also stand in another document, and
    the bytes from the first to the last word of each.  They are not removed.
    """
    joined = _with_spans(
        documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")),
        "doc_id", "text", _strings(length, passage_words=passage_words), most,
    )
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["n_passages", "passage_bytes"] * bool(passage_words)
    kinds = [pa.string() if n == "kept_sha256" else pa.int64() for n in names]

    def run(batches):
        for batch in batches:
            out = []
            found = _of_batch(batch.column(2))
            for k, (i, body) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                data = (body or "").encode()
                joined = found.get((k, BYTE), [])
                rest = kept_bytes(data, joined)
                row = (i, len(data), len(data) - len(rest), len(joined), hashlib.sha256(rest).hexdigest())
                if passage_words:
                    shared = passages(data, found.get((k, WORD), []))
                    row += (len(shared), sum(b - a for a, b in shared))
                out.append(row)
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return joined.select("doc_id", "text", "__spans").mapInArrow(
        run, ", ".join(f"{n} {'string' if n == 'kept_sha256' else 'long'}" for n in names)
    )


def of_words(data, spans, least):
    """Those of the spans that hold at least so many words."""
    return [(a, b) for a, b in spans if len(data[a:b].split()) >= least]


def remove_repeats(documents, doc_id="doc_id", text="text", length=LENGTH, most=MOST, least_words=0):
    """The documents with repeated strings taken out of their text; all columns stay.

    A run of bytes that repeated strings cover is taken out if it holds at least
    ``least_words`` words.  Bytes of a character that is cut are dropped with it; a
    null text stays null.
    """
    joined = _with_spans(documents, doc_id, text, _strings(length), most)

    def rest(body, spans):
        data = body.encode()
        taken = of_words(data, _of_width(spans, BYTE), least_words)
        return kept_bytes(data, taken).decode("utf-8", errors="ignore") if taken else body

    @F.pandas_udf("string")
    def cut(body: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [
                b if b is None or s is None or not len(s) else rest(b, s)
                for b, s in zip(body, spans)
            ],
            dtype=object,
        )

    return joined.withColumn(
        text, F.when(F.col("__spans").isNull(), F.col(text)).otherwise(cut(F.col(text), F.col("__spans")))
    ).select(*documents.columns)
