"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) P(word | class).  The class of a word is
that of its hash bucket; buckets are grouped by the words that precede them.  The
first factor is a log-linear model over hashed features: the last word, the last
two words (n-grams) and the word before the last (a skip).  The second is the
word's smoothed share of its class, from counts over the whole training corpus.

Training is synchronous and distributed.  Each round takes another fold of the
training documents; tasks sum seen and expected classes over their documents in
sparse numpy batches, the sums of a fixed-size table are added up by block, and
one scaled gradient step is made.  Every training document is used once for the
gradient and once for the counts.

Word counts are looked up without a table of all words in any task: the
``FREQUENT`` most frequent words go to the tasks, the others are joined by word.

Defined results: a null text is empty and has one token, the end; a null id is
neither held out nor learnt from; repeated rows are scored each; words that were
not seen in training have a count of 0; with no training document every count is
0; an empty table gives an empty result; other columns are ignored.
"""

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from zonarium.llm.common import stored, text_or_empty

END = b"\n"
SMOOTHING = 0.1
CLASSES = 16
#: Buckets that share a class, and contexts they are grouped by.
BUCKETS, CONTEXTS = 1 << 13, 32
#: Rows of the weight table of each kind of feature.
ROWS = 1 << 15
KINDS = 3
ROUNDS = 4
RATE, DAMPING = 0.6, 4.0
#: Most frequent words whose counts are sent to the tasks, and their length in bytes at most.
FREQUENT, FREQUENT_BYTES = 150_000, 64
#: Different words a task counts before it gives them out.
COUNTED = 300_000
CHUNK = 1 << 15
#: Tokens a task holds at a time, and those of one text more.
SLICE_TOKENS = 200_000
BLOCKS = 64
_START = np.uint32(0x5BD1E995)


def tokens_of(text):
    """Words between ASCII white space, A-Z in lower case, then the end."""
    words = text.encode().lower().split()
    words.append(END)
    return words


def _hashes(words):
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def features(hashes, starts):
    """Rows of the weight tables for each token: last word, last two words, word before the last."""
    one = np.empty_like(hashes)
    one[1:] = hashes[:-1]
    one[starts] = _START
    two = np.empty_like(hashes)
    two[1:] = one[:-1]
    two[starts] = _START
    shift = np.uint32(32 - 15)
    return (
        (one * np.uint32(0x9E3779B1) >> shift).astype(np.uint16),
        ((one * np.uint32(0x85EBCA77) ^ two) * np.uint32(0xC2B2AE3D) >> shift).astype(np.uint16),
        (two * np.uint32(0x27D4EB2F) >> shift).astype(np.uint16),
    )


def class_scores(weights, bias, rows):
    """Unnormalised log scores of the classes for tokens with these feature rows.

    Steps are clipped in training, so that their exponentials stay finite.
    """
    z = weights[0].take(rows[0], axis=0)
    z += weights[1].take(rows[1], axis=0)
    z += weights[2].take(rows[2], axis=0)
    z += bias
    return z


def log_probability(weights, bias, rows, own):
    """log P(own class | history) of each token."""
    z = class_scores(weights, bias, rows)
    chosen = z[np.arange(len(z)), own]
    np.exp(z, out=z)
    return chosen - np.log(z @ np.ones(z.shape[1], z.dtype))


def _texts(batches, column):
    """Slices of batches as (slice, tokens of all texts, start of each text, tokens of each).

    A slice ends with the text that brings it to ``SLICE_TOKENS`` tokens.
    """
    for batch in batches:
        first, words, lengths = 0, [], []
        for at, text in enumerate(batch.column(column)):
            own = tokens_of(text.as_py())
            words += own
            lengths.append(len(own))
            if len(words) >= SLICE_TOKENS or at + 1 == batch.num_rows:
                sizes = np.array(lengths, np.int64)
                yield batch.slice(first, at + 1 - first), words, np.cumsum(sizes) - sizes, sizes
                first, words, lengths = at + 1, [], []


def count_words(rows):
    """(word, n) over all texts; tasks give out sums of bounded tables."""

    def run(batches):
        found = Counter()

        def flush():
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
            )
            found.clear()
            return made

        for batch in batches:
            for text in batch.column(0):
                found.update(tokens_of(text.as_py()))
                if len(found) > COUNTED:
                    yield flush()
        if found:
            yield flush()

    return rows.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _summed(rows, size):
    """Sum of tables given out as (block, values: float32 bytes), collected: ``size`` numbers."""
    per = size // BLOCKS

    def add(batches):
        sums = {}
        for batch in batches:
            for block, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(values, np.float32)
                if block in sums:
                    sums[block] += values
                else:
                    sums[block] = values.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.astype(np.float32).tobytes() for v in sums.values()], pa.binary())],
            names=["block", "values"],
        )

    out = np.zeros(size, np.float32)
    # At most BLOCKS rows of fixed size.
    for block, values in rows.repartition("block").mapInArrow(add, "block int, values binary").collect():
        out[block * per : (block + 1) * per] = np.frombuffer(values, np.float32)
    return out


def _given_out(table):
    parts = table.reshape(BLOCKS, -1)
    kept = [k for k in range(BLOCKS) if parts[k].any()]
    return pa.RecordBatch.from_arrays(
        [pa.array(kept, pa.int32()), pa.array([parts[k].astype(np.float32).tobytes() for k in kept], pa.binary())],
        names=["block", "values"],
    )


def _spread(rows):
    """As many tasks as there are cores: each gives out one table of fixed size."""
    return rows.coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism))


def word_classes(rows, classes=CLASSES):
    """Class of each bucket, by the contexts (hashed last words) its words occur in."""

    def run(batches):
        seen = np.zeros(BUCKETS * CONTEXTS)
        for _, words, starts, _ in _texts(batches, 0):
            now = _hashes(words)
            last = np.empty_like(now)
            last[1:] = now[:-1]
            last[starts] = _START
            seen += np.bincount(
                (now % np.uint32(BUCKETS)).astype(np.int64) * CONTEXTS + (last * np.uint32(0x9E3779B1) >> np.uint32(27)),
                minlength=len(seen),
            )
        yield _given_out(seen)

    seen = _summed(_spread(rows.select("text")).mapInArrow(run, "block int, values binary"), BUCKETS * CONTEXTS)
    return group_buckets(seen.reshape(BUCKETS, CONTEXTS), classes)


def group_buckets(seen, classes):
    """Buckets grouped by their context shares: k-means, weighted by occurrences, far-apart starts."""
    mass = seen.sum(axis=1)
    prior = (seen.sum(axis=0) + 1) / (seen.sum() + seen.shape[1])
    shares = np.sqrt((seen + 20 * prior) / (mass[:, None] + 20))
    centres = [shares[mass.argmax()]]
    while len(centres) < classes:
        gap = np.min([((shares - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(shares[(gap * mass).argmax()])
    centres = np.array(centres)
    for _ in range(25):
        own = (((shares**2).sum(axis=1)[:, None]) - 2 * shares @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)
        for k in range(classes):
            inside = own == k
            if mass[inside].sum() > 0:
                centres[k] = np.average(shares[inside], axis=0, weights=mass[inside])
    return own.astype(np.uint8)


def train(rows, class_of, classes=CLASSES, rounds=ROUNDS):
    """(weights by kind, row and class; bias), by one scaled gradient step for each fold of ``rows``."""
    context = rows.sparkSession.sparkContext
    weights = np.zeros((KINDS, ROWS, classes), np.float32)
    bias = np.zeros(classes, np.float32)
    size = (KINDS * ROWS + BLOCKS) * classes * 2  # the rows after the tables' hold the bias
    for fold in range(rounds):
        shared = context.broadcast((weights, bias, class_of))  # of fixed size

        def run(batches):
            weights, bias, class_of = shared.value
            # Classes seen, then classes expected, for every row; the last row is that of the bias.
            seen, expected = np.zeros((2, KINDS * ROWS + BLOCKS, classes))
            lanes = np.arange(classes)
            for _, words, starts, _ in _texts(batches, 0):
                hashes = _hashes(words)
                own = class_of[hashes % np.uint32(BUCKETS)].astype(np.int64)
                rows_of = features(hashes, starts)
                for kind, row in enumerate(rows_of):
                    part = seen[kind * ROWS : (kind + 1) * ROWS].reshape(-1)
                    part += np.bincount(row * np.int64(classes) + own, minlength=len(part))
                seen[KINDS * ROWS] += np.bincount(own, minlength=classes)
                for at in range(0, len(hashes), CHUNK):
                    p = class_scores(weights, bias, [r[at : at + CHUNK] for r in rows_of])
                    np.exp(p, out=p)
                    p /= (p @ np.ones(classes, p.dtype))[:, None]
                    flat = p.astype(np.float64).ravel()
                    expected[KINDS * ROWS] += p.sum(axis=0)
                    for kind, row in enumerate(rows_of):
                        part = expected[kind * ROWS : (kind + 1) * ROWS].reshape(-1)
                        cells = (row[at : at + CHUNK, None] * np.int64(classes) + lanes).ravel()
                        part += np.bincount(cells, flat, minlength=len(part))
            sums = np.concatenate([seen, expected], axis=1)
            yield _given_out(sums.ravel())

        of_fold = F.pmod(F.xxhash64("text"), F.lit(rounds)) == fold
        part = _spread(rows.filter(of_fold).select("text"))
        sums = _summed(part.mapInArrow(run, "block int, values binary"), size).reshape(-1, 2 * classes)
        if fold == 0:
            # The first step sets the bias to the classes' shares.
            share = sums[KINDS * ROWS, :classes] + 1
            bias = np.log(share / share.sum()).astype(np.float32)
        seen, expected = sums[: KINDS * ROWS].reshape(KINDS, ROWS, 2, classes).transpose(2, 0, 1, 3)
        # The curvature of a row and class, as if its tokens had one probability: E - E^2 / N.
        curvature = expected - expected**2 / np.maximum(expected.sum(axis=2, keepdims=True), 1)
        step = RATE * (seen - expected) / (curvature + DAMPING)
        weights = weights + step.clip(-2, 2).astype(np.float32)
        shared.unpersist()
    return weights, bias


def frequent_words(vocabulary, most):
    """{word: n} of the most frequent words, ``most`` at most.

    Words are first counted by the size of n; only those above a size that few
    enough words have are brought to the driver.
    """
    short = vocabulary.filter(F.length("word") <= FREQUENT_BYTES)
    size = F.floor(F.log2("n") * 16).cast("int")
    sizes = short.groupBy(size.alias("size")).count().collect()  # at most 16 for each power of two
    least, words = None, 0
    for at, count in sorted(map(tuple, sizes), reverse=True):
        words += count
        if words > most:
            break
        least = at
    if least is None:
        return {}
    return {bytes(w): n for w, n in short.filter(size >= least).select("word", "n").collect()}


def score_documents(documents, learn, held_out, doc_id="doc_id", text="text", classes=CLASSES, rounds=ROUNDS, frequent=FREQUENT):
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``learn`` and ``held_out`` are boolean columns of ``documents``.  ``score`` is
    the model's log10 probability of the text, end included; ``base_score`` that of
    the smoothed word shares alone.
    """
    source = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        text_or_empty(text).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    taught = source.filter("learn")
    vocabulary = stored(count_words(taught), "words")
    class_of = word_classes(taught, classes)
    weights, bias = train(taught, class_of, classes, rounds)
    by_bucket = (
        vocabulary.groupBy(F.pmod(F.crc32("word"), F.lit(BUCKETS)).alias("bucket"))
        .agg(F.sum("n"), F.count("*"))
        .collect()  # at most BUCKETS rows
    )
    tokens, kinds = np.zeros(classes), np.zeros(classes)
    for bucket, n, words in by_bucket:
        tokens[class_of[bucket]] += n
        kinds[class_of[bucket]] += words
    total, different = float(tokens.sum()), float(kinds.sum())
    # Each class has one place for words that were not seen.
    of_class = np.log10(tokens + SMOOTHING * (kinds + 1))
    of_all = math.log10(total + SMOOTHING * (different + 1))
    known = frequent_words(vocabulary, frequent)
    context = documents.sparkSession.sparkContext
    shared = context.broadcast((weights, bias, class_of, of_class, known))

    def run(batches):
        weights, bias, class_of, of_class, known = shared.value
        get = known.get
        to_ten = math.log10(math.e)
        for batch, words, starts, lengths in _texts(batches, 2):
            hashes = _hashes(words)
            own = class_of[hashes % np.uint32(BUCKETS)]
            rows_of = features(hashes, starts)
            log_class = np.empty(len(hashes))
            for at in range(0, len(hashes), CHUNK):
                part = slice(at, at + CHUNK)
                log_class[part] = log_probability(weights, bias, [r[part] for r in rows_of], own[part])
            log_class = log_class * to_ten - of_class[own]
            counts = np.fromiter([get(w, 0) for w in words], np.int64, len(words))
            seen = counts > 0
            of_known = np.where(seen, np.log10(np.maximum(counts, 1) + SMOOTHING), 0.0)
            sums = [np.add.reduceat(x, starts) if len(x) else x for x in (log_class, of_known, seen.astype(np.int64))]
            rest = np.flatnonzero(~seen)
            edges = np.searchsorted(rest, np.append(starts, len(words)))
            rest = rest.tolist()
            rare_words, rare_counts, offsets = [], [], [0]
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                own_rare = Counter([words[i] for i in rest[a:b]])
                rare_words.extend(own_rare)
                rare_counts.extend(own_rare.values())
                offsets.append(len(rare_words))
            rare = pa.StructArray.from_arrays(
                [pa.array(rare_words, pa.binary()), pa.array(rare_counts, pa.int64())], names=["word", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(lengths),
                    pa.array(sums[0], pa.float64()),
                    pa.array(sums[1], pa.float64()),
                    pa.array(sums[2], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rare),
                ],
                names=["doc_id", "held_out", "n_tokens", "of_classes", "of_known", "n_frequent", "rare"],
            )

    scanned = source.select("doc_id", "held_out", "text").mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, of_classes double, of_known double, n_frequent long, "
        "rare array<struct<word: binary, times: long>>",
    )
    scanned = stored(scanned.withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = scanned.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", "rare.times")
    looked_up = (
        rare.join(vocabulary, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))).alias("of_rare"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_rare"),
        )
    )
    words = F.col("of_known") + F.coalesce("of_rare", F.lit(0.0))
    return scanned.drop("rare").join(looked_up, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * F.lit(of_all)).alias("base_score"),
        (words + F.col("of_classes")).alias("score"),
    )
