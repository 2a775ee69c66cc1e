"""Audit of how a chain of document filters interacts.

Every document gets a mask of the filters it fails.  The masks are counted per part,
and from these counts, 32 a part, come the figures of every order of the filters:
what is kept, removed, removed twice over, and lost of good and of toxic documents.

Filters (a document fails):

* A: under ``MIN_WORDS`` words;
* B: distinct words below ``MIN_DISTINCT`` percent of the words;
* C: capitals A-Z above ``MAX_CAPITALS`` percent of the code points;
* D: holds one of ``MARKS``;
* E: a document of a smaller id has the same text (``tries``).

Words are what stands between ASCII white space, in the case they have.

Defined results: a null text is empty; a null part is the empty string; a row without
an id passes E and makes none fail; rows of one id and text are not copies of each
other, other rows of one text and different ids are; repeated rows count as often as
they stand; several labels of an id count once, if any says so; a part is listed with
all orders and steps; an empty table gives an empty result; other columns are ignored.
"""

import re
from itertools import permutations

from pyspark.sql import functions as F

from zonarium.llm.common import stored, text_or_empty
from zonarium.llm.tries import mark_copies

MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_CAPITALS = 3
MARKS = b"#$%&*|"
FILTERS = "ABCDE"
_BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
_NOT_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Texts above this many bytes are read word by word instead of being split at once.
LONG = 1 << 22


def word_counts(text):
    """Number of words, and of different ones, of a text in UTF-8 bytes."""
    if len(text) <= LONG:
        words = text.split()
        return len(words), len(set(words))
    n, different = 0, set()
    for word in _WORD.finditer(text):
        n += 1
        different.add(word[0])
    return n, len(different)


def failures(text, points):
    """Mask of the filters A to D that a text of so many code points fails."""
    words, different = word_counts(text)
    return (
        _BIT["A"] * (words < MIN_WORDS)
        + _BIT["B"] * (100 * different < MIN_DISTINCT * words)
        + _BIT["C"] * (100 * len(text.translate(None, _NOT_CAPITALS)) > MAX_CAPITALS * points)
        + _BIT["D"] * (len(text.translate(None, MARKS)) != len(text))
    )


def failure_masks(documents, doc_id="doc_id", text="text", part="lang", **options):
    """Columns doc_id, part, mask, n: how many documents of an id fail which filters."""
    source = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_or_empty(text).alias("text")
    )
    return mark_copies(source, failures, _BIT["E"], **options)


def mask_counts(masks, labels):
    """Columns part, mask, n, good, toxic; ``labels``: doc_id, quality, toxic."""
    # Written first, so that both sides of the join are plain exchanges: Spark can split a common id.
    known = stored(
        labels.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("of"))
        .agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
            F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
        ),
        "labels",
    )
    joined = masks.join(known, F.col("doc_id") == F.col("of"), "left")
    share = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c)
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), share("good"), share("toxic"))


def interactions(counts):
    """Figures of every part, order of the filters and step, from ``mask_counts``."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 a part
    steps = [
        (order, k + 1, _BIT[order[k]], sum(_BIT[f] for f in order[:k]))
        for order in map("".join, permutations(FILTERS))
        for k in range(len(order))
    ]
    table = F.from_csv  # the 600 steps are sent as one text and not as 600 expressions
    listed = F.split(F.lit(" ".join(f"{o},{k},{own},{before}" for o, k, own, before in steps)), " ")
    rows = parts.select("part", "masks", F.explode(listed).alias("step")).select(
        "part", "masks", table("step", "o string, k int, own int, before int").alias("s")
    )

    def total(value, condition):
        zero = F.lit(0).cast("long")
        return F.aggregate(F.filter("masks", condition), zero, lambda acc, m: acc + value(m))

    def fails(m):
        return m["mask"].bitwiseAND(F.col("s.own")) != 0

    def was(m):
        return m["mask"].bitwiseAND(F.col("s.before")) != 0

    number = lambda m: m["n"]
    # A document is removed by one of its k failing filters in 120 / k of the orders.
    orders = len(steps) // len(FILTERS)
    return rows.select(
        "part",
        F.col("s.o").alias("filter_order"),
        F.col("s.k").alias("step"),
        total(number, lambda m: ~fails(m) & ~was(m)).alias("kept"),
        total(number, lambda m: fails(m) & ~was(m)).alias("removed"),
        total(number, lambda m: fails(m) & was(m)).alias("redundant"),
        total(number, lambda m: m["mask"] == F.col("s.own")).alias("unique_fails"),
        total(lambda m: m["good"], lambda m: fails(m) & ~was(m)).alias("good_lost"),
        total(lambda m: m["toxic"], lambda m: fails(m) & ~was(m)).alias("toxic_lost"),
        total(lambda m: (m["n"] * F.lit(orders) / F.bit_count(m["mask"])).cast("long"), fails).alias("shapley"),
    )


def filter_audit(documents, labels, **options):
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``shapley`` is what the step's filter removes, summed over all orders.
    """
    return interactions(stored(mask_counts(failure_masks(documents, **options), labels), "masks"))


ORACLE = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
flags AS (
    SELECT doc_id, part,
           (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
           + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
           + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END)
           + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
           + (CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END) AS mask
    FROM docs),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
masks AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM flags LEFT JOIN known USING (doc_id) GROUP BY part, mask),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS own,
           coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
    FROM orders, range(1, 6) r(step)),
found AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM masks, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM found
"""
