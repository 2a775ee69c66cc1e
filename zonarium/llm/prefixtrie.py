"""Prefix trie of conversations, with totals of subtrees rolled up by bands of depth.

A node is a distinct sequence of first turns (role and text) of a conversation.  It is
known by a hash of its sequence in four prime fields: the sum of turn k's digest times
the base to the k-th power.  Such sums can be cut and joined, so that one conversation
may lie in many tasks, and a rebuilt one needs no second sort:

1. Turns are sorted by ranges of (conversation, turn); every task sums up its own part
   of a conversation, and the sums of the parts before it are added after.
2. The head of a rebuilt conversation, at most five turns, comes with one row of its
   group's first conversation; its tail is what the own sum has gained since.

Totals of subtrees: depths are cut into bands of ``BAND``.  In one round every node
adds its values to its ancestors in its band, so that a row becomes ``BAND`` rows at
most.  The roots of bands then are the nodes of a trie of their own, of depth divided
by ``BAND``, and are treated alike; from the top down, the complete totals of band
roots are added to their ancestors in the band above.  Rounds grow with the logarithm
of the depth.

Defined results: a null role or text is empty; a null turn comes first; equal turns are
ordered by the MD5 of role and text; repeated rows are turns of their own; rows without
a conversation id take no part; a conversation without turns belongs to the root; no
conversations give no nodes, not even the root; other columns are ignored.
"""

import hashlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from zonarium.llm.common import stored

#: Depths in a band, so ancestors that a node adds to in one round.
BAND = 16
#: Conversations whose first turns are shared, and turns that are shared at most.
GROUP = 100
HEAD = 5
#: Ids of members that are joined into one text at a time.
IDS = 8192
# The largest primes below 2^31: products of two rests fit a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1812433253, 1664525, 69069)
FIELDS = range(len(PRIMES))
NOTHING = hashlib.sha256(b"").hexdigest()


def _s(name):
    return [f"{name}{k}" for k in FIELDS]


def _mod(value, k):
    return F.pmod(value, F.lit(PRIMES[k]))


class _Powers:
    """Powers of the bases, from two tables each."""

    def __init__(self):
        self.low, self.high = [], []
        for base, prime in zip(BASES, PRIMES):
            for store, x in ((self.low, base), (self.high, pow(base, 1 << 16, prime))):
                table = [1]
                for _ in range((1 << 16) - 1):
                    table.append(table[-1] * x % prime)
                store.append(np.array(table, np.int64))

    def __call__(self, k, at):
        return self.low[k][at & 0xFFFF] * self.high[k][at >> 16] % PRIMES[k]


def _summed(batches):
    """Sorted rows (conv_id, chars, t0 to t3) -> place and sums within the task's part of the conversation."""
    powers = _Powers()
    part = TaskContext.get().partitionId()
    last, place, sums = None, 0, [0] * len(PRIMES)
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[True], conv[1:] != conv[:-1]])
        starts[0] = last is None or conv[0] != last
        at = np.arange(len(conv))
        first = np.maximum.accumulate(np.where(starts, at, -1))
        # The rows before the first start go on from the last batch.
        places = np.where(first < 0, place + at + 1, at - first + 1)
        columns = [batch.column(0), pa.array(np.full(len(conv), part, np.int32)), pa.array(places), batch.column(1)]
        upto, before = [], []
        for k in FIELDS:
            term = batch.column(2 + k).to_numpy(zero_copy_only=False) * powers(k, places) % PRIMES[k]
            total = np.concatenate([[0], np.cumsum(term)])
            carried = np.where(first < 0, sums[k], 0)
            now = (total[1:] - total[np.maximum(first, 0)] + carried) % PRIMES[k]
            upto.append(now)
            before.append((now - term) % PRIMES[k])
            sums[k] = int(now[-1])
        last, place = conv[-1], int(places[-1])
        names = ["conv_id", "part", "place", "chars", *_s("s"), *_s("b")]
        yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, upto), *map(pa.array, before)], names=names)


def _placed(turns):
    """Every turn with its place in its conversation and the sums up to it and before it."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("salt")]
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    rows = turns.withColumn("digest", digest).select(
        "conv_id",
        "turn",
        "digest",
        # Equal rows may be split at any place.
        F.monotonically_increasing_id().alias("salt"),
        F.length("text").cast("long").alias("chars"),
    )
    fields = [
        _mod(F.conv(F.substring("digest", 1 + 8 * k, 8), 16, 10).cast("long"), k).alias(f"t{k}") for k in FIELDS
    ]
    types = "conv_id long, part int, place long, chars long, " + ", ".join(f"{n} long" for n in _s("s") + _s("b"))
    local = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "chars", *fields).mapInArrow(_summed, types),
        "parts",
    )
    end = F.struct("conv_id", "place", *_s("s"))
    edges = local.groupBy("part").agg(
        F.max_by(end, F.struct(-F.col("conv_id"), "place")).alias("first"), F.max_by(end, F.struct("conv_id", "place")).alias("last")
    )
    offsets, held = [], None
    for row in sorted(edges.collect(), key=lambda r: r.part):  # one row per task
        state = (0, [0] * len(PRIMES))
        if held is not None and held[0] == row.first.conv_id:
            state = held[1]
            steps = [pow(b, state[0], p) for b, p in zip(BASES, PRIMES)]
            offsets.append((row.part, row.first.conv_id, state[0], *steps, *state[1]))
        if row.first.conv_id != row.last.conv_id:
            state = (0, [0] * len(PRIMES))
        sums = [
            (state[1][k] + pow(BASES[k], state[0], PRIMES[k]) * row.last[f"s{k}"]) % PRIMES[k] for k in FIELDS
        ]
        held = (row.last.conv_id, (state[0] + row.last.place, sums))
    names = ["part", "conv_id", "before_n", *_s("m"), *_s("o")]
    earlier = turns.sparkSession.createDataFrame(offsets, "part int, conv_id long, before_n long, " + ", ".join(f"{n} long" for n in names[3:]))
    joined = local.join(F.broadcast(earlier), ["part", "conv_id"], "left")  # at most a row per task
    shifted = lambda n, k: _mod(
        F.col(f"{n}{k}") * F.coalesce(f"m{k}", F.lit(1)) + F.coalesce(f"o{k}", F.lit(0)), k
    ).alias(f"{n}{k}")
    return joined.select(
        "conv_id",
        (F.col("place") + F.coalesce("before_n", F.lit(0))).alias("place"),
        "chars",
        *(shifted(n, k) for n in "sb" for k in FIELDS),
    )


def _node(columns, name):
    """Four rests packed in two numbers."""
    a, b = (columns[2 * k] * F.lit(1 << 31) + columns[2 * k + 1] for k in range(2))
    return F.struct(a.alias("a"), b.alias("b")).alias(name)


def rebuilt_turns(turns, conv="conv_id", turn="turn", role="role", text="text", group=GROUP, head=HEAD):
    """Columns conv_id, depth, node, parent, chars, ends: a row for each turn of each rebuilt
    conversation, and one of depth 0 for each conversation.

    A conversation c starts with the first h turns of c - c % group, where h is
    crc32(c) % (head + 1), and goes on with its own turns after its first h.
    """
    source = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    placed = stored(_placed(source), "placed")
    heads = stored(
        placed.groupBy("conv_id").agg(
            F.max("place").alias("n"),
            # The first ``head`` turns only.
            F.sort_array(F.collect_list(F.when(F.col("place") <= head, F.struct("place", *_s("s"), *_s("b"), "chars")))).alias("turns"),
        ),
        "heads",
    )
    first = heads.select(F.col("conv_id").alias("base"), F.col("turns").alias("shared"))
    own = heads.select(
        "conv_id",
        "n",
        "turns",
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(head + 1)).cast("int").alias("h"),
    )
    # No turns are shared where there is no such conversation.
    cut = F.slice(F.coalesce("shared", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    records = own.join(first, "base", "left").withColumn("shared", cut).withColumn("g", F.size("shared"))
    at = lambda turns, place, k: F.coalesce(F.get(turns, place - 1)[f"s{k}"], F.lit(0))
    records = stored(
        records.select(
            "conv_id",
            "h",
            "g",
            "shared",
            (F.col("g") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depths"),
            *(F.when(F.col("h") > 0, at("turns", F.col("h"), k)).otherwise(0).alias(f"own{k}") for k in FIELDS),
            *(F.when(F.col("g") > 0, at("shared", F.col("g"), k)).otherwise(0).alias(f"head{k}") for k in FIELDS),
        ),
        "records",
    )
    zero = [F.lit(0).cast("long")] * len(PRIMES)
    long = lambda c: c.cast("long")
    roots = records.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), _node(zero, "node"), F.lit(None).cast("struct<a:bigint,b:bigint>").alias("parent"),
        F.lit(0).cast("long").alias("chars"), (F.col("depths") == 0).alias("ends"),
    )
    shared = records.select("conv_id", "depths", F.explode("shared").alias("t")).select(
        "conv_id", long(F.col("t.place")).alias("depth"), _node([F.col(f"t.s{k}") for k in FIELDS], "node"),
        _node([F.col(f"t.b{k}") for k in FIELDS], "parent"), "t.chars", (F.col("t.place") == F.col("depths")).alias("ends"),
    )
    # What the own sum has gained after h turns, moved to begin after g.
    back = [F.array(*(F.lit(pow(pow(b, -1, p), j, p)) for j in range(head + 1))) for b, p in zip(BASES, PRIMES)]

    def moved(n):
        return [
            _mod(F.col(f"head{k}") + _mod(F.col(f"{n}{k}") - F.col(f"own{k}"), k) * F.get(back[k], F.col("h") - F.col("g")), k)
            for k in FIELDS
        ]

    depth = F.col("place") - F.col("h") + F.col("g")
    tails = (
        placed.join(records.drop("shared"), "conv_id")
        .filter("place > h")
        .select("conv_id", long(depth).alias("depth"), _node(moved("s"), "node"), _node(moved("b"), "parent"), "chars", (depth == F.col("depths")).alias("ends"))
    )
    return stored(roots.unionByName(shared).unionByName(tails), "rebuilt")


def _chains(rows, unit, band):
    """(node, exit, above): ancestors, at depths that ``unit`` divides, in a node's band;
    with ``exit``, a band root's ancestors in the band above."""
    at = rows.filter(F.col("depth") % unit == 0).withColumn("step", (F.col("depth") / unit).cast("long"))
    own = F.struct(F.floor(F.col("step") / band).cast("long").alias("band"), (F.col("step") % band).alias("index"))
    leaves = F.struct((F.floor(F.col("step") / band) - 1).cast("long").alias("band"), F.lit(band).cast("long").alias("index"))
    is_root = (F.col("step") % band == 0) & (F.col("step") > 0)
    dealt = at.select("conv_id", "depth", "node", F.explode(F.array_compact(F.array(own, F.when(is_root, leaves)))).alias("to"))
    # At most band + 1 nodes in a group.
    chains = dealt.groupBy("conv_id", "to.band").agg(F.sort_array(F.collect_list(F.struct("to.index", "depth", "node"))).alias("chain"))
    each = chains.select("chain", F.explode("chain").alias("x")).select(
        F.col("x.node").alias("node"),
        (F.col("x.index") == band).alias("exit"),
        F.transform(F.filter("chain", lambda y: y["index"] < F.col("x.index")), lambda y: F.struct(y["depth"], y["node"])).alias("above"),
    )
    # All members have the same ancestors.
    return stored(each.groupBy("node", "exit").agg(F.first("above").alias("above")), "chains")


def subtree_totals(rows, nodes, values, band=BAND):
    """(node and the sums of ``values`` over its subtree, itself included)."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    units = [1]
    while units[-1] * band <= deepest:
        units.append(units[-1] * band)
    chains = [_chains(rows, unit, band) for unit in units]

    def summed(frames):
        out = frames[0]
        for more in frames[1:]:
            out = out.unionByName(more)
        return stored(out.groupBy("depth", "node").agg(*(F.sum(v).alias(v) for v in values)), "totals")

    def added_to(frame, chain):
        """The values of the frame's nodes, for each of the ancestors that the chain lists."""
        return frame.select("node", *values).join(chain, "node").select(F.inline("above"), *values)

    inside, now = [], nodes.select("depth", "node", *values)
    for unit, chain in zip(units, chains):
        now = now.filter(F.col("depth") % unit == 0)
        own = chain.filter("NOT exit").select("node", "above")
        inside.append(summed([now, added_to(now, own)]))
        now = inside[-1]
    whole = inside[-1]
    for (low, high), chain, part in reversed(list(zip(pairwise(units), chains, inside))):
        roots = whole.filter((F.col("depth") % high == 0) & (F.col("depth") > 0))
        whole = summed([part, added_to(roots, chain.filter("exit").select("node", "above"))])
    return whole


def _ids_hashed(rows):
    """(node, ends_sha256) of the ids of the conversations that end at a node, ascending."""
    block = F.floor(F.col("conv_id") / IDS).cast("long").alias("block")
    # At most IDS ids in a group; the texts of a node are hashed one after another.
    texts = rows.filter("ends").groupBy("node", block).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids")
    )

    def run(batches):
        now, digest = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (a, b), hashlib.sha256(ids.encode())
            yield _digests(out)
        yield _digests([(*now, digest.hexdigest())] if now else [])

    found = (
        texts.select("node.a", "node.b", "block", "ids")
        .repartition("a", "b")
        .sortWithinPartitions("a", "b", "block")
        .select("a", "b", "ids")
        .mapInArrow(run, "a long, b long, ends_sha256 string")
    )
    return found.select(F.struct("a", "b").alias("node"), "ends_sha256")


def _digests(rows):
    a, b, digest = list(zip(*rows)) or ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest, pa.string())], names=["a", "b", "ends_sha256"])


def conversation_trie(turns, conv="conv_id", turn="turn", role="role", text="text", group=GROUP, head=HEAD, band=BAND):
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``saved_tokens`` sums (n_convs - 1) times the code points of the last text over the
    subtree: what need not be computed again where members share their first turns.
    """
    rows = rebuilt_turns(turns, conv, turn, role, text, group, head)
    found = stored(
        rows.groupBy("depth", "node").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"), F.first("parent").alias("parent")
        ),
        "nodes",
    )
    children = stored(found.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children")), "children")
    nodes = stored(
        found.join(children, "node", "left").select(
            "node", "depth", "conv_id", "n_convs", "parent",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        "nodes",
    )
    totals = subtree_totals(rows, nodes, ["n_leaves", "saved_tokens"], band)
    ends = stored(_ids_hashed(rows), "ends")
    above = found.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = stored(nodes.select("node", "depth", "conv_id", "n_convs", "parent", "n_children").join(above, "parent", "left"), "named")
    return (
        named.join(totals.drop("depth"), "node")
        .join(ends, "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )


ORACLE = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
lengths AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
-- CRC-32 of the decimal id, bit by bit: a byte is taken in, then eight shifts (-1).
convs AS (
    SELECT conv_id, n, conv_id - conv_id % 100 AS base,
           xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                   lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END),
               4294967295) % 6 AS h
    FROM lengths),
rebuilt AS (
    SELECT c.conv_id, t.place AS depth, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, t.place - c.h + least(c.h, coalesce(b.n, 0)), t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h LEFT JOIN lengths b ON b.conv_id = c.base),
paths AS (
    SELECT conv_id, depth, length(text) AS chars,
           list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS path
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, [] FROM convs),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved
    FROM paths GROUP BY path, depth),
members AS (SELECT p.conv_id AS member, n.* FROM paths p JOIN nodes n ON n.depth = p.depth AND n.path = p.path),
-- A node's ancestors are the nodes of its least member at smaller depths.
parents AS (
    SELECT x.conv_id, x.depth, m.conv_id AS parent_conv_id
    FROM nodes x JOIN members m ON m.member = x.conv_id AND m.depth = x.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents GROUP BY ALL),
below AS (
    SELECT m.conv_id, m.depth, sum(x.saved) AS saved_tokens, sum(CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves
    FROM nodes x JOIN members m ON m.member = x.conv_id AND m.depth <= x.depth
         LEFT JOIN children c ON c.conv_id = x.conv_id AND c.depth = x.depth
    GROUP BY m.conv_id, m.depth),
last AS (SELECT conv_id AS member, max(depth) AS depth FROM paths GROUP BY conv_id),
ends AS (
    SELECT m.conv_id, m.depth, string_agg(m.member::VARCHAR, ',' ORDER BY m.member) AS ids
    FROM members m JOIN last USING (member, depth) GROUP BY m.conv_id, m.depth)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN below b USING (conv_id, depth) LEFT JOIN parents p USING (conv_id, depth)
     LEFT JOIN children c USING (conv_id, depth) LEFT JOIN ends e USING (conv_id, depth)
"""
