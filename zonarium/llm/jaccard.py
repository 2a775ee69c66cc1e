"""N-gram Jaccard join with MinHash LSH banding.

Every text is a set of word shingles; every tree (band) has MinHash values of its
own.  The prefix of a tree that texts must share has one fixed length for all: the
longest with which a pair at the threshold meets in some tree with the target
recall (``prefix_depth``).  It does not depend on the data: as every link counts,
no text may stop at a longer prefix because it has matches there.  Texts that
share a prefix are verified exactly, on their whole shingle sets.

A pair at exactly the threshold meets nowhere with chance (1 - 0.8^3)^20 = 6e-7;
nothing else catches it.  More similar pairs are missed more rarely (1e-11 at 0.9).

The work grows with the texts and the links, not with the pairs of a group:

* copies (equal texts) are one class from the start and verified once;
* a prefix group whose members all share a prefix in an earlier tree is dropped,
  as its pairs have been met there;
* a large prefix group is split into blocks, and pairs of blocks are dealt to
  different tasks; inside a block candidates come from a prefix filter over the
  rarest shingles, so a passage that all members share brings no candidates;
* a task gives out sums of links and a spanning forest, never the pairs.

Defined results: a null text is empty; a text without words has no shingles,
links to nothing and is a class of its own; a text of fewer words than a shingle
has one shingle; repeated rows and repeated ids are copies like others; a null
id takes part but names a class only if no member has an id; ties go to the
smaller id; an empty table gives an empty result; other columns are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from zonarium.llm.common import blocks_of, stored, text_or_empty
from zonarium.llm.shingles import shingle_set

THRESHOLD = 0.8
TREES = 20
#: Longest prefix considered.
DEPTH = 6
TARGET_RECALL = 0.999999
#: Members of a prefix group that one task compares with each other.
BLOCK = 512
#: Documents that ``keep_one`` gives in a partition of their own.
DOCUMENTS_PER_FILE = 2000
_RNG = np.random.default_rng(20240917)
_MUL = _RNG.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


def prefix_depth(threshold=THRESHOLD, trees=TREES, depth=DEPTH, target=TARGET_RECALL):
    """Longest prefix whose recall for pairs at the threshold reaches the target."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def signature(shingles, hashes):
    """MinHash values (the upper 32 bits of multiplied hashes)."""
    best = np.full(hashes, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None] * _MUL[None, :hashes]
        part ^= part >> np.uint64(31)
        part *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(best, (part >> np.uint64(32)).min(axis=0).astype(np.uint32), out=best)
    return best


def tree_prefixes(sig, trees, length):
    """Hash of the ``length`` values of each tree."""
    values = sig.reshape(trees, length).astype(np.uint64)
    out = np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
    for k in range(length):
        out = (out ^ values[:, k]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def signatures(rows, trees, length):
    """Rows (doc_id, key, text) -> (doc_id, key, prefixes; null without shingles)."""

    def run(batches):
        for batch in batches:
            found = []
            for text in batch.column(2).to_pylist():
                sets = shingle_set(text)
                found.append(tree_prefixes(signature(sets, trees * length), trees, length).tolist() if len(sets) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "key", "prefixes"],
            )

    return rows.mapInArrow(run, "doc_id long, key string, prefixes array<long>")


def similar_pairs(sets, prefixes, tree, threshold, sides=None):
    """Pairs (i, j) of sets whose Jaccard similarity reaches the threshold.

    Only pairs that share no prefix in an earlier tree; with ``sides``, only pairs
    of different sides.  Candidates come from the rarest shingles of each set.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    values, ids, counts = np.unique(flat, return_inverse=True, return_counts=True)
    # Rank shingles by how many members have them, rarest first, and sort each set so.
    rank_of = np.empty(len(values), np.int64)
    rank_of[np.argsort(counts, kind="stable")] = np.arange(len(values))
    order = np.lexsort((rank_of[ids], owner))
    tokens = ids[order]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # Two sets that reach the threshold share one of the first n - ceil(t n) + 1 shingles of each.
    heads = sizes - np.ceil(threshold * sizes - 1e-9).astype(int) + 1
    place = np.arange(len(tokens)) - starts[owner]
    in_head = place < heads[owner]
    by_token = np.argsort(tokens[in_head], kind="stable")
    posted, who = tokens[in_head][by_token], owner[in_head][by_token]
    first = np.searchsorted(posted, np.arange(len(values)))
    last = np.searchsorted(posted, np.arange(len(values)), side="right")
    everywhere_by = np.argsort(tokens, kind="stable")
    all_who = owner[everywhere_by]
    all_first = np.concatenate([[0], np.cumsum(np.bincount(tokens, minlength=len(values)))])
    left, right = [], []
    for i in range(n):
        own = tokens[starts[i] : starts[i + 1]]
        head = own[: heads[i]]
        near = [who[first[t] : last[t]] for t in head if last[t] - first[t] > 1]
        if not near:
            continue
        near = np.unique(np.concatenate(near))
        near = near[near > i]
        near = near[(sizes[near] >= threshold * sizes[i] - 1e-9) & (sizes[i] >= threshold * sizes[near] - 1e-9)]
        if sides is not None:
            near = near[sides[near] != sides[i]]
        if tree and len(near):
            near = near[~(prefixes[near][:, :tree] == prefixes[i, :tree]).any(axis=1)]
        if not len(near):
            continue
        if len(near) * 8 < n:
            both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in near])
        else:
            both = np.bincount(np.concatenate([all_who[all_first[t] : all_first[t + 1]] for t in own]), minlength=n)[near]
        # both / (a + b - both) >= threshold, in whole numbers where the threshold allows it
        good = near[both * (1 + threshold) >= threshold * (sizes[i] + sizes[near]) - 1e-9]
        left.append(np.full(len(good), i))
        right.append(good)
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(left), np.concatenate(right)


def forest(left, right):
    """Edges (member, root) that connect the same members as the pairs do."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(left.tolist(), right.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in root]


def verify(members, threshold):
    """Members of prefix groups -> per member the copies it links to and an edge to its group's root.

    ``members``: tree, prefix, one, two (blocks), block, key, copies, prefixes, text; all
    rows of a group of blocks in one task.
    """

    def group(rows):
        tree, one, two = int(rows["tree"].iloc[0]), rows["one"].iloc[0], rows["two"].iloc[0]
        prefixes = np.array(rows["prefixes"].tolist(), np.int64)
        sides = rows["block"].to_numpy() if one != two else None
        left, right = similar_pairs([shingle_set(t) for t in rows["text"]], prefixes, tree, threshold, sides)
        if not len(left):
            return None
        copies = rows["copies"].to_numpy()
        links = np.bincount(left, copies[right], len(rows)) + np.bincount(right, copies[left], len(rows))
        keys = rows["key"].to_numpy()
        edges = forest(left, right)
        at = np.array([x for x, _ in edges])
        return pd.DataFrame(
            {"key": keys[at], "root": keys[[r for _, r in edges]], "links": links[at].astype(np.int64)}
        )

    def run(batches):
        held = None
        for batch in batches:
            whole = batch if held is None else pd.concat([held, batch], ignore_index=True)
            marks = (whole["group"] != whole["group"].shift()).to_numpy().nonzero()[0].tolist()
            for a, b in zip(marks, marks[1:]):
                found = group(whole.iloc[a:b])
                if found is not None:
                    yield found
            held = whole.iloc[marks[-1] :] if marks else None
        if held is not None:
            found = group(held)
            if found is not None:
                yield found

    return (
        members.withColumn("group", F.concat_ws("-", "tree", "prefix", "one", "two"))
        .repartition("group")
        .sortWithinPartitions("group", "key")
        .mapInPandas(run, "key string, root string, links long")
    )


def components(edges, label="label"):
    """(key, label): the least key of each connected component of the edges (key, root).

    Labels spread over the edges and jump to the label of their label until
    nothing changes; every round is written to the shared folder, and so must
    ``edges`` be, as they are counted first.
    """
    both = stored(
        edges.select("key", "root").union(edges.select("root", "key")).filter("key <> root").distinct(),
        "edges",
        2 * edges.count(),
    )
    ends = both.count()
    labels = stored(both.groupBy("key").agg(F.least(F.min("root"), F.first("key")).alias(label)), "labels", ends)
    while True:
        near = labels.select(F.col("key").alias("root"), F.col(label).alias("far"))
        spread = both.join(near, "root").groupBy("key").agg(F.min("far").alias("far"))
        stepped = labels.join(spread, "key").select("key", F.least(label, "far").alias("next"), F.col(label).alias("was"))
        jump = stepped.select(F.col("key").alias("next"), F.col("next").alias("jumped"))
        after = stored(
            stepped.join(jump, "next", "left").select(
                "key", F.coalesce("jumped", "next").alias(label), (F.coalesce("jumped", "next") < F.col("was")).alias("moved")
            ),
            "labels",
            ends,
        )
        labels = after.select("key", label)
        if not after.filter("moved").take(1):
            return labels


def classes(documents, doc_id="doc_id", text="text", threshold=THRESHOLD, trees=TREES, depth=DEPTH, target=TARGET_RECALL, block=BLOCK):
    """Per different text: key, rep (least id of its copies), copies, links, label (key of its class).

    Returns (rows, texts): ``rows`` holds doc_id and key of every document.
    """
    length = prefix_depth(threshold, trees, depth, target)
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("key"), "text"
    )
    rows = stored(signatures(source, trees, length), "signatures")
    texts = stored(
        rows.groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("prefixes").alias("prefixes")
        ),
        "texts",
        rows.count(),
    )
    different = texts.count()
    met = texts.filter("prefixes IS NOT NULL").select("key", F.posexplode("prefixes").alias("tree", "prefix"))
    # Counts are written before they are joined: both sides of the join are then plain
    # exchanges, which Spark can split where one prefix is very common.
    groups = met.groupBy("tree", "prefix").agg(F.count("*").alias("n")).filter("n > 1")
    groups = stored(groups, "groups", different * trees // 2)
    met_twice = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    inside = met.join(groups, ["tree", "prefix"]).join(texts.select("key", "rep", "copies", "prefixes"), "key")
    inside = stored(inside, "members", met_twice)
    # A group is of use if for no earlier tree all its members share a prefix.
    same = [
        (F.col("tree") > k) & (F.min(F.col("prefixes")[k]) == F.max(F.col("prefixes")[k])) for k in range(trees - 1)
    ]
    known = F.lit(False)
    for condition in same:
        known = known | condition
    useful = inside.groupBy("tree", "prefix").agg(known.alias("known")).filter("NOT known")
    useful = stored(useful.select("tree", "prefix"), "groups", groups.count())
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit("block")), blocks).cast("int")
    members = (
        inside.join(useful, ["tree", "prefix"])
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("one", F.least("block", "other"))
        .withColumn("two", F.greatest("block", "other"))
        .select("tree", "prefix", "one", "two", "block", "key", "rep", "copies", "prefixes")
    )
    needed = members.select("key", "rep").distinct()
    bodies = (
        source.join(needed, (source["key"] == needed["key"]) & source["doc_id"].eqNullSafe(needed["rep"]), "left_semi")
        .dropDuplicates(["key"])
        .select("key", "text")
    )
    found = stored(verify(members.drop("rep").join(bodies, "key"), threshold), "links")
    labels = components(found)
    counted = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = texts.join(counted, "key", "left").join(labels, "key", "left")
    return rows.select("doc_id", "key", F.col("prefixes").isNotNull().alias("full")), stored(
        named.select(
            "key",
            "rep",
            "copies",
            F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("label", "key").alias("label"),
        ),
        "classes",
        different,
    )


def jaccard_join(documents, doc_id="doc_id", text="text", **options):
    """One row per document: doc_id, class_id (least id of its class), n_links, n_copies.

    ``n_links`` is the number of other documents at or above the threshold, copies
    included.  A class is what links connect.
    """
    rows, texts = classes(documents, doc_id, text, **options)
    ids = texts.groupBy("label").agg(F.min("rep").alias("class_id"))
    named = texts.join(ids, "label").select("key", "class_id", "copies", "links")
    return rows.join(named, "key").select(
        "doc_id",
        F.when(F.col("full"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("full"), F.col("links") + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("full"), F.col("copies")).otherwise(1).cast("long").alias("n_copies"),
    )


def keep_one(documents, doc_id="doc_id", text="text", **options):
    """The documents, all columns, with one of each class: the one of the least id.

    Documents without words are kept.  Of repeated rows of that id and text one is kept.
    """
    rows, texts = classes(documents, doc_id, text, **options)
    # Null ids come after all others; of texts with the same least id the smaller key counts.
    best = texts.groupBy("label").agg(
        F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("best")
    )
    stay = best.select(F.col("best.key").alias("__key"), F.col("best.rep").alias("__rep"))
    again = (
        rows.filter("full")
        .groupBy("doc_id", "key")
        .count()
        .filter("count > 1")
        .join(stay, (F.col("key") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__rep")), "left_semi")
        .select(F.col("key").alias("__again"))
    )
    marked = documents.withColumn("__own", F.md5(text_or_empty(text).cast("binary"))).withColumn(
        "__wordless", text_or_empty(text).rlike(r"\A[ \t\n\r\x0B\f]*\z")
    )
    kept = marked.join(
        stay, (F.col("__own") == F.col("__key")) & F.col(doc_id).cast("long").eqNullSafe(F.col("__rep")), "left"
    ).filter(F.col("__wordless") | F.col("__key").isNotNull())
    if again.take(1):
        kept = kept.join(again, F.col("__key") == F.col("__again"), "left")
        kept = kept.filter("__again IS NULL").unionByName(
            kept.filter("__again IS NOT NULL").dropDuplicates(["__again"])
        )
    return kept.select(*documents.columns).coalesce(blocks_of(rows.count(), DOCUMENTS_PER_FILE))
