import numpy as np

from zonarium.llm import jaccard
from zonarium.llm.shingles import shingle_set

SCHEMA = "doc_id long, text string, key string, rep long, _key string"


def documents():
    rng = np.random.default_rng(9)
    rows = []
    for g in range(12):
        base = [f"w{int(x)}" for x in rng.integers(0, 500, 120)]
        for c in range(1 + g):
            words = list(base)
            for at in rng.integers(0, len(words), c % 4):
                words[at] = f"edit{g}{c}"
            rows.append((len(rows), " ".join(words)))
    shared = " ".join(f"s{k}" for k in range(40))
    rows += [(500 + i, shared + " " + " ".join(f"own{i}_{k}" for k in range(40))) for i in range(60)]
    rows += [(700, None), (701, ""), (702, " \n"), (703, "one two"), (704, "One  two"), (705, "a b c d e"), (None, rows[30][1])]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (706, "x " * 20000), (707, "x " * 20001)]
    return [(i, t, "k", 1, "c") for i, t in rows]


def brute(rows, threshold=0.8):
    sets = [frozenset(shingle_set(t).tolist()) for _, t, *_ in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        r = find(i)
        least[r] = min(x for x in (least.get(r), doc) if x is not None) if (least.get(r), doc) != (None, None) else None
    return sorted(((d, least[find(i)] if sets[i] else d, links[i]) for i, (d, *_) in enumerate(rows)), key=repr)


def test_links_and_classes(make):
    rows = documents()
    for block in (1024, 4):
        got = jaccard.jaccard_join(make(rows, SCHEMA), block=block).collect()
        assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == brute(rows)


def test_keep_one(make):
    rows = documents()
    classes = {c for _, c, _ in brute(rows)}
    got = jaccard.keep_one(make(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "key", "rep", "_key"]
    kept = [r.doc_id for r in got.collect()]
    assert sorted(kept) == sorted(classes)


def test_target_recall_sets_the_depth():
    assert jaccard.prefix_depth(0.8, 12, 6, 0.9995) == 3
    assert jaccard.prefix_depth(0.8, 12, 6, 0.5) > jaccard.prefix_depth(0.8, 12, 6, 0.9999)


def test_pairs_at_the_threshold_meet():
    length = jaccard.prefix_depth()
    assert (1 - jaccard.THRESHOLD**length) ** jaccard.TREES < 1e-6
    rng = np.random.default_rng(4)
    missed = 0
    for _ in range(30_000):
        # 8 of 10 shingles are shared.
        values = rng.integers(0, 1 << 63, 10, dtype=np.uint64)
        one, two = (
            jaccard.tree_prefixes(jaccard.signature(part, jaccard.TREES * length), jaccard.TREES, length)
            for part in (values[:9], values[1:])
        )
        missed += not (one == two).any()
    assert missed == 0


def test_empty(make):
    docs = make(documents(), SCHEMA).limit(0)
    assert jaccard.jaccard_join(docs).collect() == []
    assert jaccard.keep_one(docs).collect() == []
