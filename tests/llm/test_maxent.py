import math
import zlib
from collections import Counter

import numpy as np
import pytest

from zonarium.llm import maxent
from zonarium.llm.common import id_hash

SCHEMA = "doc_id long, text string, score double"


def documents():
    rng = np.random.default_rng(3)
    words = [[f"{a}{i}" for i in range(60)] for a in ("x", "y", "z")]
    rows = []
    for i in range(400):
        own = words[i % 3]
        rows.append((i, " ".join(own[min(59, int(k))] for k in rng.exponential(8, 40)), 0.0))
    return rows + [
        (1000, None, 0.0), (1001, "", 0.0), (1002, " \t\n", 0.0), (1003, "NEVER seen-" + "w" * 200, 0.0), (1004, "X1 x1\x0bx1", 0.0),
        (None, "no id", 0.0), (5, rows[5][1], 0.0), (1005, "x1 " * 5000, 0.0),
    ]


def remainder(i):
    return None if i is None else zlib.crc32(str(i).encode()) % 10


@pytest.mark.parametrize("frequent", [20, 100_000])
def test_base_counts_and_gain(make, frequent):
    rows = documents()
    docs = make(rows, SCHEMA)
    rest = id_hash("doc_id") % 10
    got = maxent.score_documents(docs, rest != 0, rest == 0, frequent=frequent).collect()
    counts = Counter()
    for i, text, _ in rows:
        if remainder(i):
            counts.update(maxent.tokens_of(text or ""))
    total, below = sum(counts.values()), math.log10(sum(counts.values()) + 0.1 * (len(counts) + 1))
    want = Counter()
    for i, text, _ in rows:
        words = maxent.tokens_of(text or "")
        base = sum(math.log10(counts[w] + 0.1) - below for w in words)
        want[(i, remainder(i) == 0, len(words), sum(counts[w] > 0 for w in words), total, round(base, 5))] += 1
    assert want == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got
    )
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_classes_sum_to_one():
    rng = np.random.default_rng(1)
    weights = rng.normal(0, 1, (maxent.KINDS, maxent.ROWS, 4)).astype(np.float32)
    rows = maxent.features(rng.integers(0, 1 << 32, 50, dtype=np.uint32), np.array([0, 20]))
    sums = sum(np.exp(maxent.log_probability(weights, np.zeros(4, np.float32), rows, np.full(50, k))) for k in range(4))
    assert np.allclose(sums, 1, atol=1e-4)


def test_nothing_to_learn_from(make):
    docs = make([(1, "a b", 0.0), (2, None, 0.0)], SCHEMA)
    rest = id_hash("doc_id") % 10
    got = maxent.score_documents(docs, rest < 0, rest == 0).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert all(abs(r.base_score) < 1e-9 for r in got)
    assert maxent.score_documents(docs.limit(0), rest != 0, rest == 0).collect() == []
