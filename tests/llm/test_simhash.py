import random
import re

import numpy as np
import pytest
import xxhash

from zonarium.llm import simhash
from zonarium.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, rep long, label string"


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    runs = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, distance=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(ids))]


def documents():
    rng = random.Random(5)
    rows = []
    for _ in range(25):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.choice([3, 30, 400]))]
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(99)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "One two three ÉTÉ"), (904, "one two three ÉtÉ")]
    rows += [(None, rows[3][1]), (None, "no one else"), (7, rows[7][1]), (7, "x y"), (905, "Long word " * 30000)]
    return [(i, t, "f", 1, "l") for i, t in rows]


def expected(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    parts = plain_components([r[0] for r in rows], prints)
    return sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, parts)), key=repr)


@pytest.mark.parametrize("parts, group", [(None, 2048), (3, 4), (4, 2048)])
def test_documents(make, parts, group):
    rows = documents()
    got = simhash.near_duplicates(make(rows, SCHEMA), parts=parts, group=group)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def crowded():
    """Fingerprints of which a third share half their bits, clusters, and chains of four bits a step."""
    rng = np.random.default_rng(3)
    some = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    some[:100] = some[:100] & np.uint64(0xFFFFFFFF) | np.uint64(0xABCDEF << 32)
    out = [int(x) for x in some]
    for x in out[:40]:
        for _ in range(6):
            y = x
            for bit in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                y ^= 1 << bit
            out.append(y)
    at = 0
    for k in range(12):
        at ^= 0b1111 << (4 * k)
        out.append(at)
    return sorted(set(out))


@pytest.mark.parametrize("parts, distance", [(None, 4), (2, 4), (3, 4), (4, 4), (5, 4), (3, 2)])
def test_no_link_is_lost(make, parts, distance):
    prints = crowded()
    unique = make([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    found = simhash.near_links(unique, distance, 64, parts).collect()
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        a, b = a % (1 << 64), b % (1 << 64)
        root[find(a)] = find(b)
    got = {}
    for p in prints:
        got.setdefault(find(p), set()).add(p)
    want = {}
    for p, c in zip(prints, plain_components(prints, prints, distance)):
        want.setdefault(c, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_thresholds_add_up_and_cost_least():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    prints[:300] &= ~np.uint64(0xFFFF)
    bits = simhash.bits_of(prints)
    places = [list(range(16 * k, 16 * k + 16)) for k in range(4)]
    counts = [[np.bincount(simhash.values_of(bits, b).astype(int), minlength=1 << len(b)) for b in simhash.blocks_of_part(p)] for p in places]
    plan = simhash.Allocation(places, counts, 10**9)
    limits = plan.thresholds(bits)
    assert ((limits + 1).sum(axis=1) == 5).all() and (limits >= -1).all()
    costs = plan.costs(bits)
    from itertools import product

    options = [c for c in product(range(6), repeat=4) if sum(c) == 5]
    for row in range(0, 500, 50):
        best = min(sum(costs[row, p, c[p]] for p in range(4)) for c in options)
        assert np.isclose(best, sum(costs[row, p, limits[row, p] + 1] for p in range(4)))
    # What many share is not looked at.
    assert (limits[:300, 0] == -1).all()


def test_estimates_are_exact_in_one_block():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 8, 400)
    near = simhash.at_distances(np.bincount(values, minlength=256), 8, 4)
    for v in (0, 17, 255):
        apart = np.bitwise_count(values ^ v)
        assert np.allclose(near[v], [(apart == e).mean() for e in range(5)])


def test_correlated_bits_share_a_part(make):
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 2, (400, 64)).astype(np.uint8)
    bits[:, 40] = bits[:, 50] = bits[:, 60] = bits[:, 3]
    prints = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().view(np.int64)
    both = simhash.correlations(make([(int(p),) for p in prints], "fp long"))
    parts = simhash.grouped_bits(both, len(prints), 5)
    assert {3, 40, 50, 60} <= set(parts[0])
    assert sorted(b for p in parts for b in p) == list(range(64))


def test_more_fingerprints_make_fewer_parts():
    numbers = [simhash.number_of_parts(n) for n in (10, 10**5, 10**8, 10**10, 10**11)]
    assert numbers == sorted(numbers, reverse=True) and numbers[0] == 5 and numbers[-1] < 4


def test_empty_and_single(make, spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    got = simhash.near_duplicates(make([(3, "a b c d e", "", 0, "")], SCHEMA)).collect()
    assert [(r.doc_id, r.component_id) for r in got] == [(3, 3)]
    both = simhash.near_duplicates(make([(4, None, "", 0, ""), (2, "", "", 0, "")], SCHEMA)).collect()
    assert {tuple(r) for r in both} == {(4, "0" * 16, 2), (2, "0" * 16, 2)}


def test_components(make):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 100), (200, 201), (201, 200), (None, 5)]
    got = connected_components(make(edges, "a long, b long")).collect()
    want = {k: 0 for k in range(61)} | {200: 200, 201: 200}
    assert dict(map(tuple, got)) == want
