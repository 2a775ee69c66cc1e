"""What op7 spends in Python: calls do not grow with the number of short texts, nor with a shard's bytes."""

import cProfile
import pstats

import numpy as np
import pyarrow as pa
import pytest

from zonarium.llm import sais, suffix

STRINGS = {suffix.BYTE: (100, 33), suffix.WORD: (12, 4)}


class Rows:
    """Stands for a DataFrame: gives the function that is run on its batches."""

    def mapInArrow(self, run, schema):
        return run


def calls(work):
    profile = cProfile.Profile()
    out = profile.runcall(work)
    return out, pstats.Stats(profile).total_calls


def texts_of(n, seed=3):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(chr(97 + int(x)) for x in rng.integers(0, 26, int(rng.integers(1, 9))))
    passage = " ".join(word() for _ in range(40))
    texts = [" ".join(word() for _ in range(int(rng.integers(0, 120)))) + "é" * (k % 3) + passage * (k % 4 == 1) for k in range(n)]
    return [*texts, "", " ", "", passage, passage[:100], passage[:99], ""]


def pieces_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["rid", "text"])
    return list(suffix._all_pieces(Rows(), STRINGS)(iter([batch])))


def pieces_alone(texts):
    powers, out = suffix._Powers(), []
    for rid, text in enumerate(texts):
        data = np.frombuffer(text.encode(), np.uint8)
        first, last = suffix.word_places(data)
        words = suffix._between(suffix._prefix_hashes(data, 0, powers), 0, first, last, powers)
        for width, symbols in ((suffix.BYTE, data), (suffix.WORD, words)):
            for low, high, at, key, whole in zip(*suffix.pieces(symbols, *STRINGS[width], powers)):
                out.append((rid, width, low, high, at, int(key.view(np.int64)), int(whole.view(np.int64))))
    return sorted(out)


@pytest.mark.parametrize("chunk", [1, 300, 5000, 1 << 17])
def test_texts_taken_together_have_the_pieces_of_each(monkeypatch, chunk):
    texts = texts_of(60)
    monkeypatch.setattr(suffix, "CHUNK", chunk, raising=False)
    found = [tuple(r.values()) for b in pieces_of(texts) for r in b.to_pylist()]
    assert sorted(found) == pieces_alone(texts)
    assert pieces_of(["", " ", "a"]) == []


def test_short_texts_are_taken_together():
    texts = texts_of(1000)
    found, n = calls(lambda: pieces_of(texts))
    assert found[0].num_rows > 1000
    assert n < 15 * len(texts)


def shard(seed=4):
    """Pieces of which half hold a passage that another one holds too."""
    rng = np.random.default_rng(seed)
    text = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    shared = [text(300) for _ in range(60)]
    return [text(int(rng.integers(0, 60))) + shared[k // 4] + text(40) if k % 2 else text(350) for k in range(240)]


def test_a_shard_is_sorted_in_few_steps():
    texts = shard()
    spans = np.array([(0, len(t)) for t in texts])
    (marked, owner, place), n = calls(lambda: suffix.mark_repeats(texts, spans, 200))
    seen = {}
    for t in texts:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    for k, t in enumerate(texts):
        want = [i for i in range(len(t) - 199) if seen[t[i : i + 200]] > 1]
        assert place[(owner == k) & marked].tolist() == want
    assert n < 3000


def test_ranks_are_places_in_the_suffix_array():
    rng = np.random.default_rng(5)
    for t in range(300):
        kind = (np.uint8, np.uint64)[t % 2]
        symbols = rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(1, 90))).astype(kind)
        if t % 3 == 0:
            symbols = np.tile(symbols[: max(1, len(symbols) // 5)], 6)
        length = int(rng.integers(1, len(symbols) + 1))
        starts = np.flatnonzero(rng.random(len(symbols) - length + 1) < 0.7)
        strings = [symbols[i : i + length].tolist() for i in starts]
        order = {tuple(s): k for k, s in enumerate(sorted(set(map(tuple, strings))))}
        ranks = sais.ranks_to(symbols, starts, length)
        assert ranks.tolist() == [order[tuple(s)] for s in strings]
        whole = [p for p in sais.suffix_array(symbols).tolist() if p in set(starts.tolist())]
        assert ranks[np.searchsorted(starts, whole)].tolist() == sorted(ranks.tolist())


def test_ranges_without_an_equal_one_are_not_sorted():
    """Pieces of one anchor that share strings at some starts only; of another anchor with the same bytes; and none."""
    rng = np.random.default_rng(6)
    text = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    core, shared = text(33), text(60)
    data = [text(67 - 20) + shared[:20] + core + shared[20:] + text(27 + 20) for _ in range(2)]
    longer = text(80)
    data += [text(7) + longer[:60] + core + longer[60:] + text(47) for _ in range(2)]
    rows = {"key": [5, 5, 6, 7], "low": [0] * 4, "high": [len(d) - 100 for d in data], "anchor": [67] * 4, "data": data}
    assert suffix._worth_sorting(rows, 100, 33, suffix.BYTE) == []
    rows["key"] = [5, 5, 6, 6]
    kept = suffix._worth_sorting(rows, 100, 33, suffix.BYTE)
    assert [row for row, _, _ in kept] == [2, 3]
    assert all(a <= 7 and 20 <= b <= 23 for _, a, b in kept)
    assert suffix._worth_sorting({k: v[:0] for k, v in rows.items()}, 100, 33, suffix.BYTE) == []
