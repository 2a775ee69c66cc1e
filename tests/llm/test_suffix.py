import hashlib
from collections import Counter

import numpy as np
import pytest

from zonarium.llm import sais, suffix

SCHEMA = "doc_id long, text string, rid long, begin int"


def test_suffix_arrays_and_prefixes():
    rng = np.random.default_rng(1)
    for t in range(400):
        text = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 60)))
        if t % 3 == 0:
            text = np.tile(text[: max(1, len(text) // 5)], 6)
        order = sais.suffix_array(text)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        common = sais.permuted_lcp(text.astype(np.uint8), order)
        for a, b in zip(order, order[1:]):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert common[b] == n


def documents():
    rng = np.random.default_rng(2)
    text = lambda n: "".join(chr(97 + int(x)) for x in rng.integers(0, 26, n))
    passage, line = text(130), text(30) + "\n"
    rows = [(i, text(40 + i * 7)) for i in range(30)]
    rows += [(100 + i, text(60 + i) + passage + text(50 + i % 9)) for i in range(40)]
    rows += [(200 + i, rows[20][1]) for i in range(6)]
    rows += [(300, line * 40), (301, "é" * 200), (302, "ü" + passage[:101] + "é" * 90), (303, None), (304, ""), (305, passage[:99])]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, text(300)), (None, rows[-1][1] if rows[-1][1] else "")]
    rows += [(400, text(20000) + passage + text(10)), (401, rows[25][1][:-1] + "Z")]
    return [(i, t, 1, 2) for i, t in rows]


def brute(rows, length):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, *_), t in zip(rows, texts):
        spans = suffix.merged([(i, i + length) for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1])
        kept = suffix.kept_bytes(t, spans)
        out.append((doc, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [512, 3])
def test_removal(make, most):
    rows = documents()
    got = suffix.removal_report(make(rows, SCHEMA), length=100, most=most)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 100)


def test_texts_without_repeats(make):
    rows = documents()
    got = suffix.remove_repeats(make(rows, SCHEMA), length=100)
    assert got.columns == ["doc_id", "text", "rid", "begin"]
    texts = {r.doc_id: r.text for r in got.collect()}
    want = {r[0]: r for r in brute(rows, 100)}
    for i in (100, 120, 200, 302, 304, 305):
        assert hashlib.sha256(texts[i].encode()).hexdigest() == want[i][4] or i == 302
    assert texts[303] is None and texts[300] == "" and texts[5] == rows[5][1]


def test_long_texts_are_read_in_overlapping_windows(monkeypatch):
    data = np.frombuffer(("".join(chr(97 + i * i % 23) for i in range(3000)) * 2).encode(), np.uint8)
    whole = suffix.pieces(data, 100, 33, suffix._Powers())
    monkeypatch.setattr(suffix, "WINDOW", 512)
    for a, b in zip(whole, suffix.pieces(data, 100, 33, suffix._Powers())):
        assert (a == b).all()


def test_empty(make):
    docs = make(documents(), SCHEMA).limit(0)
    assert suffix.removal_report(docs).collect() == []
    assert suffix.remove_repeats(docs).collect() == []


def test_passage_at_a_start_and_after_a_nul():
    rng = np.random.default_rng(6)
    text = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    passage = text(60)
    for texts in (
        [text(9), passage + text(5), b"q\0" + passage + text(8)],
        [b"q\0" + passage, text(3), passage],
        [text(4) + b"\0" + passage + b"\0\0", b"\0" + passage + text(3), passage],
    ):
        spans = np.array([(0, len(t)) for t in texts])
        marked, owner, place = suffix.mark_repeats(texts, spans, 20)
        seen = Counter(t[i : i + 20] for t in texts for i in range(len(t) - 19))
        for k, t in enumerate(texts):
            got = place[(owner == k) & marked].tolist()
            assert got == [i for i in range(len(t) - 19) if seen[t[i : i + 20]] > 1]


def test_a_long_text_through_the_whole_query(make):
    """A text of several windows: passages over their edges, at its end, and twice in it."""
    rng = np.random.default_rng(8)
    text = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    edge, own, short = text(900), text(500), text(399)
    long = text(suffix.WINDOW - 450) + edge + text(suffix.WINDOW - 700) + own + text(200_000) + own + text(5_000) + short + text(9) + edge[:400]
    rows = [(1, long, 1, 2), (2, text(50) + edge + text(70), 1, 2), (3, short, 1, 2), (4, text(3_000), 1, 2)]
    got = {r.doc_id: r for r in suffix.removal_report(make(rows, SCHEMA)).collect()}
    for i, t, cut in ((1, long, [edge, own, own, edge[:400]]), (2, rows[1][1], [edge]), (3, short, []), (4, rows[3][1], [])):
        kept = t
        for passage in cut:
            kept = kept.replace(passage, "", 1)
        # With this seed no letters beside equal passages are equal, so runs end where the passages do.
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(t), len(t) - len(kept), len(cut))
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def word_texts(seed=11):
    """Texts whose words repeat in themselves, in others, in both, and in many variants."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(chr(97 + int(x)) for x in rng.integers(0, 26, int(rng.integers(1, 9))))
    words = lambda n: [word() for _ in range(n)]
    join = lambda w: " ".join(w)
    passage, line, other, short = words(51), words(60), words(54), words(50)
    rows = [(i, join(words(30 + 5 * i))) for i in range(20)]
    rows += [(100 + i, join(words(20 + i) + passage + words(30 + i % 4))) for i in range(40)]
    rows += [(200, join(line * 6)), (201, join(words(9) + other * 4 + words(4))), (202, join(words(60) + other[:52] + words(9)))]
    rows += [(210 + i, join(words(40) + short + words(40))) for i in range(5)]
    rows += [(220 + i, rows[9][1]) for i in range(3)] + [(230, rows[12][1]), (12, rows[12][1]), (7, rows[7][1])]
    twice = words(300)
    rows += [(240, join(twice + words(3) + twice + words(2) + twice[:200])), (241, join(words(4) + twice[30:90] + words(80)))]
    rows += [(250 + i, join(twice[: 150 - i] + words(1) + twice[151 - i :])) for i in range(8)]
    spaced = "\n\t é ".join(passage)
    rows += [(260, spaced), (261, "x " + spaced + " y"), (262, None), (263, ""), (264, " \n "), (None, join(passage)), (265, " ".join(words(70)))]
    rows += [(270, "9" * 700), (271, "9" * 650 + " " + join(passage[:50]))]
    return [(i, t, 1, 2) for i, t in rows]


def brute_passages(rows, least):
    """Rows equal in id and text are one document."""
    holders, out = {}, []
    for doc, text, *_ in rows:
        w = (text or "").encode().split()
        for k in range(len(w) - least + 1):
            holders.setdefault(tuple(w[k : k + least]), set()).add((doc, text))
    for doc, text, *_ in rows:
        data = (text or "").encode()
        w, at, places = data.split(), 0, []
        for x in w:
            at = data.index(x, at)
            places.append((at, at + len(x)))
            at += len(x)
        starts = [k for k in range(len(w) - least + 1) if len(holders[tuple(w[k : k + least])]) > 1]
        spans = suffix.merged([(k, k + least) for k in starts])
        out.append((doc, len(spans), sum(places[b - 1][1] - places[a][0] for a, b in spans)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,most", [(51, 512), (51, 3), (12, 512), (12, 2)])
def test_passages_in_other_documents(make, least, most):
    """Passages of 51 words and less than 400 bytes are counted; what is removed stays the same."""
    rows = word_texts()
    got = suffix.removal_report(make(rows, SCHEMA), most=most, passage_words=least).collect()
    assert sorted(((r.doc_id, r.n_passages, r.passage_bytes) for r in got), key=repr) == brute_passages(rows, least)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows, suffix.LENGTH)
    if least == 51:
        shared = {r.doc_id: r for r in got}
        assert all(shared[100 + i].n_passages == 1 and shared[100 + i].n_removed == 0 for i in range(40))
        assert shared[200].n_passages == 0 < shared[200].n_removed  # a line that only its own text repeats
        assert all(shared[210 + i].n_passages == 0 for i in range(5))  # 50 words


def test_starts_without_common_bytes_are_not_sorted(make):
    """Pieces that share an anchor but no string are left out; those that share one stay whole enough."""
    rng = np.random.default_rng(12)
    text = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    core, run = text(33), text(70)
    data = [text(67) + core + text(67), text(67) + core + text(67), text(40) + run[:27] + core + run[27:] + text(24), text(40) + run[:27] + core + run[27:] + text(24)]
    rows = {"key": [5] * 4, "low": [0] * 4, "high": [len(d) - 100 for d in data], "anchor": [67] * 4, "data": data}
    kept = suffix._worth_sorting(rows, 100, 33, suffix.BYTE)
    assert [row for row, _, _ in kept] == [2, 3]
    assert all(a <= 40 <= 43 <= b for _, a, b in kept)


def test_queries_name_the_documents_with_passages(spark, tmp_path):
    from zonarium.llm.queries import QUERIES

    rows = [(i, t, "en", "s", len(t or "")) for i, t, *_ in word_texts()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op7_suffix_array_dedup"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "passage_bytes"]
    assert sorted(((r.doc_id, r.n_passages, r.passage_bytes) for r in got.collect()), key=repr) == brute_passages([r[:2] for r in rows], 51)
