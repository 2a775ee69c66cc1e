import random
import re
from bisect import bisect_right
from itertools import permutations

import pytest

import check_oracle
from zonarium.llm import audit, tries

SCHEMA = "doc_id long, text string, lang string, part string, mask int, n long"
LABELS = "doc_id long, quality int, toxic int"


def documents():
    rng = random.Random(11)
    header = "All rights reserved by the writers of this text. " * 30
    rows = []
    for k in range(120):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([0, 3, 199, 200, 201, 260]))]
        if k % 3 == 0:
            words = [w.upper() for w in words]
        if k % 5 == 0:
            words = words[: len(words) // 9 + 1] * 9
        text = (header if k % 2 else "") + rng.choice([" ", "\n", "\v"]).join(words) + rng.choice(["", "", "$", "é|", "  "])
        for _ in range(rng.choice([1, 1, 1, 2, 7])):
            rows.append((rng.randrange(5000), text, rng.choice(["en", "de", None])))
    rows += [(7000, None, None), (7001, "", "en"), (6999, "", ""), (None, "", "en"), (None, rows[0][1], "de"), (None, None, None)]
    rows += [(7002, "same", "en"), (7002, "same", "en"), (7002, "same", "de"), (7002, "other", "en"), (7003, "same", "en")]
    rows += [(7100 + k, header * 3 + "end", "hot") for k in range(150)]
    rows += [(7400, "wort " * 9000, "de"), (7401, "wort " * 9001, "de"), (7399, "wort " * 9001, "de")]
    rng.shuffle(rows)
    return [(i, t, p, "x", 1, 1) for i, t, p in rows]


def labels(rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    out = [(i, k % 2, k % 3 == 0 and 1 or 0) for k, i in enumerate(ids) if k % 4]
    return out + [(ids[1], 1, None), (ids[1], None, 1), (None, 1, 1), (99999, 1, 1)]


def plain_mask(rows):
    out = []
    for doc, text, lang, *_ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        mask = len(words) < 200
        mask += 2 * (100 * len(set(words)) < 50 * len(words))
        mask += 4 * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t))
        mask += 8 * bool(re.search(r"[#$%&*|]", t))
        smaller = any(o is not None and doc is not None and o < doc and (u or "") == t for o, u, *_ in rows)
        out.append((doc, lang or "", mask + 16 * smaller))
    return out


def plain_audit(rows, named):
    masks = plain_mask(rows)
    good = {i for i, q, _ in named if q == 1 and i is not None}
    toxic = {i for i, _, t in named if t == 1 and i is not None}
    out, sums = {}, {}
    for part in {p for _, p, _ in masks}:
        own = [(d, m) for d, p, m in masks if p == part]
        for order in map("".join, permutations("ABCDE")):
            gone = 0
            for k, f in enumerate(order):
                bit = 1 << "ABCDE".index(f)
                fall = [(d, m) for d, m in own if m & bit and not m & gone]
                twice = sum(1 for _, m in own if m & bit and m & gone)
                gone |= bit
                out[part, order, k + 1] = [
                    sum(1 for _, m in own if not m & gone), len(fall), twice, sum(1 for _, m in own if m == bit),
                    sum(d in good for d, _ in fall), sum(d in toxic for d, _ in fall),
                ]
                sums[part, f] = sums.get((part, f), 0) + len(fall)
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found_masks(frame):
    out = []
    for r in frame.collect():
        out += [(r.doc_id, r.part, r.mask)] * r.n
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit, held", [(None, None), (3000, 10_000), (400, 1), (60_000, 1 << 20)])
def test_masks(make, limit, held):
    rows = documents()
    frame = make(rows, SCHEMA, 5)
    options = {"held_bytes": held} if held else {}
    if limit:
        texts = frame.selectExpr("cast(coalesce(text, '') AS binary) AS text")
        options["cuts"] = tries.prefix_cuts(texts, limit)
        assert len(options["cuts"]) > 4
    assert found_masks(audit.failure_masks(frame, **options)) == sorted(plain_mask(rows), key=repr)


def test_ranges_are_bounded(make):
    rows = documents()
    limit = 5000
    cuts = tries.prefix_cuts(make(rows, SCHEMA).selectExpr("cast(coalesce(text, '') AS binary) AS text"), limit)
    assert cuts[0] == b"" and cuts == sorted(set(cuts))
    weight, texts = {}, {}
    for _, t, *_ in rows:
        t = (t or "").encode()
        k = bisect_right(cuts, t) - 1
        weight[k] = weight.get(k, 0) + len(t) + tries.ROW_BYTES
        texts.setdefault(k, set()).add(t)
    assert all(w <= 2 * limit or len(texts[k]) == 1 for k, w in weight.items())


def test_audit(make):
    rows = documents()
    named = labels(rows)
    got = audit.filter_audit(make(rows, SCHEMA), make(named, LABELS))
    assert got.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()}
    assert found == plain_audit(rows, named)


def test_sql_on_hard_cases(spark, make, tmp_path):
    rows = documents()
    make([r[:3] + (0, 0) for r in rows], "doc_id long, text string, lang string, source int, n_chars int", 1).write.parquet(f"{tmp_path}/documents.parquet")
    make(labels(rows), LABELS, 1).write.parquet(f"{tmp_path}/labels.parquet")
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    ok, message = check_oracle.compare(spark, con, "op12_filter_audit", str(tmp_path))
    assert ok, message


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert audit.filter_audit(empty, spark.createDataFrame([], LABELS)).collect() == []


def test_words_of_long_texts(monkeypatch):
    text = "one two x three\x1fone one  \x0bend".encode()
    plain = re.findall(rb"[^\x20\x09-\x0D]+", text)
    for limit in (1 << 22, 0):
        monkeypatch.setattr(audit, "LONG", limit)
        assert audit.word_counts(text) == (len(plain), len(set(plain)))


def test_trie():
    rng = random.Random(2)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode() for _ in range(400)]
    trie = tries.TextTrie()
    for k, w in enumerate(words):
        node = trie.node(w)
        node[2] = [*(node[2] or ()), k]
    want = {}
    for k, w in enumerate(words):
        want.setdefault(w, []).append(k)
    assert list(trie.held()) == sorted(want.items())
