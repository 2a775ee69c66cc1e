import hashlib
import random
import zlib

import pytest

import check_oracle
from zonarium.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, node string, parent string"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def conversations(longest=60):
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 40), *range(150, 170), 200, 305, 307, -3, -150, 2**40 + 7, 9999]:
        if c % 11 == 0 and c:
            length = 1
        else:
            length = rng.randrange(1, 9)
        for k in range(length):
            text = rng.choice(["", "a", "hello you", "été 😀", None]) if k < 3 else f"t{rng.randrange(3)}"
            rows.append((c, k, rng.choice(["user", "assistant", None]), text))
    for c in (410, 411, 423):  # long, with the same own turns
        rows += [(c, k, "user", "long " + str(k // 2)) for k in range(longest)]
    rows += [(500, None, "user", x) for x in "bbbbbaaaa"] + [(501, 4, r, "tie") for r in ("x", "y", "x")]
    rows += [(600, 1, "u", "v")] * 20 + [(None, 1, "user", "no one")] * 3
    rng.shuffle(rows)
    return [(*r, 1, "n", "p") for r in rows]


def plain(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    members = {}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        paths[c] = tuple(own.get(base, [])[:h] + ts[h:])
        for d in range(len(paths[c]) + 1):
            members.setdefault(paths[c][:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        saved = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(out[q][6] for q in below)
        leaves = sum(out[q][5] for q in below) or 1
        ends = ",".join(map(str, sorted(c for c in members[p] if len(paths[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out[p] = (min(members[p]), len(p), parent, len(members[p]), len(below), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values())


@pytest.mark.parametrize("band, ids", [(16, 8192), (2, 3), (3, 1)])
def test_nodes(make, monkeypatch, band, ids):
    monkeypatch.setattr(prefixtrie, "IDS", ids)
    rows = conversations()
    got = prefixtrie.conversation_trie(make(rows, SCHEMA, 4), band=band)
    assert got.columns == NAMES
    found = [tuple(r) for r in got.collect()]
    assert sorted(found) == plain(rows)


def test_one_conversation_over_many_tasks(spark, make, monkeypatch):
    """A third of all rows in one conversation: its sums go on from task to task."""
    rows = [(7, k, "u", f"x{k % 5}", 0, "", "") for k in range(3000)] + [(8, k, "u", f"x{k % 5}", 0, "", "") for k in range(2990)]
    rows += [(c, 0, "u", "first", 0, "", "") for c in range(1000, 2000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = prefixtrie._placed(make(rows, SCHEMA, 6).select("conv_id", "turn", "role", "text"))
        at = placed.filter("conv_id = 7").orderBy("place").collect()
        assert [r.place for r in at] == list(range(1, 3001))
        assert len({(r.s0, r.s1, r.s2, r.s3) for r in at}) == 3000
        assert all(a.s2 == b.b2 for a, b in zip(at, at[1:]))
        got = prefixtrie.conversation_trie(make(rows, SCHEMA, 6)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(map(tuple, got)) == plain(rows)


def test_sql(spark, make, tmp_path):
    make([r[:4] for r in conversations(20)], "conv_id long, turn long, role string, text string", 1).write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    ok, message = check_oracle.compare(spark, con, "op11_conversation_trie", str(tmp_path))
    assert ok, message


def test_very_long_text_and_one_turn(make):
    rows = [(1, 0, "user", "é" * 3_000_000, 0, "", ""), (2, 0, "user", "é" * 3_000_000, 0, "", "")]
    assert sorted(tuple(r) for r in prefixtrie.conversation_trie(make(rows, SCHEMA)).collect()) == plain(rows)


def test_empty(spark):
    assert prefixtrie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
