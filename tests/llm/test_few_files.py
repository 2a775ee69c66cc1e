"""Small intermediate tables go to few files, whatever the number of shuffle partitions."""

import random
from pathlib import Path

import pytest

from zonarium import session
from zonarium.llm import jaccard, suffix
from zonarium.llm.common import stored

SCHEMA = "doc_id long, text string"
SETTINGS = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def many_partitions(spark):
    """As on a cluster that always deals rows to a fixed number of partitions."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def files_written(spark, work):
    """What ``work`` returns, and the number of part files by label that it left in the shared folder."""
    folder = Path(session.shared_dir(spark).removeprefix("file:")) / "zonarium"
    had = set(folder.iterdir()) if folder.exists() else set()
    out = work()
    files = {}
    for path in set(folder.iterdir()) - had:
        label = path.name.split("-")[0]
        files[label] = max(files.get(label, 0), len(list(path.glob("part-*"))))
    return out, files


def documents():
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    passage, copied, near = words(80), words(90), words(200)
    rows = [(i, words(60)) for i in range(100)]
    rows += [(100 + i, f"{words(20)} {passage} {words(20)}") for i in range(120)]
    rows += [(300 + i, copied) for i in range(60)]
    return rows + [(400 + i, f"{near} {words(3)}") for i in range(60)], passage


def test_rounds_of_repeated_passages(many_partitions, make):
    rows, passage = documents()
    cut = lambda: suffix.remove_repeats(make(rows, SCHEMA), length=200, most=8, least_words=51).collect()
    got, files = files_written(many_partitions, cut)
    assert len(got) == len(rows)
    assert not any(passage in r.text for r in got)
    assert all(r.text == "" for r in got if 300 <= r.doc_id < 400)
    assert {r.doc_id: r.text for r in got if r.doc_id < 100} == dict(rows[:100])
    assert "halves" in files
    assert max(files[k] for k in ("keys", "kinds", "counts", "hits", "halves", "shards")) == 1


def test_near_copies(many_partitions, make):
    rows, _ = documents()
    kept, files = files_written(many_partitions, lambda: jaccard.keep_one(make(rows, SCHEMA)))
    assert kept.rdd.getNumPartitions() == 1
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i < 300} | {300, 400}
    assert max(files[k] for k in ("texts", "groups", "members", "edges", "labels", "classes")) == 1


def test_rows_beyond_a_file_keep_their_partitions(spark):
    """The bound only joins partitions; without one nothing changes."""
    rows = spark.range(0, 1000, 1, 10)
    for bound, per_file, files in ((1000, 100, 10), (1000, 10, 10), (1000, 250, 4), (None, 250, 10), (0, 250, 1)):
        out = stored(rows, "rows", bound, per_file)
        assert len(out.inputFiles()) == files
        assert sorted(r.id for r in out.collect()) == list(range(1000))
