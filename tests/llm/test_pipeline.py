import random

import corpus_pipeline as pipeline
from zonarium.llm import jaccard, langid, suffix
from zonarium.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_on_its_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(out)
        result = spark.read.parquet(out)
        before, after = docs.collect(), result.collect()
        ids = {r.doc_id for r in before}
        if name == "language_id":
            gone = ids - {r.doc_id for r in after}
            assert len(gone) <= 0.02 * len(ids)
        elif name == "near_duplicates":
            classes = jaccard.jaccard_join(docs).collect()
            assert {r.doc_id for r in after} == {r.class_id for r in classes}
        elif name == "repeated_passages":
            report = {r.doc_id: r for r in suffix.removal_report(docs, length=suffix.PASSAGE_LENGTH).collect()}
            assert {r.doc_id for r in after} == ids
            texts = {r.doc_id: r.text for r in before}
            for r in after:
                assert r.n_chars == len(r.text)
                assert r.text == texts[r.doc_id] or report[r.doc_id].n_removed > 0
        else:
            words = {r.doc_id: len(r.text.split()) for r in before}
            packed = {}
            for r in after:
                packed[r.doc_id] = packed.get(r.doc_id, 0) + r.n_tokens
            assert packed == words
        if k + 1 < len(pipeline.STAGES):
            assert result.columns == columns
        docs = result


def test_passages_of_51_words(spark):
    """Passages in 2, 5 and 800 documents go; documents that share less than that stay."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    line = "All rights reserved by the writer of this text. " * 3
    passages = [(text(51), n) for n in [2] * 30 + [5] * 20 + [800]]
    rows, planted = [], {}
    for passage, n in passages:
        for _ in range(n):
            planted[len(rows)] = passage
            rows.append(f"{text(40)} {passage} {text(40)}")
    clean = list(range(len(rows), len(rows) + 400))
    rows += [text(80) + (" " + line if k % 2 else "") + text(20) for k in range(400)]
    rows.append(text(60_000))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    after = {r.doc_id: r.text for r in pipeline.repeated_passages(spark, docs, SF_DIR).collect()}
    caught = sum(passage not in after[i] for i, passage in planted.items())
    assert caught >= 0.95 * len(planted)
    assert sum(after[i] == rows[i] for i in clean) >= 0.99 * len(clean)
    assert after[len(rows) - 1] == rows[-1]


def test_clashing_columns_and_nulls(spark):
    rows = [(i, f"the house and the water are {i} miles from there, with {i * i} others", "en", "s", 9, "k", 0.5) for i in range(30)]
    rows += [(40, None, "en", None, None, "k", 0.5), (41, "", None, "s", 0, "k", 0.5), (None, "the water and the house of all", "en", "s", 1, "k", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, score double")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "score"]
    assert docs.count() >= 30
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_run_and_registered_queries(spark):
    assert pipeline.run(spark, SF_DIR).count() > 0
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert langid.UNDETERMINED == "und"
