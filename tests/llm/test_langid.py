import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from zonarium.llm import langid
from zonarium.llm.common import id_hash

WORDS = {
    "en": "the of and to in is that with this from they house water thing would there".split(),
    "de": "der die und ist nicht mit auf eine zwischen schule straße wird haben über auch sich".split(),
    "fr": "le les des est une dans que pour avec être maison français où très nous vous".split(),
}


def documents(make):
    rows = []
    for i in range(600):
        lang = list(WORDS)[i % 3]
        words = WORDS[lang]
        rows.append((i, " ".join(words[(i * 7 + k * k + k * i) % len(words)] for k in range(3 + i % 40)), lang, 1.0))
    extra = [(1000, None, "en", 1.0), (1001, "", "en", 1.0), (1002, "12 34 !!", "de", 1.0), (1003, "the house", None, 1.0)]
    return rows, extra, make(rows + extra + [(None, "der die das", "de", 1.0)], "doc_id long, text string, lang string, score double")


def test_held_out_accuracy_and_rejection(make):
    rows, extra, docs = documents(make)
    held = id_hash("doc_id") % 4 == 2
    model = langid.fit(docs, ~held)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert len(got) == len(rows) + len(extra) + 1
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sum(got[r[0]].lang_pred == r[2] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values())
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert sum(got[r[0]].rejected for r in rows) <= 0.01 * len(rows)
    assert got[1003].lang_pred == "en"


def test_letters_of_no_learnt_language_are_rejected(make):
    rows, _, docs = documents(make)
    model = langid.fit(docs, F.lit(True))
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    strange = [" ".join(word(letters) for _ in range(40)) for letters in ["абвгдежзиклмн", "qxzjkvwp", "一二三四五六七"] for _ in range(30)]
    got = langid.predict(make([(i, t) for i, t in enumerate(strange)], "doc_id long, text string"), model).collect()
    assert sum(r.rejected for r in got) >= 0.9 * len(strange)
    long_text = make([(1, "the house of the water " * 50_000), (1, "the house"), (1, "the house")], "doc_id long, text string")
    assert [(r.lang_pred, r.rejected) for r in langid.predict(long_text, model).collect()] == [("en", False)] * 3


def test_repeatable_and_clashing_columns(make):
    _, _, docs = documents(make)
    model = langid.fit(docs, F.lit(True))
    again = langid.fit(docs.repartition(5), F.lit(True))
    assert (model.table == again.table).all()
    got = langid.predict(docs, model, keep=docs.columns, prefix="__")
    assert got.columns == [*docs.columns, "__lang_pred", "__score", "__rejected"]


def test_without_labels(make):
    docs = make([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True))
    assert {tuple(r) for r in langid.predict(docs, model).collect()} == {(1, "und", 0.0, True), (2, "und", 0.0, True)}
    assert langid.predict(docs.limit(0), model).collect() == []


def test_small_memory_gives_the_same():
    texts = [" ".join(WORDS["en"][: k % 9 + 1]) for k in range(30)] + ["der die und"] * 5
    model = langid.train(texts, ["en"] * 30 + ["de"] * 5)
    small, large = langid.Scorer(model, memo_words=2), langid.Scorer(model)
    for text in texts:
        assert abs(small.text_sums(text) - large.text_sums(text)).max() < 1e-9


def plain_prediction(model, text):
    """(language, score, rejected) from one subword at a time."""
    letters = set(b"abcdefghijklmnopqrstuvwxyz<>") | set(range(128, 256))
    sums, n = np.zeros(len(model.languages)), 0
    for word in text.lower().encode().split():
        word = b"<" + word.replace(b"<", b" ").replace(b">", b" ") + b">"
        for size in langid.SIZES:
            for start in range(len(word) - size + 1):
                part = word[start : start + size]
                if set(part) <= letters:
                    value = 0
                    for byte in part:
                        value = (value * 0x100000001B3 & (1 << 64) - 1) ^ (byte + 1)
                    sums += model.table[(value * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 48]
                    n += 1
    scores = (sums / max(n, 1) + model.bias) / model.temperature
    p = np.exp(scores - scores.max())
    p /= p.sum()
    top = max(range(len(p)), key=lambda k: (p[k], -k))
    return model.languages[top], p[top], p[top] < model.threshold


def test_predictions_equal_those_of_a_plain_scorer(make):
    rows, _, docs = documents(make)
    model = langid.fit(docs, F.lit(True))
    texts = [t for _, t, *_ in rows[:60]]
    texts += ["Ünd <b>DER</b> x1y2 die", "a", "the\x00house\x1fin 東京 дом", "word" * 3000, " ".join(texts), "ß ß ß", "a<b>c"] + [texts[0]] * 3
    made = make([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(made, model).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        lang, score, rejected = plain_prediction(model, text)
        assert (got[i].lang_pred, got[i].rejected) == (lang, rejected), text[:40]
        assert abs(got[i].score - score) < 1e-9
