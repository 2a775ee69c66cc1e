"""Language identification: averaged hashed subword embeddings, linear softmax.

A word is written as ``<word>`` in lower case; its subwords are the byte strings
of 2 to 5 bytes that hold only letters (and the two marks).  Each is hashed to a
row of an embedding table; the mean of a text's rows goes through a linear
softmax.  Embeddings and softmax are trained together by stochastic gradient
descent in numpy, on snippets of a bounded sample of labelled documents.

Scores are calibrated: a temperature is fitted on snippets kept from training,
and texts whose calibrated score is below a threshold, chosen so that of those
snippets at most ``REJECT_SHARE`` fall under it, are rejected.

As mean and softmax are linear up to the last step, a trained model is one table
(hash row by language); a text's score needs only the sum of its words' rows,
and each different word is looked up once per task (a bounded memory).

Defined results: a text that is null or has no letter is ``und``, score 0 and
rejected; ties go to the first language in alphabetical order; a text whose
letters form no subword gets the languages' shares; labels that are null teach
nothing; with no labelled document every text is ``und``; repeated rows are
predicted each; an empty table gives an empty result; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonarium.llm.common import text_or_empty

BUCKETS = 1 << 16
DIMENSIONS = 16
SIZES = (2, 3, 4, 5)
#: Labelled documents of each language that the model is fitted on: bounded, drawn by hash.
SAMPLE_PER_LANGUAGE = 600
SNIPPET_WORDS = 24
SNIPPETS = 6
EPOCHS = 4
RATE = 0.5
REJECT_SHARE = 0.001
MEMO_WORDS = 400_000
UNDETERMINED = "und"

# a-z, the two marks and every byte of a character outside ASCII.
_KEPT = np.zeros(256, bool)
_KEPT[97:123] = _KEPT[128:] = True
_KEPT[[60, 62]] = True


def subwords(words):
    """(hash rows, first index of each word) of a list of words given as bytes."""
    joined = b"".join(b"<" + w.replace(b"<", b" ").replace(b">", b" ") + b">" for w in words)
    text = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends = np.cumsum(lengths)
    word_of = np.repeat(np.arange(len(words)), lengths)
    bad = np.concatenate([[0], np.cumsum(~_KEPT[text])])
    values = text.astype(np.uint64) + np.uint64(1)
    rows, owners, grams = [], [], np.zeros(len(text), np.uint64)
    n = len(text)
    for size in range(1, max(SIZES) + 1):
        if size > n:
            break
        m = n - size + 1
        grams = grams[:m] * np.uint64(0x100000001B3) ^ values[size - 1 :]
        if size in SIZES:
            start = np.arange(m)
            good = (bad[size:] == bad[:m]) & (start + size <= ends[word_of[:m]])
            mixed = grams[good] * np.uint64(0x9E3779B97F4A7C15)
            rows.append((mixed >> np.uint64(64 - 16)).astype(np.int64) % BUCKETS)
            owners.append(word_of[:m][good])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])


def words_of(text):
    return text.lower().encode().split()


class Model:
    """Languages, the table of summed scores by hash row, temperature and threshold."""

    def __init__(self, languages, table, bias, temperature=1.0, threshold=0.0):
        self.languages, self.table, self.bias = languages, table, bias
        self.temperature, self.threshold = temperature, threshold

    def probabilities(self, sums, counts):
        scores = sums / np.maximum(counts, 1)[:, None] + self.bias
        scores = scores / self.temperature
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)


class Scorer:
    """Sums of a text's subword scores, each word remembered."""

    def __init__(self, model, memo_words=MEMO_WORDS):
        self.model, self.memo_words = model, memo_words
        self.clear()

    def clear(self):
        self.memo, self.sums, self.filled = {}, np.zeros((1024, len(self.model.languages) + 1)), 0

    def learn(self, words):
        rows, starts = subwords(words)
        counts = np.diff(starts)
        made = np.zeros((len(words), self.sums.shape[1]))
        if len(rows):
            full = np.flatnonzero(counts)
            made[full, :-1] = np.add.reduceat(self.model.table[rows], starts[full], axis=0)
        made[:, -1] = counts
        need = self.filled + len(words)
        if need > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((max(need, len(self.sums)), self.sums.shape[1]))])
        self.sums[self.filled : need] = made
        self.memo.update(zip(words, range(self.filled, need)))
        self.filled = need

    def text_sums(self, text):
        words = words_of(text)
        if len(self.memo) > self.memo_words:
            self.clear()
        get = self.memo.__getitem__
        try:
            at = list(map(get, words))
        except KeyError:
            self.learn([w for w in dict.fromkeys(words) if w not in self.memo])
            at = list(map(get, words))
        return self.sums[at].sum(axis=0)


def train(texts, labels, seed=7):
    """Model from labelled texts (numpy SGD; every fifth text calibrates)."""
    languages = sorted(set(labels))
    index = {name: i for i, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    examples = []
    for k, (text, label) in enumerate(zip(texts, labels)):
        words = words_of(text)
        for s in range(SNIPPETS):
            size = max(2, SNIPPET_WORDS >> (s % 4))
            start = int(rng.integers(0, max(1, len(words) - size)))
            rows, _ = subwords(words[start : start + size]) if words else (np.zeros(0, np.int64), None)
            if len(rows):
                examples.append((k % 5 == 0, rows, index[label]))
    k = len(languages)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, k), np.float32)
    weights += rng.normal(0, 0.1, weights.shape)
    bias = np.zeros(k, np.float32)
    taught = [e for e in examples if not e[0]]
    # Each language weighs the same in training, whatever its share of the sample.
    freq = np.bincount([e[2] for e in taught], minlength=k).clip(1)
    scale = freq.sum() / (k * freq)
    steps, total = 0, max(1, EPOCHS * len(taught))
    for _ in range(EPOCHS):
        for at in rng.permutation(len(taught)):
            _, rows, y = taught[at]
            rate = RATE * (1 - steps / total)
            steps += 1
            mean = vectors[rows].mean(axis=0)
            p = mean @ weights + bias
            p = np.exp(p - p.max())
            p /= p.sum()
            p[y] -= 1
            p *= rate * scale[y]
            back = weights @ p
            weights -= np.outer(mean, p)
            bias -= p * 0.1
            np.subtract.at(vectors, rows, back / len(rows) * 8)
    model = Model(languages, (vectors @ weights).astype(np.float64), bias.astype(np.float64))
    kept = [e for e in examples if e[0]]
    if kept:
        sums = np.array([model.table[rows].sum(axis=0) for _, rows, _ in kept])
        counts = np.array([len(rows) for _, rows, _ in kept])
        truth = np.array([y for *_, y in kept])

        def loss(t):
            model.temperature = t
            p = model.probabilities(sums, counts)[np.arange(len(truth)), truth]
            return -np.log(p.clip(1e-12)).mean()

        model.temperature = min(np.geomspace(0.05, 5, 40), key=loss)
        best = model.probabilities(sums, counts).max(axis=1)
        model.threshold = float(np.quantile(best, REJECT_SHARE))
    return model


def labelled_sample(documents, learn, doc_id="doc_id", text="text", lang="lang", per_language=SAMPLE_PER_LANGUAGE):
    """(texts, labels) of a bounded sample: about ``per_language`` documents of each language, drawn by hash."""
    base = documents.filter(learn & F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = {r[0]: r[1] for r in base.groupBy(lang).count().collect()}  # one row per language
    if not counts:
        return [], []
    share = F.lit(0.0)
    for name, n in sorted(counts.items()):
        share = F.when(F.col(lang) == name, per_language / n).otherwise(share)
    draw = (F.xxhash64(F.col(doc_id).cast("string"), F.lit("sample")) % 1_000_003 + 1_000_003) % 1_000_003 / 1_000_003
    rows = base.filter(draw < share).select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(lang).alias("l"))
    most = 2 * per_language * len(counts)
    kept = sorted(rows.limit(most).collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return [r[1] for r in kept], [r[2] for r in kept]


def fit(documents, learn, **columns):
    """Model learnt from those documents for which the column ``learn`` is true."""
    texts, labels = labelled_sample(documents, learn, **columns)
    return train(texts, labels) if labels else None


def predict(documents, model, doc_id="doc_id", text="text", keep=None, prefix=""):
    """Columns doc_id, lang_pred, score, rejected, after ``keep`` (default: the id as doc_id).

    ``prefix`` goes before the names lang_pred, score and rejected, so that they
    do not clash with those of kept columns.
    """
    # A table of fixed size, sent as plain arrays.
    parts = (model.languages, model.table, model.bias, model.temperature, model.threshold) if model else None
    shared = documents.sparkSession.sparkContext.broadcast(parts)
    names = [prefix + name for name in ("lang_pred", "score", "rejected")]
    kept = [F.col(doc_id).cast("long").alias("doc_id")] if keep is None else [F.col(name) for name in keep]
    source = documents.select(*kept, text_or_empty(text).alias("__text"))
    kinds = source.schema.fields[:-1]

    def run(batches):
        model = Model(*shared.value) if shared.value else None
        scorer = Scorer(model) if model else None
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            lettered = [model is not None and any(map(str.isalpha, t)) for t in texts]
            found, best, out = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            full = [i for i, yes in enumerate(lettered) if yes]
            if full:
                sums = np.array([scorer.text_sums(texts[i]) for i in full])
                p = model.probabilities(sums[:, :-1], sums[:, -1])
                top = p.argmax(axis=1)
                best[full] = p[np.arange(len(full)), top]
                out[full] = best[full] < model.threshold
                for i, k in zip(full, top):
                    found[i] = model.languages[k]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.string()), pa.array(best), pa.array(out)],
                names=[*batch.schema.names[:-1], *names],
            )

    schema = T.StructType(
        [*kinds, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())]
    )
    return source.mapInArrow(run, schema)
