"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded by tree.

Every block element, and every run of text that stands directly in the body or in
no element, is a node with features: density of its subtree (text, tags,
links, punctuation), words of its attributes, depth, place and siblings.  Boosted
trees give each node the log odds of being main text.  They are fitted on a
bounded sample of pages whose telling names (``article``, ``nav``, class words)
label their nodes; half of the training rows hide the names, so that pages
without them are judged by their structure.

Decoding is hierarchical: going up the tree, a node is kept if its own log odds,
weighted by its text, and the best of its children add up to more than dropping
it; a dropped node drops all below it.  So no kept node stands in a dropped one.
Beforehand only the content of script, style, textarea, title and iframe is skipped.

Defined results: a null or empty page has an empty text and 0 characters, as has
a page of which nothing is kept; with no labelled sample nodes are judged by
their names and link density; repeated rows are extracted each; an empty table
gives an empty result; other columns are ignored.  Pages are read whole.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from zonarium.llm import dom
from zonarium.llm.common import text_or_empty

#: Pages the trees are fitted on, at most, drawn by hash.
SAMPLE_PAGES = 400
TREES, DEPTH, BINS = 40, 3, 32
RATE, DAMPING, LEAST_ROWS = 0.3, 1.0, 20
#: Nodes whose own judgement is not asked: they hold the whole page.
WHOLE = dom.WHOLE


class BoostedTrees:
    """Binary trees of fixed depth, as arrays: features and cuts of inner nodes, values of leaves."""

    def __init__(self, base, feature, cut, value):
        self.base, self.feature, self.cut, self.value = base, feature, cut, value

    def log_odds(self, rows):
        out = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (rows[every, feature[at]] > cut[at])
            out += value[at - (2**DEPTH - 1)]
        return out


def boost(rows, truth, trees=TREES):
    """Gradient boosting of the logistic loss with histogram splits."""
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, rows[:, f]) for f, e in enumerate(edges)])
    share = np.clip(truth.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    inner = 2**DEPTH - 1
    features, cuts, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = truth - p, p * (1 - p)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for node in range(inner):
            own = at == node
            if own.sum() >= 2 * LEAST_ROWS:
                best = 1e-6
                g, h, b = slope[own], bend[own], binned[own]
                total_g, total_h = g.sum(), h.sum()
                for f in range(width):
                    if not len(edges[f]):
                        continue
                    size = len(edges[f]) + 1
                    gs = np.cumsum(np.bincount(b[:, f], g, size))[:-1]
                    hs = np.cumsum(np.bincount(b[:, f], h, size))[:-1]
                    ns = np.cumsum(np.bincount(b[:, f], minlength=size))[:-1]
                    gain = (
                        gs**2 / (hs + DAMPING)
                        + (total_g - gs) ** 2 / (total_h - hs + DAMPING)
                        - total_g**2 / (total_h + DAMPING)
                    )
                    gain[(ns < LEAST_ROWS) | (len(g) - ns < LEAST_ROWS)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[node], cut[node] = gain[k], f, edges[f][k]
            # bin <= k  <=>  value <= edge k
            at[own] = 2 * node + 1 + (rows[own, feature[node]] > cut[node])
        leaf = at - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        value = RATE * g / (h + DAMPING)
        score += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return BoostedTrees(base, features, cuts, values)


def fit_pages(pages):
    """Trees fitted on the nodes of these pages that names label; None without both labels."""
    rows, truth = [], []
    for page in pages:
        nodes, _ = dom.parse(page or "")
        for node, features, label in zip(nodes, dom.feature_rows(nodes), dom.seed_labels(nodes)):
            if label >= 0 and node.chars and node.tag not in WHOLE:
                rows.append(features)
                truth.append(label)
    truth = np.array(truth, float)
    if not len(truth) or truth.min() == truth.max():
        return None
    rows = np.array(rows, float)
    hidden = rows.copy()
    hidden[:, : dom.NAMED] = 0
    return boost(np.concatenate([rows, hidden]), np.concatenate([truth, truth]))


def by_names(nodes):
    """Log odds without trees: names, else link density and length."""
    out = []
    for node, label in zip(nodes, dom.seed_labels(nodes)):
        if label >= 0:
            out.append(4.0 if label else -4.0)
        else:
            out.append(1.0 if node.chars >= 80 and node.links < 0.4 * node.chars else -1.0)
    return np.array(out)


def decode(nodes, odds):
    """True for nodes that are kept; no kept node is below a dropped one."""
    gain = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        own = 0.0 if node.tag in WHOLE else float(odds[i]) * max(1.0, node.chars) ** 0.5
        gain[i] += own
        if node.parent >= 0 and gain[i] > 0:
            gain[node.parent] += gain[i]
    kept = [True] * len(nodes)
    for i, node in enumerate(nodes):
        kept[i] = (node.parent < 0 or kept[node.parent]) and (gain[i] > 0 or node.tag in WHOLE)
    return kept


def main_text(nodes, blocks, odds):
    kept = decode(nodes, odds)
    out, begun, space = [], False, False
    for at, text in blocks:
        goes_on = text[0] in (dom.GLUED, dom.SPACED)
        begun, space = begun and goes_on, goes_on and (space or text[0] == dom.SPACED)
        if kept[at] and nodes[at].tag != "head":
            if out:
                out.append("\n\n" if not begun else " " if space else "")
            out.append(text[1:] if goes_on else text)
            begun, space = True, False
    return "".join(out)


def page_sample(pages, html="html", most=SAMPLE_PAGES):
    """At most ``most`` pages, those with the least hash of their content."""
    rows = pages.filter(F.col(html).isNotNull()).select(F.col(html).alias("html"))
    # A draw by hash first, so that only a bounded number of pages is sorted.
    total = rows.count()
    if not total:
        return []
    share = min(1.0, 2.0 * most / total)
    drawn = F.pmod(F.xxhash64("html", F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * share) + 1
    return [r[0] for r in rows.filter(drawn).orderBy(F.xxhash64("html")).limit(most).collect()]


def extract_main_text(pages, page_id="page_id", url="url", html="html", sample_pages=SAMPLE_PAGES):
    """Columns page_id, url, text, n_chars; the trees are fitted on a sample of the pages."""
    trees = fit_pages(page_sample(pages, html, sample_pages))
    parts = (trees.base, trees.feature, trees.cut, trees.value) if trees else None
    shared = pages.sparkSession.sparkContext.broadcast(parts)  # of fixed size

    def run(batches):
        trees = BoostedTrees(*shared.value) if shared.value else None
        for batch in batches:
            pages = batch.column(2).to_pylist()
            texts = []
            for at in range(0, len(pages), 200):
                parsed = [dom.parse(page) for page in pages[at : at + 200]]
                if trees:
                    rows = np.array([row for nodes, _ in parsed for row in dom.feature_rows(nodes)], float)
                    odds = trees.log_odds(rows)
                else:
                    odds = np.concatenate([by_names(nodes) for nodes, _ in parsed])
                start = 0
                for nodes, blocks in parsed:
                    texts.append(main_text(nodes, blocks, odds[start : start + len(nodes)]))
                    start += len(nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_or_empty(html).alias("html")
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")
