"""Quality by a generalised additive model with pairwise interactions.

A text is described by shape statistics (``FEATURES``). Each feature is cut
into quantile bins; boosting visits the features in a cycle and fits a shallow
tree of one feature to the current gradient, and the trees of a feature add up
to its lookup table of bin scores. Pairs of features are then ranked by how
much a small two-feature tree still gains, and the best are boosted in a cycle
in the same way, into tables of two bins. A score is the sigmoid of the sum of
table entries: array additions, no tree is walked.

The model is fitted on at most ``SAMPLE_DOCS`` labelled rows; their features,
not their texts, reach the driver.

Defined cases: null and empty texts have all statistics 0 and are scored like
any other; null and repeated ids are scored row by row; without labelled rows
the model is a constant 0.5; a single label gives a constant near it; an empty
table gives no rows; further columns are ignored by ``predict`` and kept by
``reject``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from implicit_rank.llm import common

SAMPLE_DOCS = 20_000  # at most so many labelled texts are learned from
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE = 0.1
RIDGE = 2.0           # added to the hessian of a leaf
THRESHOLD = 0.7

FEATURES = [
    "words", "mean_word", "longest_word", "distinct_share", "top_share", "repeat_share", "longest_run",
    "upper", "digit", "space", "exclaim", "pipe", "end_mark", "comma", "other_mark", "symbol", "non_ascii",
    "short_words", "lines", "mean_line", "distinct_lines", "upper_words", "letterless_words", "bigram_share",
]

# Byte classes of UTF-8 texts.
UPPER, DIGIT, SPACE, EXCLAIM, PIPE, END, COMMA, MARK, SYMBOL, HIGH, REST = range(11)
BYTE_CLASS = np.full(256, REST, np.int64)
BYTE_CLASS[128:] = HIGH
for _name, _chars in ((UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, "0123456789"), (SPACE, " \t\n\r"), (EXCLAIM, "!"),
                      (PIPE, "|"), (END, ".?"), (COMMA, ","), (MARK, "'\"()-:;"), (SYMBOL, "#$%&*+/<=>@[\\]^_`{}~")):
    BYTE_CLASS[[ord(c) for c in _chars]] = _name


def describe(text: str) -> list[float]:
    """The statistics of FEATURES of one text."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, counts = len(words), Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    data = text.encode("utf-8", "replace")
    classes = np.bincount(BYTE_CLASS, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=11) / len(data)
    same = np.fromiter(map(eq, words, words[1:]), bool, n - 1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    run = 1 + (int((edges[1::2] - edges[::2]).max()) if len(edges) else 0)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(n), float(lengths.mean()), float(lengths.max()), len(counts) / n, max(counts.values()) / n,
        float(same.mean()) if n > 1 else 0.0, float(np.log(run)),
        *classes[[UPPER, DIGIT, SPACE, EXCLAIM, PIPE, END, COMMA, MARK, SYMBOL, HIGH]].tolist(),
        float((lengths <= 3).mean()), np.log1p(len(lines)), float(np.log1p(len(data) / len(lines))),
        len(set(lines)) / len(lines), sum(w.isupper() for w in counts) / len(counts),
        sum(not any(c.isalpha() for c in w) for w in counts) / len(counts),
        len(set(zip(words, words[1:]))) / max(1, n - 1),
    ]


def described(texts: pa.Array) -> np.ndarray:
    return np.array([describe(t) for t in common.strings(texts)], float).reshape(-1, len(FEATURES))


@dataclass
class Model:
    edges: list[np.ndarray] = field(default_factory=list)        # bin edges by feature
    pair_edges: list[np.ndarray] = field(default_factory=list)   # coarser edges, for pairs
    bias: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)       # bin scores by feature
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)  # (bins, bins) scores by pair

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, k], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[i], x[:, i], side="right"),
                           np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return common.sigmoid(total)


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, position) of the best cut of a row of bins into a left and a right part."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(gains.argmax())
    return float(gains[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Bin scores of a depth-two tree over one feature's bins."""
    out = np.zeros(len(g))
    gain, at = _cut(g, h)
    halves = [slice(0, at), slice(at, len(g))] if gain > 1e-9 else [slice(0, len(g))]
    for part in halves:
        gain, cut = _cut(g[part], h[part])
        middle = part.start + cut
        leaves = [slice(part.start, middle), slice(middle, part.stop)] if gain > 1e-9 else [part]
        for leaf in leaves:
            out[leaf] = g[leaf].sum() / (h[leaf].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, bin scores) of a tree over two features: one cut, then each part by the other."""
    best = (0.0, np.zeros(g.shape))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        at = _cut(a.sum(axis=1), b.sum(axis=1))[1] or 1
        out, gain = np.zeros(a.shape), -_gain(a.sum(), b.sum())
        for part in (slice(0, at), slice(at, len(a))):
            row_g, row_h = a[part].sum(axis=0), b[part].sum(axis=0)
            cut = _cut(row_g, row_h)[1]
            for leaf in (slice(0, cut), slice(cut, a.shape[1])):
                out[part, leaf] = row_g[leaf].sum() / (row_h[leaf].sum() + RIDGE)
                gain += _gain(row_g[leaf].sum(), row_h[leaf].sum())
        if gain > best[0]:
            best = (float(gain), out.T if flip else out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of single features, then of the pairs that gain most."""
    if not len(y):
        return Model()
    rate = (y.sum() + 0.5) / (len(y) + 1)
    k = x.shape[1]
    model = Model([_edges(x[:, i], BINS) for i in range(k)], [_edges(x[:, i], PAIR_BINS) for i in range(k)],
                  float(np.log(rate / (1 - rate))))
    fine = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logit = np.full(len(y), model.bias)
    for _ in range(ROUNDS):
        for i in range(k):
            p = common.sigmoid(logit)
            size = len(model.tables[i])
            step = RATE * _tree(np.bincount(fine[i], weights=y - p, minlength=size),
                                np.bincount(fine[i], weights=p * (1 - p), minlength=size))
            model.tables[i] += step
            logit += step[fine[i]]
    coarse = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def grids(i: int, j: int):
        p = common.sigmoid(logit)
        cell, shape = coarse[i] * sizes[j] + coarse[j], (sizes[i], sizes[j])
        return cell, [np.bincount(cell, weights=v, minlength=shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p))]

    gains = {(i, j): _pair_tree(*grids(i, j)[1])[0] for i in range(k) for j in range(i + 1, k)}
    model.pairs = sorted(gains, key=lambda ij: (-gains[ij], ij))[:PAIRS]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            cell, (g, h) = grids(i, j)
            step = RATE * _pair_tree(g, h)[1]
            table += step
            logit += step.ravel()[cell]
    return model


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE_DOCS) -> Model:
    """Fit on the bounded sample of labelled texts; a text that is repeated counts once."""
    sample = common.labelled_texts(docs, labels, label, bound).groupBy("text").agg(F.max("y").alias("y"))

    def run(batches):
        for chunk in common.text_chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(described(common.texts_of(chunk)))), common.one_array(chunk.column("y"))], names=["x", "y"])

    rows = sample.mapInArrow(run, "x array<double>, y int").toArrow()  # <= bound rows of len(FEATURES) numbers
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = rows.column("y").to_numpy().astype(float)
    order = np.lexsort([*x.T, y])  # the same order, and so the same sums, whichever task ends first
    return fit(x[order], y[order])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers a feature

    def run(batches):
        for chunk in common.text_chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [common.one_array(chunk.column("doc_id")), pa.array(shared.value.score(described(common.texts_of(chunk))))],
                names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, columns unchanged; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for chunk in common.text_chunks(batches):
            keep = shared.value.score(described(common.texts_of(chunk))) >= threshold
            yield from chunk.filter(pa.array(keep)).to_batches()

    return docs.mapInArrow(run, docs.schema)
