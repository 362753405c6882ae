"""Quality classifier: generalised additive model with pairwise interactions.

Method.  Every feature is cut into quantile bins.  Cyclic boosting visits the
features in turn; at each visit a shallow tree is fitted to the residuals over
the feature's bins and its leaves are added, shrunk, to the feature's lookup
table.  Then the pairs that reduce the residuals most get two-dimensional tables
in the same way.  A score is the logistic of the sum of table entries: vectorised
bin additions.

Scale.  Features come from one narrow pass over whole texts (numpy over Arrow
buffers).  The model is fitted on the driver from at most ``max_train`` labelled
rows (the smallest by a hash of doc_id): a few numbers per row, a documented bound.
Scoring and filtering are one more narrow pass.

NULL and empty texts have all-zero features and are scored as such.  Labels other
than 0 and 1 are ignored; a document with several labels takes the greatest.
Without labels of both kinds the score is the share of label 1 (0.5 if none).
Rows with a NULL doc_id are scored and belong to no label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct, listed, shingles, slices, span_hashes, spans, words

FEATURES = ["log_words", "mean_word", "upper", "digit", "symbol", "stop_punct", "pipe", "long_words", "short_words",
            "distinct_words", "top_word", "distinct_pairs", "distinct_shingles", "distinct_lines", "words_per_line",
            "upper_words"]

_CLASS = np.zeros(256, np.int8)  # 1 upper, 2 lower or non-ASCII, 3 digit, 4 .,;:'"?-, 5 |, 6 other symbol
_CLASS[[*range(33, 127)]] = 6
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 1, 2, 2, 3
_CLASS[[ord(c) for c in ".,;:'\"?-"]] = 4
_CLASS[ord("|")] = 5
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _share(rows: np.ndarray, values: np.ndarray, total: np.ndarray, k: int) -> np.ndarray:
    """Distinct values per row over their number."""
    return np.bincount(distinct(rows, values)[0], minlength=k) / np.maximum(total, 1)


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(rows, len(FEATURES)) statistics of a slice of texts."""
    k = len(offs) - 1
    low, start, end, row, wh = words(data, offs)
    n = np.bincount(row, minlength=k)
    kinds = _CLASS[data]
    doc = np.repeat(np.arange(k), np.diff(offs))
    counts = np.bincount(doc * 8 + kinds, minlength=8 * k).reshape(k, 8)
    chars = np.maximum(counts[:, 1:].sum(1), 1)
    letters = np.maximum(counts[:, 1] + counts[:, 2], 1)
    size = end - start
    first = (_CLASS[data[start]] == 1) & (_CLASS[data[end - 1]] != 2) & (size > 2) if len(start) else np.zeros(0, bool)
    out = np.zeros((k, len(FEATURES)))
    safe = np.maximum(n, 1)
    out[:, 0] = np.log1p(n)
    out[:, 1] = np.bincount(row, size, k) / safe
    out[:, 2] = counts[:, 1] / letters
    out[:, 3], out[:, 4], out[:, 5], out[:, 6] = (counts[:, c] / chars for c in (3, 6, 4, 5))
    out[:, 7] = np.bincount(row, size > 12, k) / safe
    out[:, 8] = np.bincount(row, size < 4, k) / safe
    out[:, 9] = _share(row, wh, n, k)
    if len(row):
        order = np.lexsort((wh, row))
        r, h = row[order], wh[order]
        new = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])])
        runs = np.diff(np.r_[new, len(r)])
        np.maximum.at(out[:, 10], r[new], runs / safe[r[new]])
    for at, width in ((11, 2), (12, 4)):
        rows, sh = shingles(wh, row, k, width)
        out[:, at] = _share(rows, sh, np.bincount(rows, minlength=k), k)
    ls, le, lrow = spans(low, offs, _NEWLINE[low])
    lines = np.bincount(lrow, minlength=k)
    out[:, 13] = _share(lrow, span_hashes(low, ls, le), lines, k)
    out[:, 14] = np.log1p(n / np.maximum(lines, 1))
    out[:, 15] = np.bincount(row, first, k) / safe
    out[n == 0] = 0
    return out


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row0, data, offs in slices(batch.column(1)):
            x = features(data, offs)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row0, len(x)).cast(pa.int64()),
                listed(x.ravel(), np.repeat(np.arange(len(x)), x.shape[1]), len(x), pa.float64()),
            ], names=["y", "x"])


@dataclass
class Model:
    """Cuts and lookup tables; ``pairs`` maps (i, j) to a table over coarse bins."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, (cut, table) in enumerate(zip(self.cuts, self.tables)):
            z += table[np.searchsorted(cut, x[:, j], "right")]
        for (i, j), table in self.pairs.items():
            z += table[np.searchsorted(self.coarse[i], x[:, i], "right"),
                       np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _cut(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int, reg: float) -> np.ndarray:
    """Leaf values, per bin, of a depth-limited tree on binned sums."""
    best, gain = 0, 1e-9
    if depth and len(grad) > 1:
        g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
        rg, rh = grad.sum() - g, hess.sum() - h
        gains = g**2 / (h + reg) + rg**2 / (rh + reg) - grad.sum() ** 2 / (hess.sum() + reg)
        best = int(np.argmax(gains)) + 1
        gain = gains[best - 1]
    if not best or gain <= 1e-9:
        return np.full(len(grad), grad.sum() / (hess.sum() + reg))
    return np.concatenate([_tree(grad[:best], hess[:best], depth - 1, reg),
                           _tree(grad[best:], hess[best:], depth - 1, reg)])


def _tree2(grad: np.ndarray, hess: np.ndarray, depth: int, reg: float) -> np.ndarray:
    """The same over a two-dimensional table; each cut is on either axis."""
    def gains(axis):
        g, h = np.cumsum(grad.sum(1 - axis))[:-1], np.cumsum(hess.sum(1 - axis))[:-1]
        return g**2 / (h + reg) + (grad.sum() - g) ** 2 / (hess.sum() - h + reg)
    found = [(float(v.max()), axis, int(v.argmax()) + 1) for axis in (0, 1) if len(v := gains(axis))]
    if not depth or not found:
        return np.full(grad.shape, grad.sum() / (hess.sum() + reg))
    _, axis, at = max(found)
    halves = zip(np.split(grad, [at], axis), np.split(hess, [at], axis))
    return np.concatenate([_tree2(g, h, depth - 1, reg) for g, h in halves], axis)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, pair_rounds: int = 20, n_pairs: int = 8, rate: float = 0.2,
        bins: int = 32, coarse: int = 8, reg: float = 2.0) -> Model:
    """Cyclic boosting of single-feature tables, then of pair tables."""
    share = y.mean() if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Model(float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    d = x.shape[1]
    model = Model(float(np.log(share / (1 - share))), [_cut(x[:, j], bins) for j in range(d)],
                  coarse=[_cut(x[:, j], coarse) for j in range(d)])
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    at = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    z = np.full(len(y), model.base)

    def sums(bin_, n):
        p = 1 / (1 + np.exp(-z))
        return np.bincount(bin_, y - p, n), np.bincount(bin_, p * (1 - p), n)

    for _ in range(rounds):
        for j in range(d):
            step = rate * _tree(*sums(at[j], len(model.tables[j])), 2, reg)
            model.tables[j] += step
            z += step[at[j]]
    rough = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.coarse)]
    shape = [len(c) + 1 for c in model.coarse]
    cells = {(i, j): rough[i] * shape[j] + rough[j] for i in range(d) for j in range(i)}

    def table(pair):
        g, h = sums(cells[pair], shape[pair[0]] * shape[pair[1]])
        return g.reshape(shape[pair[0]], -1), h.reshape(shape[pair[0]], -1)

    def gain(pair):
        g, h = table(pair)
        return float((g**2 / (h + reg)).sum() - (g.sum(0) ** 2 / (h.sum(0) + reg)).sum()
                     - (g.sum(1) ** 2 / (h.sum(1) + reg)).sum())
    for pair in sorted(cells, key=gain, reverse=True)[:n_pairs]:
        model.pairs[pair] = np.zeros((shape[pair[0]], shape[pair[1]]))
    for _ in range(pair_rounds):
        for pair, values in model.pairs.items():
            step = rate * _tree2(*table(pair), 2, reg)
            values += step
            z += step.ravel()[cells[pair]]
    return model


def labelled_sample(rows: DataFrame, labels: DataFrame, label: str, max_train: int) -> DataFrame:
    """``rows`` (with doc_id) and their 0/1 ``y``: at most ``max_train`` labelled rows, the
    smallest by a hash of doc_id."""
    lab = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y")))
    chosen = lab.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(max_train)
    return rows.join(F.broadcast(chosen), "doc_id")  # at most max_train rows of two numbers


def train(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> Model:
    """Fit on the labelled documents."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = labelled_sample(rows, labels, "quality", max_train).select(F.col("y").cast("long"), "text")
    got = rows.mapInArrow(_feature_rows, "y long, x array<double>").orderBy("y", "x").toPandas()
    if not len(got):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.stack(got["x"].to_numpy()), got["y"].to_numpy(float))


def _scores(texts: pa.Array, model: Model) -> np.ndarray:
    parts = [model.score(features(data, offs)) for _, data, offs in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros(0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), model), pa.float64())],
                                             names=["doc_id", "score"])
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, in one pass over them."""
    model = train(docs, labels, max_train)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(at), model) >= threshold))
    return docs.mapInArrow(run, docs.schema)
