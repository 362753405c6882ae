"""Toxicity scores from a lexicon, with misspellings and context.

Method.  The lexicon are the words that training documents labelled toxic use far
more often than the others.  Near copies (5-word shingles, 0.8) count as one document
on both sides, so that copies of one toxic document do not make all of its words
terms.  A lexicon trie is intersected with the Levenshtein
automaton of a text word (its states are the rows of the edit table, and a subtree
is left as soon as no state is within the allowed edits), so misspelled terms are
found: one edit for terms of ``FUZZY`` letters or more, two from ``FUZZY_TWO`` on; a
transposition is one edit.  Letters are code points.  Every hit looks at a window of words around
it: quotation marks that open before and close after it, or a reporting verb, mark
quotation; a second-person word marks abuse.  Sums of the terms' log odds, kept
apart for plain, quoted, misspelled and addressed hits, feed a logistic model.

Scale.  Lexicon and weights are fitted on at most ``max_train`` labelled rows (the
smallest by a hash of doc_id).  Scoring is one narrow pass over whole texts: numpy
sorts out the few words that need the automaton.  A word within k edits of a term
(transpositions too) shares with it what is left after at most k letters are taken
out of each, so the words' deletions are looked up in an index of the terms': its
cost grows with a word's length, not with the number of terms, and no hit is lost.

NULL and empty texts have no hits and get the model's base score.  Labels other
than 0 and 1 are ignored; a document with several labels takes the greatest.
Without toxic labels the lexicon is empty and all scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, slices, span_hashes, spans
from .language import fold
from .near_dedup import classes as near_classes
from .quality import labelled_sample

FUZZY, FUZZY_TWO = 4, 8
WINDOW = 8
MIN_TOXIC = 4  # a term's toxic documents, copies counted once
MIN_LOG_ODDS = 2.5  # less one standard error
CACHE = 1 << 19
# Fixed cue words (lower case): reporting verbs and second-person words.
REPORTING = ("said", "says", "called", "quote", "quoted", "wrote", "dit", "sagte", "dijo")
SECOND = ("you", "your", "youre", "yourself", "du", "dich", "tu", "vous", "usted")

_WORD = np.zeros(256, bool)  # letters, digits, non-ASCII bytes and signs used in place of letters
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_ALNUM = _WORD.copy()
_WORD[[ord(c) for c in "@$*!"]] = True
_QUOTE = ord('"')


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes and (start, end, row) of words, without signs at their ends."""
    low = fold(data)
    start, end, row = spans(low, offs, ~_WORD[low])
    if not len(start):
        return low, start, end, row
    n = len(low)
    at = np.arange(n)
    after = np.minimum.accumulate(np.where(_ALNUM[low], at, n)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(_ALNUM[low], at, -1))
    start, end = after[start], before[end - 1] + 1
    ok = start < end
    return low, start[ok], end[ok], row[ok]


class Trie:
    """Lexicon trie over characters; ``find`` intersects it with a Levenshtein automaton."""

    def __init__(self, terms: list[str]):
        self.root: dict = {}
        for i, term in enumerate(terms):
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = i

    def find(self, word: str, edits: int, swaps: bool = False) -> list[tuple[int, int]]:
        """(distance, term) of all terms within ``edits`` of ``word``, nearest first;
        with ``swaps`` a transposition of two neighbours is one edit."""
        out: list[tuple[int, int]] = []
        first = list(range(len(word) + 1))
        stack = [(self.root, first, first, "")]
        while stack:
            node, row, above, last = stack.pop()
            for c, child in node.items():
                if c == "":
                    if row[-1] <= edits:
                        out.append((row[-1], child))
                    continue
                new = [row[0] + 1]
                for j, x in enumerate(word):
                    new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != c)))
                    if swaps and j and x == last and word[j - 1] == c:
                        new[-1] = min(new[-1], above[j - 1] + 1)
                if min(new) <= edits or (swaps and min(row) < edits):
                    stack.append((child, new, row, c))
        return sorted(out)


def allowed(length: int) -> int:
    """Edits in a term of so many code points."""
    return (length >= FUZZY) + (length >= FUZZY_TWO)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def _deletions(words: list[str], edits: int) -> Iterator[np.ndarray]:
    """Hashes of the words (of one length) with up to ``edits`` code points taken out."""
    n = len(words[0])
    codes = np.array(words, dtype=f"U{n}").view(np.uint32).reshape(-1, n).astype(np.uint64)
    power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, _STEP)])
    sums = []  # of the letters after 0, 1, 2 deletions
    for k in range(edits + 1):
        part = np.zeros((len(words), n + 1), np.uint64)
        np.cumsum(mix64(codes + np.uint64(1)) * power[np.maximum(np.arange(n) - k, 0)], axis=1, out=part[:, 1:])
        sums.append(part)
    yield mix64(sums[0][:, n] + np.uint64(n))
    for i in range(n if edits else 0):
        head = sums[0][:, i]
        yield mix64(head + sums[1][:, n] - sums[1][:, i + 1] + np.uint64(n - 1))
        for j in range(i + 1, n if edits > 1 else 0):
            yield mix64(head + sums[1][:, j] - sums[1][:, i + 1] + sums[2][:, n] - sums[2][:, j + 1] + np.uint64(n - 2))


class Finder:
    """Hits of a lexicon in slices of texts."""

    def __init__(self, terms: list[str]):
        self.trie = Trie(terms)
        self.allowed = [allowed(len(t)) for t in terms]
        by_length: dict[int, list[str]] = {}
        self.reach: dict[int, int] = {}  # by length of a word, the edits that a term may allow it
        for t, k in zip(terms, self.allowed):
            by_length.setdefault(len(t), []).append(t)
            for n in range(len(t) - k, len(t) + k + 1):
                self.reach[n] = max(k, self.reach.get(n, 0))
        parts = [v for n, ts in by_length.items() for v in _deletions(ts, allowed(n))]
        self.index = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        self.cache: dict[int, tuple[int, int] | None] = {}  # by word hash

    def _near(self, words: list[str], edits: int) -> np.ndarray:
        hit = np.zeros(len(words), bool)
        for v in _deletions(words, edits):
            hit |= self.index[np.minimum(np.searchsorted(self.index, v), len(self.index) - 1)] == v
        return hit

    def _learn(self, hashes: list[int], words: list[bytes]) -> None:
        """Put the nearest term of each word in the cache."""
        groups: dict[int, list[tuple[int, str]]] = {}
        for h, w in zip(hashes, words):
            text = w.decode("utf-8", "replace")
            self.cache[h] = None
            if len(text) in self.reach:
                groups.setdefault(len(text), []).append((h, text))
        for n, group in groups.items():
            for at in range(0, len(group), 1 << 14):
                part = group[at:at + (1 << 14)]
                for i in np.flatnonzero(self._near([t for _, t in part], self.reach[n])):
                    found = self.trie.find(part[i][1], self.reach[n], swaps=True)
                    found = [x for x in found if x[0] <= self.allowed[x[1]]]
                    self.cache[part[i][0]] = found[0] if found else None

    def hits(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """(row, term, misspelled, quoted, addressed) of the hits of a slice, by row."""
        low, start, end, row = tokens(data, offs)
        if not self.reach or not len(start):
            return np.zeros((0, 5), np.int64)
        known, first, at = np.unique(span_hashes(low, start, end), return_index=True, return_inverse=True)
        raw = low.tobytes()
        if len(self.cache) >= CACHE:
            self.cache.clear()
        new = [(h, i) for h, i in zip(known.tolist(), first.tolist()) if h not in self.cache]
        self._learn([h for h, _ in new], [raw[start[i]:end[i]] for _, i in new])
        nearest = [self.cache[h] for h in known.tolist()]
        may = np.array([x is not None for x in nearest])[at]
        out = []
        marks = np.cumsum(np.r_[0, low == _QUOTE]) if may.any() else None
        for i in np.flatnonzero(may):
            found = nearest[at[i]]
            lo, hi = max(0, i - WINDOW), min(len(start) - 1, i + WINDOW)
            lo += int(np.searchsorted(row[lo:i], row[i]))
            hi = i + int(np.searchsorted(row[i:hi + 1], row[i], "right")) - 1
            around = [raw[start[j]:end[j]].decode("utf-8", "replace") for j in range(lo, hi + 1) if j != i]
            begin = marks[start[i]] - marks[offs[row[i]]]
            inside = begin % 2 == 1 and marks[end[hi]] > marks[end[i]]
            quoted = bool(inside) or any(w in REPORTING for w in around)
            out.append((int(row[i]), found[1], int(found[0] > 0), quoted, any(w in SECOND for w in around)))
        return np.array(out, dtype=np.int64).reshape(-1, 5)


@dataclass
class Model:
    """Lexicon, log odds per (term, misspelled), and the logistic weights."""

    terms: list[str]
    odds: np.ndarray
    weights: np.ndarray

    def columns(self, hits: np.ndarray, k: int) -> np.ndarray:
        """(k, 7) document features: summed and greatest odds by kind of hit."""
        x = np.zeros((k, 7))
        x[:, 0] = 1
        if len(hits):
            row, term, wrong, quoted, second = hits.T
            value = np.maximum(self.odds[term, wrong], 0)
            for c, kind in ((1, (quoted == 0) & (wrong == 0)), (2, (quoted == 0) & (wrong == 1)), (3, quoted == 1),
                            (4, second == 1)):
                x[:, c] = np.minimum(np.bincount(row[kind], value[kind], k), 12) / 4
            np.maximum.at(x[:, 5], row, np.where(quoted == 0, value, 0) / 4)
            x[:, 6] = np.bincount(row, minlength=k) > 0
        return x

    def score(self, hits: np.ndarray, k: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.columns(hits, k) @ self.weights, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    reg = np.full(x.shape[1], ridge)
    reg[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(reg), x.T @ (y - p) - reg * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, y, class) of each distinct word of a document."""
    for batch in batches:
        y, kind = np.array(batch.column(1)).astype(np.int64), np.array(batch.column(2)).astype(np.int64)
        for row0, data, offs in slices(batch.column(0)):
            low, start, end, row = tokens(data, offs)
            wh = span_hashes(low, start, end)
            order = np.lexsort((start, wh, row))
            r, h = row[order], wh[order]
            first = order[np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])]] if len(order) else order
            raw = low.tobytes()
            words = [raw[start[i]:end[i]].decode("utf-8", "replace") for i in first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(y[row0 + row[first]]), pa.array(kind[row0 + row[first]])],
                names=["word", "y", "class"])


def _hit_rows(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms)
        for batch in batches:
            for row0, data, offs in slices(batch.column(1)):
                hits = finder.hits(data, offs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row0 + hits[:, 0])).cast(pa.int64()),
                     *[pa.array(hits[:, c]) for c in range(1, 5)]],
                    names=["doc_id", "term", "wrong", "quoted", "second"])
    return run


def train(docs: DataFrame, labels: DataFrame, max_train: int = 10_000) -> Model:
    """Lexicon, odds and weights from the labelled documents."""
    rows = labelled_sample(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), labels, "toxic",
                           max_train).persist()
    try:
        y = rows.select("doc_id", "y").orderBy("doc_id").toPandas()
        toxic, other = float((y["y"] == 1).sum()), float((y["y"] == 0).sum())
        classes = near_classes(rows.select("doc_id", "text")).groupBy("doc_id").agg(F.min("component_id").alias("class"))
        single = rows.join(classes, "doc_id").select("text", F.col("y").cast("long").alias("y"), "class").persist()
        n_classes = dict(single.groupBy("y").agg(F.count_distinct("class")).collect())  # two rows
        n_toxic, n_other = float(n_classes.get(1, 0)), float(n_classes.get(0, 0))
        words = single.mapInArrow(_words, "word string, y long, class long").groupBy("word", "y").agg(
            F.count_distinct("class").alias("n"))
        words = words.groupBy("word").agg(F.sum(F.col("n") * F.col("y")).alias("a"),
                                          F.sum(F.col("n") * (1 - F.col("y"))).alias("b"))
        odds = F.log((F.col("a") + 0.1) / (n_toxic + 0.2)) - F.log((F.col("b") + 0.1) / (n_other + 0.2))
        sure = odds - F.sqrt(1 / (F.col("a") + 0.1) + 1 / (F.col("b") + 0.5))
        found = words.where((F.col("a") >= MIN_TOXIC) & (sure >= MIN_LOG_ODDS)
                            & (F.char_length("word") > 2)).select("word").orderBy("word").toPandas()
        terms = found["word"].tolist()
        single.unpersist()
        hits = rows.select("doc_id", "text").mapInArrow(
            _hit_rows(terms), "doc_id long, term long, wrong long, quoted long, second long").toPandas()
    finally:
        rows.unpersist()
    at = {int(d): i for i, d in enumerate(y["doc_id"])}
    label = y["y"].to_numpy(float)
    table = np.column_stack([hits["doc_id"].map(at).to_numpy(int).reshape(-1)] + [
        hits[c].to_numpy(int) for c in ("term", "wrong", "quoted", "second")]).astype(int) if len(hits) else np.zeros((0, 5), int)
    a, b = np.zeros((len(terms), 2)), np.zeros((len(terms), 2))
    for row, term, wrong in {tuple(r) for r in table[:, :3].tolist()}:
        (a if label[row] else b)[term, wrong] += 1
    log_odds = np.log((a + 0.2) / (toxic + 0.4)) - np.log((b + 0.2) / (other + 0.4))
    log_odds[(a + b) == 0] = 1.0
    model = Model(terms, log_odds, np.array([-30.0, 0, 0, 0, 0, 0, 0]))
    if toxic and other:
        model.weights = _logistic(model.columns(table, len(label)), label)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_hits, terms) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model.terms)
        for batch in batches:
            for row0, data, offs in slices(batch.column(1)):
                k = len(offs) - 1
                hits = finder.hits(data, offs)
                cut = np.searchsorted(hits[:, 0], np.arange(k + 1))
                names = [sorted({model.terms[t] for t in hits[cut[i]:cut[i + 1], 1]}) for i in range(k)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row0, k).cast(pa.int64()), pa.array(model.score(hits, k)),
                    pa.array(np.diff(cut).astype(np.int64)), pa.array(names, pa.list_(pa.string()))],
                    names=["doc_id", "score", "n_hits", "terms"])
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, score double, n_hits long, terms array<string>")
