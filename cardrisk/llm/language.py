"""Language identification as inference of a multilingual mixture.

Method.  Every language is a distribution over byte trigrams (hashed to
``BUCKETS`` buckets, add-alpha smoothed).  A document is a mixture: expectation-
maximisation estimates its language proportions from the trigrams' likelihoods.
The language set is the one of the prefixes of the languages ordered by proportion
that has the greatest penalised likelihood (half the logarithm of the trigram
count for each further language).  The prediction is the set's largest language.

Scale.  Training counts all labelled training rows: each task adds them up in
arrays and emits one row per language and used bucket, which are summed by key.
The model has languages x BUCKETS numbers, whatever the input.  Prediction is one
narrow pass over whole texts.

Texts are lower-cased (ASCII and Latin-1), other bytes than letters become one
blank.  ``und`` with score 0: NULL text, a text without letters, or no learned
language.  Rows with a NULL lang are not learned from; every row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, mix64, slices

BUCKETS = 1 << 16
ALPHA = 0.5
ROUNDS = 10


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes (ASCII, and Latin-1 letters in UTF-8)."""
    low = LOWER[data]
    if len(low) > 1:
        upper = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
        low[1:][upper] += 32
    return low


_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


def trigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the trigrams of letters and single blanks, within a row."""
    low = fold(data)
    ok = _LETTER[low]
    low = np.where(ok, low, 32)
    keep = ok.copy()
    keep[1:] |= ok[:-1]  # the first blank after a letter
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[keep]
    b = low[keep].astype(np.uint64)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]
    same = row[:-2] == row[2:]
    return row[:-2][same], (mix64(code[same]) % np.uint64(BUCKETS)).astype(np.int64)


def has_letter(texts: pa.Array, row0: int, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without ASCII letters are looked at one by one."""
    low = LOWER[data]
    total = np.r_[0, np.cumsum((low >= 97) & (low <= 122))]
    found = total[offs[1:]] > total[offs[:-1]]
    for i in np.flatnonzero(~found & (offs[1:] > offs[:-1])):
        found[i] = any(c.isalpha() for c in texts[row0 + int(i)].as_py())
    return found


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for row0, data, offs in slices(batch.column(0)):
            row, bucket = trigrams(data, offs)
            mine = langs[row0:row0 + len(offs) - 1]
            for lang in set(mine):
                at = (mine == lang)[row]
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += np.bincount(bucket[at], minlength=BUCKETS)
    for lang, total in sums.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()),
                                          pa.array(total[used], pa.int64())], names=["lang", "bucket", "n"])
        if not len(used):  # a language of texts without trigrams is still a learned one
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int64()), pa.array([0], pa.int64())],
                                             names=["lang", "bucket", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [BUCKETS, languages]) from text and lang."""
    rows = docs.where("lang is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    counts = rows.mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toPandas()  # languages x BUCKETS rows at most
    langs = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS, len(langs)))
    table[counts["bucket"].to_numpy(int), counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int)] = counts["n"]
    return langs, np.log((table + ALPHA) / (table.sum(0) + ALPHA * BUCKETS))


def mixtures(row: np.ndarray, bucket: np.ndarray, k: int, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions [k, languages], members of the chosen set [k, languages])."""
    n_lang = logp.shape[1]
    theta = np.full((k, n_lang), 1 / n_lang)
    chosen = np.zeros((k, n_lang), bool)
    if not len(row):
        return theta, chosen
    key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    r, b = key // BUCKETS, key % BUCKETS
    begin = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    docs = r[begin]
    group = np.repeat(np.arange(len(docs)), np.diff(np.r_[begin, len(r)]))
    lp = logp[b]
    peak = lp.max(1)
    lik = np.exp(lp - peak[:, None])
    total = np.add.reduceat(count, begin).astype(float)

    def em(t, rounds):
        for _ in range(rounds):
            share = lik * t[group]
            share *= (count / np.maximum(share.sum(1), 1e-300))[:, None]
            t = np.add.reduceat(share, begin) / total[:, None]
        return t

    def loglik(t):
        return np.add.reduceat(count * np.log(np.maximum((lik * t[group]).sum(1), 1e-300)), begin)
    full = em(np.full((len(docs), n_lang), 1 / n_lang), ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    best = np.full(len(docs), -np.inf)
    out, members = full.copy(), np.zeros((len(docs), n_lang), bool)
    for size in range(1, n_lang + 1):
        inside = rank < size
        t = np.where(inside, full + 1e-9, 0)
        t /= t.sum(1, keepdims=True)
        if size > 1:
            t = em(t, 3)
        value = loglik(t) - 0.5 * (size - 1) * np.log(total)
        better = value > best
        out[better], members[better] = t[better], inside[better]
        best = np.maximum(best, value)
        if not better.any():  # one more language raised no document's penalised likelihood
            break
    theta[docs], chosen[docs] = out, members
    return theta, chosen


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score, lang_set, lang_shares) of every row."""
    langs, logp = model
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(logp.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        names = np.array([*langs, "und"], object)
        for batch in batches:
            texts = batch.column(1)
            for row0, data, offs in slices(texts):
                k = len(offs) - 1
                letters = has_letter(texts, row0, data, offs)
                if langs:
                    theta, chosen = mixtures(*trigrams(data, offs), k, table)
                    top = np.where(letters, theta.argmax(1), len(langs))
                    score = np.where(letters, theta.max(1), 0.0)
                else:
                    theta, chosen = np.zeros((k, 0)), np.zeros((k, 0), bool)
                    top, score = np.zeros(k, int), np.zeros(k)
                sets, shares = [], []
                for i in range(k):
                    at = np.flatnonzero(chosen[i]) if letters[i] and langs else []
                    sets.append([langs[j] for j in at])
                    shares.append([float(theta[i, j]) for j in at])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row0, k).cast(pa.int64()), pa.array(names[top].tolist(), pa.string()),
                    pa.array(np.clip(score, 0, 1), pa.float64()), pa.array(sets, pa.list_(pa.string())),
                    pa.array(shares, pa.list_(pa.float64()))],
                    names=["doc_id", "lang_pred", "score", "lang_set", "lang_shares"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, lang_set array<string>, "
                                "lang_shares array<double>")
