"""Jaccard self-join of documents on word n-grams by PartEnum signatures.

Method.  Sets are put into size bands ``[l, floor(100 l / percent)]``, so that two
sets that link lie in one band or in neighbouring ones.  Within a band the
similarity bound is a bound ``k`` on the size of the symmetric difference.  The
domain of shingle hashes is partitioned into ``floor(k/2) + 1`` parts, of which one
holds at most one differing element; that part is cut into ``CELLS`` cells, and
every subset that leaves one cell out is enumerated.  A signature is the hash of a
set's elements in such a subset: two sets within ``k`` agree in at least one.  A set
signs for its own band and for the next, so no link is lost, whatever the data.

Scale.  Documents with equal sets are one node before anything is signed.  The
signatures are shuffled once; those that only one set has end there.  In a bucket
every member is first paired with the smallest node only, which gives linearly many
pairs and the components; then members of *different* components are paired, in
blocks of ``BLOCK`` members, so that a large bucket is spread over many tasks.
Buckets with the same members are paired once.  A pair must pass two exact tests
before its full sets are compared: the size bound, and the population count of the
XOR of two parity bitmaps of the whole sets, which is never above the size of the
symmetric difference.

Nulls: a NULL text, an empty text and a text without words have no shingles and are
linked with nothing.  Every row with an id gives one row, repeated rows equal ones.
An id with several texts has the links of each, its rows one ``component_id`` and
each its own size.  Rows with a NULL id give none.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, distinct, listed, mix64, shingles, slices, staged, words
from .near_dedup import components, shingle_sets

CELLS = 4
PARITY_WORDS = 32
BLOCK = 512
_U = np.uint64


def size_bands(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest set size of each band, up to a band above ``largest``."""
    low, high = [1], [100 // percent]
    while low[-1] <= largest:
        low.append(high[-1] + 1)
        high.append(low[-1] * 100 // percent)
    return np.array(low, np.int64), np.array(high, np.int64)


def signatures(rows: np.ndarray, sh: np.ndarray, n_rows: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of the distinct shingle hashes ``sh``, ordered by row."""
    size = np.bincount(rows, minlength=n_rows)
    low, high = size_bands(percent, int(size.max(initial=0)))
    own = np.searchsorted(low, size, "right") - 1
    place, value = mix64(sh ^ _U(0x51ED270B)), mix64(sh + _U(0x2545F491))
    out_rows, out = [], []
    for step in (0, 1):
        band = np.minimum(own + step, len(low) - 1)
        differ = 2 * high[band] * (100 - percent) // (100 + percent)
        parts = differ // 2 + 1
        # equal sets are one node already; the next band matters only to sets that reach it
        signs = (size > 0) & (differ > 0) & (100 * size >= percent * low[band]) & (own + step < len(low))
        parts = np.where(signs, parts, 0)
        base = np.concatenate([[0], np.cumsum(parts)])
        mine = signs[rows]
        r = rows[mine]
        part = ((place[mine] >> _U(34)) % parts[r].astype(np.uint64)).astype(np.int64)
        cell = ((place[mine] >> _U(32)) % _U(CELLS)).astype(np.int64)
        sums = np.zeros(base[-1] * CELLS, np.uint64)
        np.add.at(sums, (base[r] + part) * CELLS + cell, value[mine])
        sums = sums.reshape(-1, CELLS)
        of = np.repeat(np.arange(n_rows), parts)
        number = np.arange(base[-1]) - base[of]
        where = ((band[of] << 40) + (number << 4)).astype(np.uint64)
        rest = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums
        out.append(mix64(rest + mix64(where[:, None] + np.arange(CELLS, dtype=np.uint64))).ravel())
        out_rows.append(np.repeat(of, CELLS))
    rows, out = np.concatenate(out_rows), np.concatenate(out)
    order = np.argsort(rows, kind="stable")
    return rows[order], out[order]


def _summaries(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for row0, data, offs in slices(batch.column(1)):
            k = len(offs) - 1
            _, _, _, row, wh = words(data, offs)
            rows, sh = distinct(*shingles(wh, row, k, n))
            a, b = np.zeros(k, np.uint64), np.zeros(k, np.uint64)
            np.add.at(a, rows, mix64(sh ^ _U(0x7F4A7C15)))
            np.add.at(b, rows, mix64(sh + _U(0x1CE4E5B9)))
            bit = mix64(sh ^ _U(0x133111EB)) % _U(PARITY_WORDS * 64)
            odd = np.zeros(k * PARITY_WORDS, np.uint64)
            at = rows * PARITY_WORDS + (bit >> _U(6)).astype(np.int64)
            np.bitwise_xor.at(odd, at, _U(1) << (bit & _U(63)))
            every = np.repeat(np.arange(k), PARITY_WORDS)
            yield pa.RecordBatch.from_arrays([
                ids.slice(row0, k).cast(pa.int64()), pa.array(np.bincount(rows, minlength=k).astype(np.int64)),
                pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                listed(odd.view(np.int64), every, k, pa.int64()),
            ], names=["id", "n", "set_a", "set_b", "odd"])


def _signed(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for row0, data, offs in slices(batch.column(1)):
            k = len(offs) - 1
            _, _, _, row, wh = words(data, offs)
            rows, sig = signatures(*distinct(*shingles(wh, row, k, n)), k, percent)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row0, k).cast(pa.int64()), listed(sig.view(np.int64), rows, k, pa.int64())],
                names=["id", "keys"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _may_link(percent: int):
    """Exact tests on structs x and y (n, odd): no pair that links fails them."""
    bits = F.aggregate(F.zip_with("x.odd", "y.odd", lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                       F.lit(0), lambda s, v: s + v)
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    return (small * 100 >= large * percent) & (bits * (100 + percent) <= (small + large) * (100 - percent))


def _confirm(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose whole shingle sets reach ``percent``."""
    ids = staged(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "op11-ids")
    full = staged(shingle_sets(docs, ids, n), "op11-sets")
    both = (pairs.join(full.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(full.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b")


def _stars(buckets: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Every member of a bucket with the smallest one, each pair once."""
    pairs = buckets.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    pairs = pairs.join(info.select(F.col("id").alias("a"), F.struct("n", "odd").alias("x")), "a")
    pairs = pairs.join(info.select(F.col("id").alias("b"), F.struct("n", "odd").alias("y")), "b")
    return pairs.where(_may_link(percent)).select("a", "b", F.col("x.n").alias("na"), F.col("y.n").alias("nb"))


def _crossing(buckets: DataFrame, comp: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a bucket, each once."""
    members = buckets.select("key", "id").join(comp, "id")
    mark = F.xxhash64("id").cast("decimal(20,0)")
    open_ = (members.groupBy("key")
             .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members"),
                  F.sum(mark).alias("sum"), F.bit_xor(F.xxhash64("id", F.lit(5))).alias("xor"))
             .where("lo < hi"))
    # of buckets with the same members one is enough
    once = staged(open_.groupBy("members", "sum", "xor").agg(F.min("key").alias("key"))
                  .select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "op11-open")
    members = members.join(once, "key").join(info, "id")
    side = staged(members.select("key", "blocks", F.struct("id", "comp", "n", "odd").alias("x")), "op11-members")
    left = side.withColumn("block", F.pmod(F.xxhash64("x.id"), F.col("blocks")).cast("int")).drop("blocks")
    right = side.select("key", F.col("x").alias("y"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    got = left.join(right, ["key", "block"]).where(F.expr("x.id < y.id and x.comp <> y.comp") & _may_link(percent))
    return got.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.n").alias("na"),
                      F.col("y.n").alias("nb")).distinct()


def _joined(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(id, n, comp) for every row of ``docs`` (doc_id, text), whose ids have one text each."""
    rows = staged(docs.where("doc_id is not null").mapInArrow(
        lambda it: _summaries(it, n), "id long, n long, set_a long, set_b long, odd array<long>"), "op11-sets")
    nodes = staged(rows.where("n > 0").groupBy("set_a", "set_b", "n")
                   .agg(F.min("id").alias("node"), F.any_value("odd").alias("odd")), "op11-nodes")
    info = nodes.select(F.col("node").alias("id"), "n", "odd")
    ids = nodes.select(F.col("node").alias("id"))
    signed = docs.join(broadcast_if_small(ids), F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(
        lambda it: _signed(it, n, percent), "id long, keys array<long>")
    same = Window.partitionBy("key")
    buckets = signed.select("id", F.explode("keys").alias("key")).select(
        "key", "id", F.min("id").over(same).alias("centre"), F.max("id").over(same).alias("last"))
    buckets = staged(buckets.where("centre < last").drop("last"), "op11-buckets")
    links = staged(_confirm(staged(_stars(buckets, info, percent), "op11-stars"), docs, n, percent), "op11-links")
    comp = staged(components(ids, links), "op11-comp")
    rest = staged(_crossing(buckets, comp, info, percent), "op11-crossing")
    comp = staged(components(ids, links.unionByName(_confirm(rest, docs, n, percent))), "op11-comp")
    found = nodes.select("set_a", "set_b", "n", F.col("node").alias("id")).join(comp, "id").drop("id")
    return rows.select("id", "n", "set_a", "set_b").join(found, ["set_a", "set_b", "n"], "left").select(
        "id", "n", F.coalesce("comp", "id").alias("comp"))


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document with an id.

    Documents link when ``100 * |A n B| >= percent * |A u B|`` for their sets of
    ``n``-word shingles; ``component_id`` is the smallest doc_id reachable by links.
    """
    docs = _texts(docs).where("doc_id is not null")
    mark = F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())
    several = staged(docs.select("doc_id", mark.alias("t")).groupBy("doc_id")
                     .agg(F.min("t").alias("main"), F.max("t").alias("last")).where("main < last"), "op11-several")
    if several.isEmpty():
        got = _joined(docs, n, percent)
        return got.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                          F.col("comp").alias("component_id"))
    # every further text of an id is a node of its own; the id's texts are joined afterwards
    keyed = docs.join(broadcast_if_small(several.select("doc_id", "main")), "doc_id", "left").select(
        "doc_id", "text", F.when(F.col("main").isNull() | (mark == F.col("main")), F.col("doc_id"))
        .otherwise(F.xxhash64("doc_id", mark)).alias("key"))
    got = _joined(keyed.select(F.col("key").alias("doc_id"), "text"), n, percent).withColumnRenamed("id", "key")
    of = staged(keyed.select("key", F.col("doc_id").alias("id")).distinct(), "op11-keys")
    got = staged(got.join(of, "key"), "op11-texts")
    first = got.groupBy("comp").agg(F.min("id").alias("first"))
    got = got.join(first, "comp").select("id", "n", "first")
    comp = components(got.select("id").distinct(),
                      got.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")))
    return got.join(comp, "id").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                       F.col("comp").alias("component_id"))
