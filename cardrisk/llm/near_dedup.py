"""Near-duplicate documents by MinHash bands and odd sketches.

Method.  ``sketch`` gives every document the size of its shingle set, the band
keys of a ``BANDS x ROWS`` MinHash, and an odd sketch: each of the MinHash
samples toggles one bit of a parity bitmap, so that the population
count of the XOR of two bitmaps estimates how many samples differ.  Documents
that share a band key are candidates; the odd sketches and the set sizes drop
the pairs that cannot reach the threshold; what is left is confirmed on the full
shingle sets.  Components of the confirmed links come from min-label rounds.

Scale.  Documents with the same shingle set (128-bit set hash) are one class
before any pairing, so a group of exact copies costs one row.  In a bucket only
stars are emitted first (every member against two centres), and components are
formed; members of *different* components in a bucket are then paired, inside the
join, with an exact overlap bound and a finer odd sketch in its condition.  A bucket
of near copies is thus joined up by linearly many pairs, and no candidate is given up.

Recall.  With 24 bands of 4 rows a pair at similarity 0.8 is missed with
probability (1 - 0.8^4)^24 = 3e-6; the sketch test keeps a true pair unless its
estimate errs by over five standard deviations.

Nulls: a NULL text, an empty text and a text without words have no shingles and
are linked with nothing.  Every row with an id gives one row: repeated rows give
equal rows.  The texts of an id with several texts are nodes of their own, each kept
or not by its own links; their components are joined, so that all rows of an id
have one ``component_id``.  Rows with a NULL id give none.  Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, distinct, listed, mix64, shingles, slices, staged, words

BANDS, ROWS = 24, 4
# Odd sketches: (MinHash samples, bits, most bits in the XOR of a pair).  Of 96
# samples, a pair at 0.8 differs in 19 on average, which sets 33 bits of the XOR
# (deviation 6.5); of 512, in 102, which sets 186 (deviation 16).  Pairs over the
# count, 5.5 deviations more, are dropped.
ROUGH = (BANDS * ROWS, 256, 70)
FINE = (512, 2048, 273)
_SEED = mix64(np.arange(1, FINE[0] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULT = mix64(_SEED + np.uint64(7)) | np.uint64(1)

_SKETCH_SCHEMA = ("doc_id long, n_shingles long, set_a long, set_b long, "
                  "bands array<long>, odd array<long>")


def _sketches(batches: Iterator[pa.RecordBatch], n: int, kind: tuple = ROUGH) -> Iterator[pa.RecordBatch]:
    samples, bits, _ = kind
    for batch in batches:
        ids = batch.column(0)
        for row0, data, offs in slices(batch.column(1)):
            k = len(offs) - 1
            _, _, _, row, wh = words(data, offs)
            rows, sh = distinct(*shingles(wh, row, k, n))
            size = np.bincount(rows, minlength=k)
            used = np.flatnonzero(size)
            begin = np.searchsorted(rows, used)
            a, b = np.zeros(k, np.uint64), np.zeros(k, np.uint64)
            bands = np.zeros((len(used), BANDS), np.uint64)
            odd = np.zeros((len(used), bits // 64), np.uint64)
            if len(used):
                a[used] = np.add.reduceat(mix64(sh ^ np.uint64(0x1234567)), begin)
                b[used] = np.add.reduceat(mix64(sh + np.uint64(0x7654321)), begin)
                at = np.arange(len(used))
                for i in range(samples):
                    low = np.minimum.reduceat((sh ^ _SEED[i]) * _MULT[i], begin)
                    band = i // ROWS
                    if band < BANDS:
                        bands[:, band] = mix64(bands[:, band] + low + np.uint64(band + 1))
                    bit = mix64(low + _SEED[i]) % np.uint64(bits)
                    odd[at, (bit // np.uint64(64)).astype(np.int64)] ^= np.uint64(1) << (bit % np.uint64(64))
            yield pa.RecordBatch.from_arrays([
                ids.slice(row0, k).cast(pa.int64()), pa.array(size.astype(np.int64)),
                pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                listed(bands.view(np.int64).ravel(), np.repeat(used, BANDS), k, pa.int64()),
                listed(odd.view(np.int64).ravel(), np.repeat(used, bits // 64), k, pa.int64()),
            ], names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "odd"])


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for row0, data, offs in slices(batch.column(1)):
            k = len(offs) - 1
            _, _, _, row, wh = words(data, offs)
            rows, sh = distinct(*shingles(wh, row, k, n))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row0, k).cast(pa.int64()), listed(sh.view(np.int64), rows, k, pa.int64())],
                names=["id", "s"])


def sketch(docs: DataFrame, n: int = 5) -> DataFrame:
    """Set size, 128-bit set hash, band keys and odd sketch per document."""
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda it: _sketches(it, n), _SKETCH_SCHEMA)


def shingle_sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, s): the distinct shingle hashes of the documents in ``ids`` (staged, one long)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.join(broadcast_if_small(ids), rows["doc_id"] == ids["id"], "left_semi")
    return rows.mapInArrow(lambda it: _sets(it, n), "id long, s array<long>")


def _confirm(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) whose full shingle sets reach ``percent``; the sizes
    are known, so only the intersection has to be counted."""
    pairs = staged(pairs, "op4-pairs")
    ids = staged(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "op4-ids")
    full = staged(shingle_sets(docs, ids, n), "op4-sets")
    both = (pairs.join(full.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(full.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where((common * (100 + percent)) >= (F.col("na") + F.col("nb")) * percent).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable over ``links``; every node is returned.

    Alternating large-star / small-star rounds; each leaves at most as many links
    as it got, and the number of rounds grows with the logarithm of the longest path.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "op4-edges")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(small.union(low).distinct(), "op4-edges")
        before, state = state, edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
    return nodes.join(edges.select(F.col("u").alias("id"), F.col("v").alias("comp")), "id", "left").select(
        "id", F.coalesce("comp", "id").alias("comp"))


def _may_link(a: str, b: str, percent: int, kind: tuple = ROUGH):
    """Size bound and odd-sketch test of a pair given as two struct prefixes."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    bits = sum((F.bit_count(F.col(f"{a}.odd")[i].bitwiseXOR(F.col(f"{b}.odd")[i])) for i in range(kind[1] // 64)),
               F.lit(0))
    return (small * 100 >= large * percent) & (bits <= kind[2])


def _pairs(rows: DataFrame) -> DataFrame:
    """(a, b, na, nb) of the structs x and y, each pair once."""
    return rows.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"),
                       F.expr("if(x.id < y.id, x.n, y.n)").alias("na"),
                       F.expr("if(x.id < y.id, y.n, x.n)").alias("nb")).distinct()


def _stars(members: DataFrame, percent: int) -> DataFrame:
    """Every member of a bucket against two centres: the smallest id and the
    smallest hash of (id, bucket), which differs from bucket to bucket."""
    side = F.struct("id", "n", "odd")
    centre = members.groupBy("key").agg(F.min_by(side, F.col("id")).alias("c1"),
                                        F.min_by(side, F.xxhash64("id", "key")).alias("c2"))
    centre = centre.select("key", F.explode(F.array("c1", "c2")).alias("x"))
    pair = members.select("key", side.alias("y")).join(centre, "key")
    return _pairs(pair.where("x.id <> y.id").where(_may_link("x", "y", percent)))


def _rest(members: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs of different components that still can link, among the members of
    buckets with more than one component.

    A shingle that only one component has cannot join it to another; the others are
    counted (``m`` of a set).  A pair's overlap is at most its smaller ``m``, which
    leaves out most copies with edits of their own.  The rest get a finer odd sketch,
    and a pair is emitted in its first common bucket only.
    """
    open_ = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    members = staged(members.join(open_.select("key"), "key").select("key", "band", "id", "n", "comp"), "op4-open")
    info = staged(members.select("id", "n", "comp").dropDuplicates(["id"]), "op4-info")
    rows = shingle_sets(docs, info.select("id"), n).join(broadcast_if_small(info), "id")
    rows = staged(rows.select("id", "n", "comp", F.explode("s").alias("s")), "op4-rows")
    crossing = rows.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    info = rows.join(crossing.select("s"), "s").groupBy("id", "n", "comp").agg(F.count("*").alias("m"))
    info = staged(info.where(F.col("m") * 100 >= F.col("n") * percent), "op4-able")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = texts.join(broadcast_if_small(info.select("id")), F.col("doc_id") == F.col("id"), "left_semi")
    fine = texts.mapInArrow(lambda it: _sketches(it, n, FINE), _SKETCH_SCHEMA)
    fine = staged(fine.select(F.col("doc_id").alias("id"), "bands", "odd").dropDuplicates(["id"]).join(info, "id"),
                  "op4-fine")
    side = members.select("key", "band", "id").join(
        fine.select("id", F.struct("id", "n", "m", "comp", "odd", "bands").alias("x")), "id").drop("id")
    mixed = side.groupBy("key").agg(F.min("x.comp").alias("lo"), F.max("x.comp").alias("hi")).where("lo < hi")
    left = side.join(mixed.select("key"), "key")
    right = left.select("key", F.col("x").alias("y"))
    enough = F.expr(f"least(x.m, y.m) * {100 + percent} >= (x.n + y.n) * {percent}")
    first = F.expr("array_position(zip_with(x.bands, y.bands, (p, q) -> p = q), true) = band + 1")
    return _pairs(left.join(right, (left.key == right.key) & F.expr("x.id < y.id and x.comp <> y.comp")
                            & enough & _may_link("x", "y", percent, FINE) & first))


def _classes(docs: DataFrame, sk: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``sk``, the sketches of ``docs``; one text per id."""
    reps = (sk.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
            .agg(F.min("doc_id").alias("id"), F.any_value("bands").alias("bands"), F.any_value("odd").alias("odd")))
    reps = staged(reps.withColumnRenamed("n_shingles", "n"), "op4-reps")
    keys = reps.select("id", F.posexplode("bands").alias("band", "h")).select(
        "id", "band", F.xxhash64("band", "h").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    buckets = staged(keys.join(shared, "key").join(reps.select("id", "n", "odd"), "id"), "op4-buckets")
    nodes = reps.select("id")
    links = staged(_confirm(_stars(buckets, percent), docs, n, percent), "op4-links")
    comp = staged(components(nodes, links), "op4-comp")
    rest = _confirm(_rest(buckets.join(comp, "id"), docs, n, percent), docs, n, percent)
    comp = staged(components(nodes, links.unionByName(rest)), "op4-comp")
    groups = reps.select("set_a", "set_b", F.col("n").alias("n_shingles"), "id").join(comp, "id").drop("id")
    out = sk.select("doc_id", "n_shingles", "set_a", "set_b").join(groups, ["set_a", "set_b", "n_shingles"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))


def _text_hash():
    return F.sha2(F.coalesce(F.concat(F.lit("t"), F.col("text").cast("string")), F.lit("")), 256)


def _keyed(docs: DataFrame, several: DataFrame) -> DataFrame:
    """``docs`` with ``_key``: the id, or a hash of id and text for all but one text of the ids in ``several``."""
    mark = several.select(F.col("doc_id").alias("_id"), F.col("main").alias("_main"))
    rows = docs.join(broadcast_if_small(mark), F.col("doc_id").cast("long") == F.col("_id"), "left")
    own = F.col("_id").isNull() | (_text_hash() == F.col("_main"))
    return rows.withColumn("_key", F.when(own, F.col("doc_id").cast("long")).otherwise(
        F.xxhash64("_id", _text_hash()))).drop("_id", "_main")


def _decided(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Decisions (doc_id, n_shingles, component_id, kept, key), the ids with several texts
    (doc_id, main; None if there are none) and all ids with several rows."""
    sk = staged(sketch(docs, n), "op4-sketch")
    ids = sk.groupBy("doc_id").agg(F.count("*").alias("rows"))
    repeated = staged(ids.where("rows > 1").select("doc_id"), "op4-repeated")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = texts.join(broadcast_if_small(repeated), "doc_id", "left_semi").select("doc_id", _text_hash().alias("t"))
    several = texts.groupBy("doc_id").agg(F.min("t").alias("main"), F.max("t").alias("last"))
    several = staged(several.where("main < last").select("doc_id", "main"), "op4-several")
    if several.isEmpty():
        got = _classes(docs, sk, n, percent)
        return (got.withColumn("kept", F.col("doc_id") == F.col("component_id")).withColumn("key", F.col("doc_id")),
                None, repeated)
    keyed = _keyed(docs, several).select(F.col("doc_id").cast("long").alias("_id"), F.col("_key").alias("doc_id"), "text")
    key = keyed.where("doc_id is not null").select(F.col("doc_id").alias("key"), "_id").distinct()
    got = _classes(keyed, staged(sketch(keyed, n), "op4-sketch"), n, percent)
    got = staged(got.withColumnRenamed("doc_id", "key").join(key, "key"), "op4-texts")
    # The text that stays is the one of the smallest id; then one component for all texts of an id.
    first = got.groupBy("component_id").agg(F.min(F.struct("_id", "key")).alias("first"))
    got = got.join(first, "component_id").select("_id", "n_shingles", "key", "first")
    links = got.select(F.col("_id").alias("a"), F.col("first._id").alias("b"))
    comp = components(links.select(F.col("a").alias("id")).distinct(), links.where("a <> b"))
    out = got.join(comp, F.col("_id") == F.col("id")).select(
        F.col("_id").alias("doc_id"), "n_shingles", F.col("comp").alias("component_id"),
        (F.col("key") == F.col("first.key")).alias("kept"), "key")
    return out, several, repeated


def classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document.

    Links: ``100 * |A n B| >= percent * |A u B|`` on ``n``-word shingle sets.
    """
    return _decided(docs, n, percent)[0].drop("kept", "key")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document with its class and whether its text is the one that stays."""
    return _decided(docs, n, percent)[0].drop("key")


def _copies_before(docs: DataFrame, before: DataFrame, n: int, percent: int) -> DataFrame:
    """(_copy) ids of the documents that are later members of a class by their texts in
    ``before``; only ids with one row on both sides have such a text."""
    def single(df: DataFrame, name: str) -> DataFrame:
        rows = df.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), _text_hash().alias("t"))
        return rows.groupBy("id").agg(F.count("*").alias("rows"), F.min("t").alias(name)).where("rows = 1").drop("rows")

    changed = single(docs, "now").join(single(before, "then"), "id").where("now <> then").select("id")
    changed = broadcast_if_small(staged(changed, "op4-changed"))
    texts = [df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             for df in (docs, before)]
    own, earlier = (df.join(changed, df["doc_id"] == changed["id"], how)
                    for df, how in zip(texts, ("left_anti", "left_semi")))
    got, _, repeated = _decided(own.unionByName(earlier), n, percent)
    copies = got.where("not kept").select("doc_id").join(repeated, "doc_id", "left_anti").distinct()
    return broadcast_if_small(staged(copies.withColumnRenamed("doc_id", "_copy"), "op4-copies"))


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, before: DataFrame | None = None) -> DataFrame:
    """The documents without the later members of each class; of rows with equal
    ids and texts one stays, rows with a NULL id are kept as they are.

    ``before`` (doc_id, text): the documents as they were before an earlier stage cut their
    texts.  They are then decided twice, first with the earlier texts, and what is left with
    their own: cutting the lines that copies share leaves stubs that no longer look like
    copies.  Ids that repeat, or that ``before`` lacks, have their own text only; repeated
    ids are left to the second decision.
    """
    names = docs.columns
    docs = docs.toDF(*[c if c in ("doc_id", "text") else f"in{i}" for i, c in enumerate(names)])  # no clashes
    if before is not None:
        docs = docs.join(_copies_before(docs, before, n, percent), F.col("doc_id").cast("long") == F.col("_copy"), "left_anti")
    got, several, repeated = _decided(docs, n, percent)
    gone = got.where("not kept").select(F.col("key").alias("_key")).distinct()
    rows = docs.withColumn("_key", F.col("doc_id").cast("long")) if several is None else _keyed(docs, several)
    left = rows.join(gone, "_key", "left_anti")
    if repeated.isEmpty():
        return left.select(*docs.columns).toDF(*names)
    again = broadcast_if_small(repeated.select(F.col("doc_id").alias("_again")))
    same = F.col("doc_id").cast("long") == F.col("_again")
    more = left.join(again, same, "left_semi").dropDuplicates(["_key"])
    return left.join(again, same, "left_anti").unionByName(more).select(*docs.columns).toDF(*names)
