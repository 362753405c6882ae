"""Benchmark decontamination: size-partitioned MinHash containment search.

Method.  Items are partitioned by the size of their shingle set into powers of
two.  An item is sketched by its k smallest shingle hashes (a bottom-k MinHash),
where k follows from its partition's upper size u: ``k = u - ceil(t*u) + 1``.  A
document that contains a share t of an item's shingles misses fewer than k of
them, so it holds at least one of the k sketched ones: looking the sketches up
in whole documents finds every container, however long the document, and the
sketch is short for short items.  The pairs found are verified by counting the
item's shingles in the whole document.

Scale.  One narrow pass over the documents looks up the sketches (a broadcast
when a count proves them few, else a shuffle join); a second pass reads only the
documents of candidate pairs.  Counts are pre-aggregated per task.  All native.

Words are maximal runs of letters and digits, lower-cased.  An item of fewer than
``n`` words is one shingle, its whole word sequence, and documents are also cut into shingles
of the word counts that such items have.  NULL or empty texts and texts without words match
nothing.  Each text is searched for itself: rows of one id are not pooled.  Pairs need
ids, so rows with NULL ids give none; ``drop_contaminated`` decides by the text alone and
drops such rows too.  Repeated rows count as one pair, and go or stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged


def word_hashes(text: Column) -> Column:
    """Array of word hashes of a text ('' and NULL: empty)."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    parts = F.filter(F.split(plain, " "), lambda x: x != "")
    return F.transform(parts, lambda x: F.xxhash64(x))


def shingle_rows(rows: DataFrame, keys: list[str], n: int, short: list[int] | None = None) -> DataFrame:
    """(keys, s): the hash of every ``n``-word shingle, repeated as in the text.  With ``short`` also
    those of the given smaller numbers of words; without, a shorter text gives one of all its words."""
    hashed = rows.select(*keys, word_hashes(F.col("text").cast("string")).alias("w")).where(F.size("w") > 0)

    def of(m):
        return F.when(F.size("w") >= m, F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - m, F.lit(0))), lambda i: F.xxhash64(
            F.lit(m), *[F.get("w", i + j) for j in range(m)]))).otherwise(F.array().cast("array<long>"))
    if short is None:
        sh = of(n)
        for m in range(1, n):
            sh = F.when(F.size("w") == m, F.array(F.xxhash64(F.lit(m), *[F.get("w", F.lit(j)) for j in range(m)]))).otherwise(sh)
    else:
        sh = F.concat(of(n), *[of(m) for m in short])
    return hashed.select(*keys, F.explode(sh).alias("s"))


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, t, text) of the rows with an id; ``t`` is a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t"),
                                                   text.alias("text"))


def contained_items(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared): pairs in which a text of the document holds
    at least ``percent`` of the item's distinct ``n``-word shingles."""
    rows = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    lengths = rows.select(F.size(word_hashes(F.col("text").cast("string"))).alias("m")).where(F.col("m").between(1, n - 1))
    short = sorted(r["m"] for r in lengths.distinct().collect())  # at most n - 1 numbers
    item = staged(shingle_rows(rows, ["item_id"], n).distinct(), "op1-items")
    sizes = item.groupBy("item_id").agg(F.count("*").alias("item_shingles"))
    upper = F.expr("shiftleft(1L, cast(floor(log2(item_shingles)) as int) + 1) - 1")
    keep = upper - F.ceil(upper * F.lit(percent) / 100) + 1
    # the shingles that the fewest items hold come first: any fixed choice of so many finds every container
    holders = item.groupBy("s").agg(F.count("*").alias("holders"))
    ranked = item.join(sizes, "item_id").join(holders, "s").withColumn(
        "rank", F.row_number().over(Window.partitionBy("item_id").orderBy("holders", F.xxhash64("s", F.lit(17)), "s")))
    sketch = staged(ranked.where(F.col("rank") <= keep).select("item_id", "s"), "op1-sketch")
    texts = _texts(docs)
    cand = staged(shingle_rows(texts, ["doc_id", "t"], n, short).join(broadcast_if_small(sketch), "s")
                  .select("doc_id", "t", "item_id").distinct(), "op1-candidates")
    ids = staged(cand.select("doc_id", "t").distinct(), "op1-ids")
    near = texts.join(broadcast_if_small(ids), ["doc_id", "t"], "left_semi")
    hits = (shingle_rows(near, ["doc_id", "t"], n, short)
            .join(broadcast_if_small(item), "s").select("doc_id", "t", "item_id", "s").distinct()
            .join(cand, ["doc_id", "t", "item_id"], "left_semi")
            .groupBy("doc_id", "t", "item_id").agg(F.count("*").alias("shared")))
    return (hits.groupBy("doc_id", "item_id").agg(F.max("shared").alias("shared"))
            .join(broadcast_if_small(sizes), "item_id")
            .where(F.col("shared") * 100 >= F.col("item_shingles") * percent)
            .select("doc_id", "item_id", "item_shingles", "shared"))


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents whose text contains no item."""
    mark = next(name for name in ("_text", *(f"_text{i}" for i in range(len(docs.columns)))) if name not in docs.columns)
    texts = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    gone = contained_items(docs.select(texts.alias("doc_id"), "text"), items, n, percent)
    return docs.withColumn(mark, texts).join(
        gone.select(F.col("doc_id").alias(mark)).distinct(), mark, "left_anti").select(*docs.columns)
