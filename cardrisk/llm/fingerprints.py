"""Homomorphic multiset fingerprints of documents (native).

Method.  A paragraph (line) is hashed to a wide vector; a document's fingerprint
is the sum of its paragraphs' vectors modulo powers of two, lane by lane.  The
sum does not depend on the paragraphs' order, equal multisets have equal sums,
and a paragraph is inserted or deleted by adding or subtracting its vector
(``combine``).  The vector has three parts:

* ``STRONG`` lanes of 32 bits, cut out of the paragraph's SHA-512: equality;
* the number of its units;
* ``2 x 64`` lanes of 32 bits, two to a word, that add up one hash bit of each of its
  units: likeness.  A unit is a piece of a sentence of up to ``8 x 8`` code points: up to
  eight runs of at most eight code points without white space, so that unpunctuated
  texts and texts without spaces have many.  With lanes taken as +1/-1 sums they are a
  tug-of-war sketch, so ``2<a,b> / (|a|^2 + |b|^2)`` estimates the share of common units.
  No text has 2^31 code points, so no lane can run into its neighbour.

A fingerprint is one narrow projection; only ``with_next`` shuffles, once.

NULL text counts as the empty text, which is one empty paragraph without
units.  Equal texts have equal fingerprints; empty texts are alike (1.0) and
unlike every other text (0.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRONG = 16
_M32 = (1 << 32) - 1
_ONES = 1 | 1 << 32
_SHIFTS = 32
# fixed values: sentence marks of Latin, Chinese/Japanese, Indic, Arabic, Armenian, Ethiopic and Khmer script
MARKS = ".!?\n\u3002\uff01\uff1f\uff61\u0964\u0965\u061f\u06d4\u0589\u1362\u17d4"
UNIT = rf"(?:[^\s{MARKS}]{{1,8}}+[^\S\n]*+){{1,8}}+"


def _sum_lane(hashes: str, lane, mask: int | None) -> Column:
    def add(acc, h):
        total = acc + lane(h)
        return total if mask is None else total.bitwiseAND(F.lit(mask))
    return F.aggregate(hashes, F.lit(0).cast("long"), add)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: struct(strong array<long>, n long, lanes array<long>) of column ``text``."""
    keep = df.columns
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.select(*keep, F.transform(F.split(t, "\n", -1), lambda p: F.sha2(p, 512)).alias("_p"),
                   F.transform(F.regexp_extract_all(t, F.lit(UNIT), F.lit(0)), lambda u: F.trim(u)).alias("_u"))
    df = df.select(*keep, "_p", F.transform("_u", lambda u: F.xxhash64(u)).alias("_h"),
                   F.transform("_u", lambda u: F.xxhash64(u, F.lit(2))).alias("_g"))
    strong = [_sum_lane("_p", lambda p, k=k: F.conv(F.substring(p, 8 * k + 1, 8), 16, 10).cast("long"), _M32)
              for k in range(STRONG)]
    lanes = [_sum_lane(src, lambda h, j=j: F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_ONES)), None)
             for src in ("_h", "_g") for j in range(_SHIFTS)]
    return df.select(*keep, F.struct(F.array(*strong).alias("strong"), F.size("_h").cast("long").alias("n"),
                                     F.array(*lanes).alias("lanes")).alias(out))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the union (``sign`` 1) or of ``a`` without ``b`` (-1).

    Lanes are added or subtracted as packed words; a removal undoes an insertion exactly.
    """
    def strong(x, y):
        return F.zip_with(x, y, lambda p, q: (p + sign * q).bitwiseAND(F.lit(_M32)))
    return F.struct(strong(a["strong"], b["strong"]).alias("strong"), (a["n"] + sign * b["n"]).alias("n"),
                    F.zip_with(a["lanes"], b["lanes"], lambda p, q: p + sign * q).alias("lanes"))


def as_text(fp: Column) -> Column:
    """Fixed-width lower-case hex of the equality lanes and the number of units."""
    strong = F.transform(fp["strong"], lambda x: F.right(F.concat(F.lit("0" * 8), F.hex(x)), F.lit(8)))
    count = F.right(F.concat(F.lit("0" * 16), F.hex(fp["n"])), F.lit(16))
    return F.lower(F.concat(F.array_join(strong, ""), count))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common units, 0 to 1; 1 for equal fingerprints."""
    def signed(fp):
        n = fp["n"].cast("double")
        low = F.transform(fp["lanes"], lambda x: x.bitwiseAND(F.lit(_M32)).cast("double") * 2 - n)
        return F.concat(low, F.transform(fp["lanes"], lambda x: F.shiftrightunsigned(x, 32).cast("double") * 2 - n))

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    sa, sb = signed(a), signed(b)
    norm = dot(sa, sa) + dot(sb, sb)
    value = F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * dot(sa, sb) / norm))).otherwise(0.0)
    return F.when((a["strong"] == b["strong"]) & (a["n"] == b["n"]), 1.0).otherwise(value)


def with_next(docs: DataFrame, per_range: int = 2000, most_ranges: int = 4096) -> DataFrame:
    """(doc_id, text, fp, next_text, next_fp): every document with its fingerprint and those of the
    next document by descending id; after the last comes the first.  NULL ids come last, ties
    by text hash.

    Ids are cut into ranges at approximate quantiles; a window runs inside each range, and
    the first row of the range after it is joined to the last.  Ranges hold ``per_range`` rows, or more
    beyond ``most_ranges`` ranges; rows of a range are sorted with spilling, so that changes no result.
    """
    low = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_id", F.coalesce("doc_id", F.lit(low)))
    n = rows.count()
    k = max(1, min(most_ranges, -(-n // per_range)))
    cuts = rows.agg(F.approx_percentile("_id", [i / k for i in range(1, k)] or [0.5], 20 * k)).first()[0] or []
    cuts = sorted(set(cuts))
    bounds = F.lit(cuts) if cuts else F.array().cast("array<long>")
    rows = rows.withColumn("_r", F.size(F.filter(bounds, lambda c: c <= F.col("_id"))))
    order = F.struct("_id", F.xxhash64("text"))
    heads = rows.groupBy("_r").agg(F.max_by("text", order).alias("_text"))
    turn = Window.orderBy(F.col("_r").desc())  # range numbers only, at most most_ranges
    every = turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = rows.select("_r").distinct().select(
        "_r", F.coalesce(F.lead("_r").over(turn), F.first("_r").over(every)).alias("_after"))
    heads = with_fingerprint(heads, "_text", "_fp").select(F.col("_r").alias("_after"), F.struct("_text", "_fp").alias("_head"))
    heads = after.join(heads, "_after").select("_r", "_head")
    inside = Window.partitionBy("_r").orderBy(order.desc())
    rows = with_fingerprint(rows, "text", "fp")
    rows = rows.withColumn("_next", F.lead(F.struct(F.col("text").alias("_text"), F.col("fp").alias("_fp"))).over(inside))
    rows = rows.join(heads, "_r").withColumn("_next", F.coalesce("_next", "_head"))
    return rows.select("doc_id", "text", "fp", F.col("_next._text").alias("next_text"), F.col("_next._fp").alias("next_fp"))


def edited(text: str, other: str) -> Column:
    """The last floor(n/2) code points replaced by the first as many (or all) of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), n - half), F.substring(F.col(other), F.lit(1), half))
