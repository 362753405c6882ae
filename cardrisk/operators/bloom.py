"""A Bloom filter of a key set, tested inside the scan of a large table.

The filter is blocked: a key sets ``BITS`` bits of one 64-bit word, both chosen by its
hash.  It is built by one aggregation (``bit_or`` per word) and is a table of (word,
bits) with at most ``MAX_WORDS`` rows whatever the number of keys, so it can always be
broadcast.  Rows of the large table look their word up and are dropped before any
exchange if a bit is missing.  A key of the set always passes; more keys than
``MAX_WORDS`` words are made for only let more other rows pass, so callers follow with
the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WORDS = 1 << 21
KEYS_PER_WORD = 5
BITS = 4
MARK = "_may_hold"


def _words(n_keys: int) -> int:
    return min(MAX_WORDS, max(1, -(-int(n_keys) // KEYS_PER_WORD)))


def _word(key: str, n_keys: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(_words(n_keys))).cast("int")


def _mask(key: str) -> Column:
    h = F.xxhash64(F.col(key), F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def key_filter(keys: DataFrame, key: str, n_keys: int) -> DataFrame:
    """(_word, _bits) of the non-NULL ``keys``; ``n_keys`` is their number."""
    rows = keys.filter(F.col(key).isNotNull()).select(_word(key, n_keys).alias("_word"), _mask(key).alias("_mask"))
    return rows.groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))


def marked(df: DataFrame, bloom: DataFrame, key: str, n_keys: int) -> DataFrame:
    """``df`` with ``_may_hold``: False for rows whose key is surely not in the set (NULL keys are not)."""
    rows = df.withColumn("_word", _word(key, n_keys)).join(F.broadcast(bloom), "_word", "left")
    hit = F.col("_bits").bitwiseAND(_mask(key)) == _mask(key)
    return rows.withColumn(MARK, F.coalesce(hit, F.lit(False)) & F.col(key).isNotNull()).drop("_word", "_bits")


def may_hold(df: DataFrame, bloom: DataFrame, key: str, n_keys: int) -> DataFrame:
    """The rows of ``df`` whose key may be in the set."""
    rows = df.withColumn("_word", _word(key, n_keys)).join(F.broadcast(bloom), "_word")
    return rows.filter(F.col("_bits").bitwiseAND(_mask(key)) == _mask(key)).drop("_word", "_bits")
