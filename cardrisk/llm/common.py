"""Shared helpers of the training-data operators.

Two kinds: small DataFrame helpers (staged tables, size-proven broadcasts) and
numpy tokenisation over Arrow string buffers.  The numpy helpers work on a
slice of an Arrow batch at a time (``slices``), so their memory is bounded by
``SLICE_BYTES`` plus the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

SLICE_BYTES = 1 << 20
BROADCAST_ROWS = 500_000

_U = np.uint64
_MASK = (1 << 64) - 1


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts
    the lineage, and a lost executor only re-reads files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when a count proves the row bound; callers pass
    staged tables of a few fixed-width columns.  Beyond it the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive row runs of about ``limit`` bytes.
    NULL counts as the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offs, offs[row] + limit, "right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, data[offs[row]:offs[stop]], offs[row:stop + 1] - offs[row]
        row = stop


# Words are maximal runs of bytes other than space and 0x09-0x0D; A-Z is lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SEP = np.zeros(256, bool)
IS_SEP[[9, 10, 11, 12, 13, 32]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (vectorised)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix64((np.arange(256, dtype=np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D


class _Powers:
    """Powers of an odd base modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            steps = np.full(max(n, 1 << 16), self.base & _MASK, np.uint64)
            steps[0] = 1
            self.table = np.multiply.accumulate(steps)
        return self.table[:n]


_POW, _INV = _Powers(_BASE), _Powers(pow(_BASE, -1, 1 << 64))


def spans(data: np.ndarray, offs: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of non-``sep`` bytes, never across rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    tok = ~sep
    first, last = tok.copy(), tok.copy()
    first[1:] &= sep[:-1]
    last[:-1] &= sep[1:]
    rows = offs[:-1] < offs[1:]
    at = offs[:-1][rows]
    first[at] = tok[at]
    at = offs[1:][rows] - 1
    last[at] = tok[at]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of random byte values times powers, for ``span_hashes``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POW.upto(len(data)), out=sums[1:])
    return sums


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial of random byte values, from prefix sums."""
    if not len(start):
        return np.zeros(0, np.uint64)
    sums = prefix_sums(data) if sums is None else sums
    inv = _INV.upto(len(data) + 1)
    return mix64((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes and, for each word, start, end, row and 64-bit hash."""
    low = LOWER[data]
    start, end, row = spans(low, offs, IS_SEP[low])
    return low, start, end, row, span_hashes(low, start, end)


def shingles(word_hash: np.ndarray, row: np.ndarray, n_rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all ``n``-word shingles; a row of fewer words gives its whole
    sequence as one shingle, a row without words none.  Ordered by row."""
    m = len(word_hash)
    step = _U(0xD6E8FEB86659FD93)
    rows, out = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if m >= n:
        x = np.full(m - n + 1, n, np.uint64)
        for j in range(n):
            x = x * step + word_hash[j:m - n + 1 + j]
        ok = row[:m - n + 1] == row[n - 1:]
        rows, out = row[:m - n + 1][ok], mix64(x[ok])
    count = np.bincount(row, minlength=n_rows) if m else np.zeros(n_rows, np.int64)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        begin = np.searchsorted(row, short)
        extra = np.zeros(len(short), np.uint64) + count[short].astype(np.uint64)
        for j in range(n - 1):
            more = count[short] > j
            extra[more] = extra[more] * step + word_hash[begin[more] + j]
        rows = np.concatenate([rows, short])
        out = np.concatenate([out, mix64(extra)])
        order = np.argsort(rows, kind="stable")
        rows, out = rows[order], out[order]
    return rows, out


def distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, ordered by row, then value."""
    if not len(rows):
        return rows, values
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[keep], values[keep]


def listed(values: np.ndarray, rows: np.ndarray, n_rows: int, kind: pa.DataType) -> pa.Array:
    """Arrow list column from values ordered by row."""
    offs = np.searchsorted(rows, np.arange(n_rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, type=kind))
