"""Equi-joins with a dimension (J1 broadcast, J2 sort-merge) behind a size check.

``broadcast()`` ships the whole build side to every executor, so it is only
safe for a side whose size is *proven* small.  ``dimension_fits`` proves it
with one aggregate over the candidate side: every task counts its rows and
their encoded bytes (a partial aggregate), and only one small row per task
reaches the final aggregate.  (A ``limit(n)`` probe would instead send up to
``n`` rows from *every* partition into a single task when the side is
large.)  Only when both the row and byte bounds hold is the side broadcast;
otherwise the join is a shuffled sort-merge join, where AQE can still switch
to broadcast at runtime (from real shuffle statistics) and split skewed
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _field_bytes(field: T.StructField) -> Column:
    width = _FIXED_WIDTH.get(type(field.dataType))
    if width is not None:
        return F.lit(width)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + F.lit(8)
    # nested / other types: size of their JSON text is an upper-bound proxy
    return F.coalesce(F.length(F.to_json(F.struct(F.col(field.name)))), F.lit(0))


def dimension_fits(dim: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                   max_bytes: int = DEFAULT_MAX_BYTES) -> tuple[bool, int, int]:
    """Return ``(fits, rows, bytes)``: the exact row count of ``dim`` and an
    upper estimate of its size as broadcast rows."""
    row_bytes = sum((_field_bytes(f) for f in dim.schema.fields), F.lit(16))
    probe = dim.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes).alias("bytes")).first()
    rows, size = int(probe["rows"]), int(probe["bytes"] or 0)
    return rows <= max_rows and size <= max_bytes, rows, size


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
                   how: str = "inner", max_rows: int = DEFAULT_MAX_ROWS,
                   max_bytes: int = DEFAULT_MAX_BYTES,
                   fits: bool | None = None) -> tuple[DataFrame, str]:
    """Join ``fact`` with ``dim``; broadcast ``dim`` only if it is proven small.

    Returns the joined DataFrame and the chosen strategy (``broadcast`` or
    ``shuffle``).  ``how`` must keep ``dim`` on the build side: inner,
    left (outer), left_semi or left_anti.  ``fits`` reuses an earlier
    ``dimension_fits`` verdict for the same ``dim``.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti"):
        raise ValueError(f"join type {how!r} cannot broadcast the right side")
    if fits is None:
        fits, _, _ = dimension_fits(dim, max_rows, max_bytes)
    if fits:
        return fact.join(F.broadcast(dim), on, how), "broadcast"
    return fact.join(dim, on, how), "shuffle"


def join_merge(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
               how: str = "inner") -> DataFrame:
    """The shuffled sort-merge join (comparison plan for J1)."""
    return fact.join(dim.hint("merge"), on, how)


def semi_join_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str],
                   anti: bool = False, max_rows: int = DEFAULT_MAX_ROWS,
                   max_bytes: int = DEFAULT_MAX_BYTES, fits: bool | None = None) -> DataFrame:
    """Keep (``anti=False``) or drop (``anti=True``) the rows of ``df`` whose key is
    in ``keys``; broadcast the key list only when it is proven small."""
    cols = [on] if isinstance(on, str) else list(on)
    joined, _ = join_dimension(df, keys.select(*cols), cols, "left_anti" if anti else "left_semi",
                               max_rows, max_bytes, fits)
    return joined
