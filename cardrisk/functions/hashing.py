"""Deterministic pseudo-random columns from a row id.

``rand()`` / ``uuid()`` give different data on every evaluation and depend
on the partitioning.  Here every random draw is a hash of ``(salt, id)``:
the same id gives the same value on any executor, after a task retry and in
the DuckDB oracle, which computes the same recipe
``CAST('0x' || substring(md5('salt:' || id), 1, k) AS BIGINT)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 6.283185307179586


def _id(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_int(salt: str, row_id: Column | str, hex_digits: int = 8) -> Column:
    """A non-negative BIGINT from the first ``hex_digits`` hex digits of
    ``md5('<salt>:<id>')`` (8 digits -> uniform on [0, 2**32))."""
    if not 1 <= hex_digits <= 15:
        raise ValueError("hex_digits must be in 1..15")
    digest = F.md5(F.concat(F.lit(f"{salt}:"), _id(row_id).cast("string")))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def hash_uniform(salt: str, row_id: Column | str) -> Column:
    """A DOUBLE uniform on (0, 1): ``(h + 0.5) / 2**32``."""
    return (hash_int(salt, row_id) + F.lit(0.5)) / F.lit(4294967296.0)


def hash_normal(salt: str, row_id: Column | str) -> Column:
    """A standard normal draw by Box-Muller on two hash uniforms."""
    u1 = hash_uniform(f"{salt}/u1", row_id)
    u2 = hash_uniform(f"{salt}/u2", row_id)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(TWO_PI) * u2)


def hash_uuid(salt: str, row_id: Column | str) -> Column:
    """A UUID-formatted string (8-4-4-4-12 hex) from ``md5('<salt>:<id>')``."""
    d = F.md5(F.concat(F.lit(f"{salt}:"), _id(row_id).cast("string")))
    return F.concat_ws("-", F.substring(d, 1, 8), F.substring(d, 9, 4), F.substring(d, 13, 4),
                       F.substring(d, 17, 4), F.substring(d, 21, 12))


def pick(values: Sequence, h: Column) -> Column:
    """G5, small pool: ``values[h % len(values)]``."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (h % F.lit(len(values))).cast("int") + F.lit(1))


def pick_weighted(values: Sequence, weights: Sequence[int], h: Column) -> Column:
    """Weighted choice with integer weights; cumulative bands on ``h % sum(weights)``."""
    if len(values) != len(weights) or not values:
        raise ValueError("values and weights must be non-empty and of equal length")
    bucket = h % F.lit(sum(weights))
    upper = 0
    expr = None
    for value, weight in zip(values[:-1], weights[:-1]):
        upper += weight
        cond = bucket < F.lit(upper)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    last = F.lit(values[-1])
    return last if expr is None else expr.otherwise(last)


def zero_pad(text: Column, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer texts stay whole (a plain lpad cuts them)."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def pool_label(prefix: str, h: Column, pool_size: int, width: int = 0) -> Column:
    """G5, large pool: ``prefix || (h % pool_size)`` (optionally zero-padded)."""
    idx = (h % F.lit(pool_size)).cast("string")
    return F.concat(F.lit(prefix), zero_pad(idx, width) if width else idx)
