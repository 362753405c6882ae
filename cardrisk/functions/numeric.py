"""Money, ratio and rounding helpers (X8, X9, X10, A9) as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MONEY


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: Column | str) -> Column:
    """Exact money: DECIMAL(12,2).  NaN and out-of-range values become NULL.

    ``try_cast`` keeps a bad value at the Bronze boundary from failing the
    whole job under ANSI mode.
    """
    return _col(c).try_cast(MONEY)


def valid_amount(c: Column | str, data_type: T.DataType | None = None) -> Column:
    """``amount > 0``; for floating input also ``NOT isnan(amount)``.

    The comparison stays on the stored column so Parquet receives
    ``PushedFilters: GreaterThan(amount,0)``; NULL compares to NULL and is
    dropped by ``filter``.
    """
    col = _col(c)
    cond = col > 0
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        cond = cond & ~F.isnan(col)
    return cond


def storable_amount(c: Column | str, data_type: T.DataType | None = None) -> Column:
    """F1 on the value that Silver stores: ``valid_amount``, and still positive as
    money (a value that rounds to 0.00 or does not fit the type is not)."""
    cond = valid_amount(c, data_type)
    return cond if data_type == MONEY else cond & (to_money(c) > 0)


def pct(numerator: Column | str, denominator: Column | str, scale: int = 2) -> Column:
    """``round(x * 100 / y, scale)`` as DOUBLE; NULL when ``y`` is 0."""
    num = _col(numerator).cast("double") * F.lit(100.0)
    return F.round(F.try_divide(num, _col(denominator).cast("double")), scale)


def round_money(c: Column | str, scale: int = 2) -> Column:
    """HALF_UP rounding on a decimal, returned as DOUBLE."""
    return F.round(_col(c), scale).cast("double")
