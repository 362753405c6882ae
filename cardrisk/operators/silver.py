"""Silver layer: quality filter + card mask + drop of the raw card.

Pure ``DataFrame -> DataFrame`` transforms; writing is in ``sinks``.
The filter sits directly on the stored ``amount`` column, before any
projection, so it is pushed into the Parquet scan; the card column is
replaced by its mask in the same projection, so the raw number never
reaches a later operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.masking import mask_card
from ..functions.numeric import storable_amount, to_money, valid_amount
from ..schemas import CORRUPT_COL, MONEY


def filter_valid(df: DataFrame, amount_col: str = "amount") -> DataFrame:
    """keep rows with a positive, non-NaN amount (NULL is dropped)."""
    dtype = df.schema[amount_col].dataType
    return df.filter(valid_amount(amount_col, dtype))


def mask_column(df: DataFrame, mode: str = "strict", card_col: str = "card",
                out_col: str = "card_masked") -> DataFrame:
    """X1/X2/X3 + P2: replace ``card_col`` by its mask, in place of the original column."""
    cols = []
    for name in df.columns:
        if name == card_col:
            cols.append(mask_card(card_col, mode).alias(out_col))
        elif name != out_col:
            cols.append(F.col(name))
    return df.select(*cols)


def to_silver(df: DataFrame, mode: str = "affix", card_col: str = "card",
              out_col: str = "card_masked", amount_col: str = "amount",
              money: bool = True) -> DataFrame:
    """Bronze -> Silver.

    ``mode='affix'`` reproduces phase 3 (``card`` -> ``card_masked``),
    ``mode='regex'`` with ``card_col='card_number'`` and
    ``out_col='card_number_masked'`` reproduces phase 2; ``strict`` is the
    leak-free default for new tables.  ``money=True`` stores the amount as
    DECIMAL(12,2), so every later sum is exact; an amount that is no longer
    positive as money (0.004) or does not fit is not stored (Bronze quarantines them as
    ``amount_rounds_to_zero`` and ``amount_range``).  ``_corrupt_record`` (which
    may hold a raw line with a full card number) is never carried over.
    """
    dtype = df.schema[amount_col].dataType
    out = df.filter(storable_amount(amount_col, dtype)) if money else filter_valid(df, amount_col)
    if CORRUPT_COL in out.columns:
        out = out.drop(CORRUPT_COL)
    out = mask_column(out, mode, card_col, out_col)
    if money and dtype != MONEY:
        out = out.withColumn(amount_col, to_money(amount_col))
    return out


def to_silver_p2(bronze: DataFrame) -> DataFrame:
    """C4 transform: phase-2 silver (regex mask, ``card_number_masked``, amount kept as is)."""
    return to_silver(bronze, mode="regex", card_col="card_number",
                     out_col="card_number_masked", money=False)


def to_silver_p3(bronze: DataFrame) -> DataFrame:
    """C6 transform: phase-3 silver (affix mask, ``card_masked``, decimal amount)."""
    return to_silver(bronze, mode="affix", card_col="card", out_col="card_masked")
