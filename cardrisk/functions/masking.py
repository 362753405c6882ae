"""Card-number masks (X1, X2, X3) as built-in column expressions.

Three modes, all JVM-side and codegen'd:

* ``regex`` (phase 2): anchored ``^(\\d{4})\\d{8}(\\d{4})$`` -> ``$1-XXXX-XXXX-$2``.
  Anything that is not exactly 16 digits passes through unchanged, so a
  15-digit number leaks in full.
* ``affix`` (phase 3): first four + ``-XXXX-XXXX-`` + last four characters.
  NULL stays NULL (``concat`` propagates NULL); a short value is shown twice.
* ``strict`` (default for new layers): 16 digits -> affix mask, any other
  non-NULL value -> a fully masked constant, NULL -> NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the masks.
REGEX_PATTERN = r"^(\d{4})\d{8}(\d{4})$"
REGEX_REPLACEMENT = "$1-XXXX-XXXX-$2"
AFFIX_MIDDLE = "-XXXX-XXXX-"
FULL_MASK = "XXXX-XXXX-XXXX-XXXX"
SIXTEEN_DIGITS = r"\A[0-9]{16}\z"   # whole string; Java "$" would also match before a final newline

MODES = ("regex", "affix", "strict")


def _as_column(card: Column | str) -> Column:
    return F.col(card) if isinstance(card, str) else card


def mask_card_regex(card: Column | str) -> Column:
    return F.regexp_replace(_as_column(card), F.lit(REGEX_PATTERN), F.lit(REGEX_REPLACEMENT))


def mask_card_affix(card: Column | str) -> Column:
    c = _as_column(card)
    return F.concat(F.substring(c, 1, 4), F.lit(AFFIX_MIDDLE), F.substring(c, -4, 4))


def mask_card_strict(card: Column | str) -> Column:
    c = _as_column(card)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
             .when(c.rlike(SIXTEEN_DIGITS), mask_card_affix(c))
             .otherwise(F.lit(FULL_MASK)))


def mask_card(card: Column | str, mode: str = "strict") -> Column:
    """Mask a card-number column; ``mode`` is one of ``regex``, ``affix``, ``strict``."""
    if mode == "regex":
        return mask_card_regex(card)
    if mode == "affix":
        return mask_card_affix(card)
    if mode == "strict":
        return mask_card_strict(card)
    raise ValueError(f"unknown mask mode {mode!r}; expected one of {MODES}")
