"""Date parsing and formatting (X11-X14) as built-in expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Text -> DATE; an impossible date (``2026-13-01``) becomes NULL
    instead of failing the job under ANSI mode."""
    return F.try_to_date(_col(c), fmt)


def parse_timestamp(c: Column | str, fmt: str = TIMESTAMP_FORMAT + "[.SSSSSS]") -> Column:
    """Text -> TIMESTAMP_NTZ (wall-clock time, no session time zone shift), seconds with or
    without a fraction; NULL if invalid."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def format_date(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """DATE / TIMESTAMP -> text (``strftime`` in the reference)."""
    return F.date_format(_col(c), fmt)


def days_back(as_of: Column | str | _dt.date, days: int) -> Column:
    """X11: ``as_of - days`` (``DATE_ADD('day', -days, as_of)``)."""
    anchor = F.lit(as_of) if isinstance(as_of, _dt.date) else _col(as_of)
    return F.date_sub(anchor, days)
