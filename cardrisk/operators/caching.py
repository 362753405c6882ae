"""Caching (B1, B2): persist after the filter, release after use.

Caching *before* a filter turns the scan into an ``InMemoryTableScan`` over
the unpruned table (no partition pruning, no pushed filters) and keeps the
whole table in executor memory.  ``cached`` is meant to wrap a DataFrame
that is already filtered and projected.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def cache_and_count(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> tuple[DataFrame, int]:
    """B1: persist and materialise; returns the persisted DataFrame and its row count."""
    persisted = df.persist(level)
    return persisted, persisted.count()


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
           materialise: bool = True) -> Iterator[DataFrame]:
    """B2: ``with cached(filtered) as df: ...`` persists, and always unpersists on exit.

    MEMORY_AND_DISK spills blocks that do not fit instead of recomputing them.
    """
    persisted = df.persist(level)
    try:
        if materialise:
            persisted.count()
        yield persisted
    finally:
        persisted.unpersist()
