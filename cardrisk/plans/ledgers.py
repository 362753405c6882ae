"""Ledgers of a lake: which batches were loaded, which subjects were erased.

Both are small append-only Parquet tables under the lake's root, beside the layers and
never rewritten by them.

* ``batches``: one row per event of a batch (its sequence number, state, files, rows).  The
  newest event of a batch is its state: ``bronze`` (in Bronze, not yet in Silver) or
  ``loaded``.  ``ingest``, ``run``, ``batch`` and ``stream`` all write it, and Silver is a
  function of Bronze and these sequence numbers, so their order does not matter.
* ``erased``: one row per erased subject.  Silver is never built from rows of an erased
  subject again, whether by an increment, a rebuild or a history read.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import semi_join_keys
from ..session import has_path

BRONZE, LOADED = "bronze", "loaded"
_BATCHES = ("event long, batch string, seq long, state string, source string, files long, rows long, "
            "accepted long, mark string, at timestamp")
_ERASED = "subject_col string, subject string, at timestamp"


@dataclass(frozen=True)
class Batch:
    event: int
    batch: str
    seq: int
    state: str
    source: str
    files: int
    rows: int
    accepted: int
    mark: str


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """Every event of the batch ledger."""
    path = f"{root.rstrip('/')}/_batches"
    if not has_path(spark, path):
        return spark.createDataFrame([], _BATCHES)
    return spark.read.schema(_BATCHES).parquet(path)


def batches(spark: SparkSession, root: str) -> dict[str, Batch]:
    """The newest event of each batch (on the driver: as many rows as loads were made)."""
    rows = read_batches(spark, root).drop("at").collect()
    return {r["batch"]: Batch(**r.asDict()) for r in sorted(rows, key=lambda r: r["event"])}


def record(spark: SparkSession, root: str, entry: Batch) -> Batch:
    """Append an event; its number follows the newest one."""
    events = read_batches(spark, root).agg(F.max("event")).first()[0]
    entry = Batch(**{**entry.__dict__, "event": (events or 0) + 1})
    row = (*entry.__dict__.values(), _dt.datetime.now(_dt.timezone.utc))
    spark.createDataFrame([row], _BATCHES).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_batches")
    return entry


def record_erased(spark: SparkSession, root: str, subjects: DataFrame, subject_col: str) -> None:
    """Append the subjects (distinct, non-NULL) to the erasure ledger."""
    rows = subjects.where(F.col(subject_col).isNotNull()).select(
        F.lit(subject_col).alias("subject_col"), F.col(subject_col).cast("string").alias("subject")).distinct()
    rows.withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{root.rstrip('/')}/_erased")


def erased(spark: SparkSession, root: str, subject_col: str = "user_id") -> DataFrame | None:
    """The erased subjects of a column (``subject``, text), or None if nothing was ever erased."""
    path = f"{root.rstrip('/')}/_erased"
    if not has_path(spark, path):
        return None
    rows = spark.read.schema(_ERASED).parquet(path).where(F.col("subject_col") == subject_col)
    return rows.select("subject").distinct()


def without_erased(df: DataFrame, subjects: DataFrame | None, subject_col: str = "user_id") -> DataFrame:
    """``df`` without the rows of the erased subjects; rows without a subject stay."""
    if subjects is None or subject_col not in df.columns:
        return df
    keyed = df.where(F.col(subject_col).isNotNull()).withColumn("_subject", F.col(subject_col).cast("string"))
    left = semi_join_keys(keyed, subjects.select(F.col("subject").alias("_subject")), "_subject", anti=True)
    return left.select(*df.columns).unionByName(df.where(F.col(subject_col).isNull()))
