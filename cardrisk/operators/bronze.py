"""Bronze layer: lineage columns, reject classification and ingestion.

Ingestion is one narrow job: scan the JSON drop with a declared schema,
add lineage, classify each row and write a single Bronze table partitioned
by ``_status`` (``accepted`` / ``rejected``).  The quarantine is the
``_status=rejected`` partition; readers of Bronze prune to
``_status=accepted``.  Both live in the restricted Bronze area because a
raw line may contain a full card number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import to_money
from ..schemas import (BATCH_COL, CORRUPT_COL, DATE_COL, INGEST_TS_COL, SOURCE_BLOCK_COL, SOURCE_FILE_COL,
                       SOURCE_ROW_COL, SOURCE_TIME_COL)
from ..sinks.writers import write_layer
from ..sources.readers import read_layer, read_raw_json

STATUS_COL = "_status"
REASON_COL = "_reject_reason"
ACCEPTED = "accepted"
REJECTED = "rejected"
FULL_LOAD = "full"
POSITION_COLS = (SOURCE_TIME_COL, SOURCE_FILE_COL, SOURCE_BLOCK_COL, SOURCE_ROW_COL)


def add_lineage(df: DataFrame, source_label: str | None = None) -> DataFrame:
    """``_ingestion_ts`` and ``_source_file``.

    On a file scan the source file comes from the hidden ``_metadata``
    column (call this directly on the scan); for DataFrames that do not
    come from files pass ``source_label`` (e.g. ``"demo_generated"``).
    """
    source = F.lit(source_label) if source_label is not None else F.col("_metadata.file_path")
    return df.withColumns({INGEST_TS_COL: F.current_timestamp(), SOURCE_FILE_COL: source})


def add_position(df: DataFrame) -> DataFrame:
    """File time, block and row of each raw record: with ``_source_file`` the order
    in which records arrived, which decides the latest of several versions.
    Call it on the scan, before lineage is added; a stream numbers the rows of each
    micro-batch with ``add_row_number`` (a streaming plan cannot)."""
    df = df.withColumns({SOURCE_TIME_COL: F.col("_metadata.file_modification_time"),
                         SOURCE_BLOCK_COL: F.col("_metadata.file_block_start")})
    return df if df.isStreaming else add_row_number(df)


def add_row_number(df: DataFrame) -> DataFrame:
    """``_source_row``: grows with the row's place within its file block."""
    return df.withColumn(SOURCE_ROW_COL, F.monotonically_increasing_id())


def reject_reason(df: DataFrame, amount_col: str = "amount",
                  required: Sequence[str] = (DATE_COL,)) -> Column:
    """Why a raw row cannot go on: malformed line, NULL amount, NULL required column,
    an amount that money cannot hold (out of range, infinite, or positive and rounded to 0.00).

    NULL when the row is accepted; NaN is left to F1, like a non-positive amount.  A non-positive amount is *not* a Bronze
    reject: Bronze keeps it and the Silver quality filter (F1) drops it.
    """
    reason = None
    if CORRUPT_COL in df.columns:
        reason = F.when(F.col(CORRUPT_COL).isNotNull(), F.lit("malformed"))
    checks = [(amount_col, "null_amount")] + [(c, f"null_{c.replace('transaction_', '')}")
                                              for c in required]
    for col, label in checks:
        cond = F.col(col).isNull()
        reason = F.when(cond, F.lit(label)) if reason is None else reason.when(cond, F.lit(label))
    too_large = to_money(amount_col).isNull() & ~F.isnan(F.col(amount_col).cast("double"))
    too_small = (F.col(amount_col) > 0) & (to_money(amount_col) <= 0)
    return reason.when(too_large, F.lit("amount_range")).when(too_small, F.lit("amount_rounds_to_zero"))


def classify(df: DataFrame, amount_col: str = "amount") -> DataFrame:
    """Add ``_reject_reason`` and ``_status``."""
    reason = reject_reason(df, amount_col)
    return (df.withColumn(REASON_COL, reason)
              .withColumn(STATUS_COL, F.when(F.col(REASON_COL).isNull(), F.lit(ACCEPTED))
                          .otherwise(F.lit(REJECTED))))


def reject_counts(df: DataFrame, amount_col: str = "amount") -> DataFrame:
    """Rows per reject reason (accepted rows are not listed).

    Pass the quarantine or a classified table: on a raw JSON scan Spark parses only
    the columns the reasons read, so a defect in another column is not seen.
    """
    reason = F.col(REASON_COL) if REASON_COL in df.columns else reject_reason(df, amount_col)
    return (df.select(reason.alias("reason"))
              .filter(F.col("reason").isNotNull())
              .groupBy("reason").agg(F.count(F.lit(1)).alias("row_count")))


def ingest_bronze(spark: SparkSession, raw_path: str, bronze_path: str, schema: T.StructType,
                  fmt: str = "parquet", mode: str = "overwrite",
                  extra_partitions: Sequence[str] = (), batch: str | None = None) -> str:
    """Raw JSON drop -> Bronze (+ quarantine partition), one pass over the files.

    With ``batch`` the rows also get their arrival position and land in the
    ``_batch_id=<batch>`` partition, the layout that increments append to.
    """
    raw = read_raw_json(spark, raw_path, schema)
    if batch is None:
        bronze, outer = classify(add_lineage(raw)), [*extra_partitions]
    else:
        bronze = classify(add_lineage(add_position(raw))).withColumn(BATCH_COL, F.lit(batch))
        outer = [BATCH_COL, *extra_partitions]
    write_layer(bronze, bronze_path, fmt=fmt, mode=mode, partition_by=[*outer, STATUS_COL],
                dynamic=(mode == "overwrite" and bool(extra_partitions)), rebalance=False)
    return bronze_path


def read_bronze(spark: SparkSession, bronze_path: str, fmt: str = "parquet",
                status: str = ACCEPTED) -> DataFrame:
    """Accepted Bronze rows, or the quarantine with ``status='rejected'``
    (which keeps ``_reject_reason`` and the raw line in ``_corrupt_record``).

    ``_status`` is a partition column, so the filter prunes directories.
    """
    df = read_layer(spark, bronze_path, fmt).filter(F.col(STATUS_COL) == F.lit(status))
    drop = [STATUS_COL] + ([REASON_COL, CORRUPT_COL] if status == ACCEPTED else [])
    return df.drop(*[c for c in drop if c in df.columns])


def save_to_bronze(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: Sequence[str] | None = None) -> str:
    """Persist an already-built raw DataFrame (e.g. a generator's output) as Bronze."""
    return write_layer(df, path, fmt=fmt, mode=mode, partition_by=partition_by)
