"""Sinks K1-K4: layer tables (optionally date-partitioned) and JSON Lines drops.

A date-partitioned write is preceded by a ``REBALANCE(<partition cols>)``
hint.  With AQE this is one shuffle that groups rows of a date together
(so each task writes few directories and the file count stays bounded),
coalesces small partitions to the advisory size and splits a skewed date
into several tasks, so a date holding a third of the rows does not become
one straggler writing one huge file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import has_path

WRITE_MODES = ("overwrite", "append", "error", "ignore")


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, dynamic: bool = False,
                rebalance: bool = True, max_records_per_file: int | None = None) -> str:
    """K1 / K2 / K3: write a layer.

    ``dynamic=True`` replaces only the partitions present in ``df``
    (``partitionOverwriteMode=dynamic``, R1); otherwise an overwrite replaces
    the whole table.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if (dynamic or mode == "append") and has_path(df.sparkSession, f"{path.rstrip('/')}/_manifest"):
        raise ValueError(f"{path} is versioned: change it with sources.versions.replace")
    cols = list(partition_by or [])
    out = df.hint("rebalance", *cols) if (cols and rebalance) else df
    writer = out.write.format(fmt).mode(mode)
    if cols:
        writer = writer.partitionBy(*cols)
    writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.save(path)
    return path


def write_json_lines(df: DataFrame, path: str, records_per_file: int = 50_000,
                     mode: str = "overwrite", timestamp_format: str | None = None) -> str:
    """K4: a raw file drop, one JSON object per line, at most
    ``records_per_file`` lines a file.  NULL fields are omitted, as a
    producer serialising only present keys would do."""
    writer = (df.write.mode(mode).option("maxRecordsPerFile", int(records_per_file))
              .option("dateFormat", "yyyy-MM-dd"))
    if timestamp_format:
        writer = (writer.option("timestampFormat", timestamp_format)
                  .option("timestampNTZFormat", timestamp_format))
    writer.json(path)
    return path


def write_text_lines(lines: DataFrame, path: str, records_per_file: int = 50_000,
                     mode: str = "overwrite") -> str:
    """K4 variant for pre-rendered lines (one string column ``value``)."""
    (lines.select(F.col(lines.columns[0]).alias("value"))
     .write.mode(mode).option("maxRecordsPerFile", int(records_per_file)).text(path))
    return path
