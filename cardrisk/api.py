"""The reference's public entry points, with the same names and arguments.

A user of the reference can switch by changing the import; each function
runs the Spark-native implementation of this package.  Paths are
parameters instead of fixed buckets, the table format is a parameter
(default Parquet; ``delta`` works with its package on the classpath), and
the layer builders return the table they wrote (read back), not a lazy plan
that would recompute the previous layer when shown.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from .operators import bronze as _bronze
from .operators import gold as _gold
from .operators import silver as _silver
from .operators.generate import P2Profile, generate
from .plans.pipeline import PipelineConfig, ingest, rebuild_layers, run_pipeline
from .schemas import DATE_COL
from .session import get_spark_session as _session
from .sinks.writers import write_layer
from .sources.readers import read_layer


def get_spark_session(app_name: str = "cardrisk") -> SparkSession:
    """The active session, or a new one with AQE and the package defaults."""
    return _session(app_name)


def generate_synthetic_transactions(spark: SparkSession, total_rows: int = 15_000_000,
                                    as_of: _dt.date | None = None) -> DataFrame:
    """G1: the phase-2 profile, ``total_rows`` rows dated over the 45 days up
    to ``as_of`` (default: today).  Deterministic for a given ``as_of``."""
    return generate(spark, P2Profile(as_of=as_of or _dt.date.today()), total_rows)


def save_to_bronze_layer(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write the raw DataFrame as Bronze (full overwrite)."""
    return _bronze.save_to_bronze(df, path, fmt)


def build_silver_layer(spark: SparkSession, bronze_path: str, silver_path: str,
                       fmt: str = "parquet") -> DataFrame:
    """C4: Bronze -> Silver with the phase-2 rules (positive amount, regex mask
    into ``card_number_masked``, raw card dropped)."""
    write_layer(_silver.to_silver_p2(read_layer(spark, bronze_path, fmt)), silver_path, fmt)
    return read_layer(spark, silver_path, fmt)


def build_gold_layer(spark: SparkSession, silver_path: str, gold_path: str,
                     fmt: str = "parquet") -> DataFrame:
    """Silver -> daily user features, partitioned by ``transaction_date``."""
    write_layer(_gold.daily_features(read_layer(spark, silver_path, fmt)), gold_path, fmt,
                partition_by=[DATE_COL])
    return read_layer(spark, gold_path, fmt)


def run_ingestion(spark: SparkSession, raw_path: str, root: str, fmt: str = "parquet") -> str:
    """Raw JSON Lines -> Bronze under ``root`` with lineage (declared schema;
    bad lines go to the ``_status=rejected`` partition); returns Bronze's path."""
    cfg = PipelineConfig(raw_path=raw_path, root=root, fmt=fmt)
    ingest(spark, cfg)
    return cfg.path("bronze")


def run_transformations(spark: SparkSession, root: str, fmt: str = "parquet") -> dict:
    """Silver (affix mask) and Gold (risk profile) under ``root`` from the Bronze there;
    returns rows and seconds per layer."""
    cfg = PipelineConfig(raw_path="", root=root, fmt=fmt)
    out = rebuild_layers(spark, cfg)
    return {**out, **{f"{layer}_rows": read_layer(spark, cfg.path(layer), fmt).count()
                      for layer in ("bronze", "silver", "gold")}}


def run_all(spark: SparkSession, raw_path: str, root: str, fmt: str = "parquet") -> dict:
    """The phase-3 layers under ``root`` from a raw drop; returns rows and seconds per layer."""
    return run_pipeline(spark, PipelineConfig(raw_path=raw_path, root=root, fmt=fmt))
