"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; ``run`` writes each stage's result as Parquet in the shared checkpoint
folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from cardrisk.llm.common import load, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores under 0.3 go."""
    labels = load(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return quality.keep_good(docs, labels, 0.3)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document holds are cut."""
    return line_dedup.drop_repeated_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays (5-word shingles, 0.8), decided on the texts
    that ``docs`` holds and on those before line dedup cut them."""
    return near_dedup.drop_near_duplicates(docs, before=load(spark, sf_dir, "documents"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the tempered marginals of source, language and topic."""
    return mixing.mixed(docs).where("mix_kept").drop("mix_kept")


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage)]

# The quality stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
