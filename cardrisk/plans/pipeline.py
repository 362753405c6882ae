"""The layers in stage order.

* ``ingest``: raw JSON -> Bronze, as the ``full`` batch.
* ``run_pipeline``: a full build, raw JSON -> Bronze -> Silver -> Gold.
* ``run_batch`` / ``process_batch``: one increment through every layer,
  rewriting only the date partitions it touches (also the body of the
  streaming ``foreachBatch``).
* ``rebuild_layers``: Silver and Gold from all of Bronze.
* ``erase_subjects``: remove users from every layer, for good.

All of them share one Bronze layout and one batch ledger (``ledgers``).  Silver is a
function of Bronze and the ledger: the ``full`` batch keeps every record, as a full
load does; increments replace records by key, the later batch and within it the
later arrival winning.  So any order of the commands ends in the same tables, and an
increment survives a later full build.
* ``run_pipeline_p2``: the phase-2 flow (generate -> Bronze -> Silver -> Gold).

Each stage reads what the previous one wrote (storage is the hand-over, as
between the reference's jobs) and an exception stops the run at the
failing stage.  Silver and Gold are both partitioned by date, so day
queries and incremental rewrites prune; Gold is computed from the Silver
*table*, never by re-running the Bronze scan and filter.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bronze as bronze_ops
from ..operators import gold as gold_ops
from ..operators import maintain
from ..operators import silver as silver_ops
from ..operators.generate import P2Profile, generate
from ..operators.joins import semi_join_keys
from ..schemas import BATCH_COL, DATE_COL, KEY_COL, P3_RAW_SCHEMA, SOURCE_FILE_COL, SOURCE_TIME_COL
from ..session import sized_shuffles
from ..sinks.writers import write_layer
from ..sources import versions
from . import ledgers
from ..sources.readers import read_layer, read_raw_json, register_table, sync_partitions


# arrival position of a raw record: kept in Bronze, not carried into Silver
_POSITION_ONLY = [c for c in bronze_ops.POSITION_COLS if c != SOURCE_FILE_COL]


@dataclass
class PipelineConfig:
    raw_path: str
    root: str
    schema: T.StructType = P3_RAW_SCHEMA
    mask_mode: str = "affix"
    fmt: str = "parquet"
    risk_threshold: int = gold_ops.RISK_THRESHOLD
    paths: dict = field(default_factory=dict)
    # R2 lookup scope of the Silver upsert in incremental runs: "table" (exact,
    # a restated record may move to another date) or "dates" (records keep
    # their date; the lookup reads only the batch's partitions)
    key_scope: str = "table"
    # layer -> catalog table name (S6); registered layers get their
    # partitions tracked in the catalog, so day queries list only their dates
    tables: dict = field(default_factory=dict)

    def path(self, layer: str) -> str:
        return self.paths.get(layer, f"{self.root.rstrip('/')}/{layer}")

    def publish(self, spark: SparkSession, layer: str, touched: list | None = None,
                schema: T.StructType | None = None) -> None:
        """Register ``layer`` as a catalog table, or sync the partitions just written."""
        name = self.tables.get(layer)
        if not name:
            return
        if spark.catalog.tableExists(name) and touched is not None:
            sync_partitions(spark, name, DATE_COL, touched)
        else:
            register_table(spark, name, self.path(layer), self.fmt, [DATE_COL], schema)


def _count(spark: SparkSession, path: str, fmt: str) -> int:
    return read_layer(spark, path, fmt).count()


def _load_bronze(spark: SparkSession, cfg: PipelineConfig, classified: DataFrame, batch: str,
                 source: str) -> tuple[ledgers.Batch, ledgers.Batch | None]:
    """Write a classified batch as its ``_batch_id`` partition (replacing an earlier load
    of it) and record it; returns its new and its earlier ledger entry."""
    path = cfg.path("bronze")
    known = ledgers.batches(spark, cfg.root)
    before = known.get(batch)
    rows = classified.withColumn(BATCH_COL, F.lit(batch))
    layout = [BATCH_COL, bronze_ops.STATUS_COL]
    if _exists(spark, path, cfg.fmt):
        gone = [f"{BATCH_COL}={batch}/{bronze_ops.STATUS_COL}={s}" for s in (bronze_ops.ACCEPTED, bronze_ops.REJECTED)]
        versions.replace(spark, path, rows, layout, cfg.fmt, gone=gone, rebalance=False)
    else:
        write_layer(rows, path, fmt=cfg.fmt, partition_by=layout, rebalance=False)
    stored = read_layer(spark, path, cfg.fmt).filter(F.col(BATCH_COL) == batch)
    files = stored.groupBy(SOURCE_FILE_COL, SOURCE_TIME_COL).agg(
        F.count("*").alias("rows"), F.count_if(F.col(bronze_ops.STATUS_COL) == bronze_ops.ACCEPTED).alias("accepted"))
    total = files.agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("accepted").alias("accepted"),
        F.bit_xor(F.xxhash64(SOURCE_FILE_COL, SOURCE_TIME_COL, "rows", "accepted")).alias("mark")).first()
    seq = 0 if batch == bronze_ops.FULL_LOAD else before.seq if before else max(
        [e.seq for e in known.values()], default=0) + 1
    entry = ledgers.record(spark, cfg.root, ledgers.Batch(
        0, batch, seq, ledgers.BRONZE, source, total["files"], total["rows"] or 0, total["accepted"] or 0,
        str(total["mark"])))
    return entry, before


def _loaded(spark: SparkSession, cfg: PipelineConfig, names: list[str]) -> None:
    known = ledgers.batches(spark, cfg.root)
    for name in names:
        if known[name].state != ledgers.LOADED:
            ledgers.record(spark, cfg.root, replace(known[name], state=ledgers.LOADED))


def ingest(spark: SparkSession, cfg: PipelineConfig) -> ledgers.Batch:
    """The raw drop into Bronze as the ``full`` batch; Silver takes it up with the next
    ``run_pipeline``, ``run_batch`` or ``rebuild_layers``."""
    raw = bronze_ops.add_position(read_raw_json(spark, cfg.raw_path, cfg.schema))
    classified = bronze_ops.classify(bronze_ops.add_lineage(raw))
    return _load_bronze(spark, cfg, classified, bronze_ops.FULL_LOAD, cfg.raw_path)[0]


def silver_of_bronze(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Silver as all accepted Bronze rows and the ledgers define it."""
    known = ledgers.batches(spark, cfg.root)
    accepted = bronze_ops.read_bronze(spark, cfg.path("bronze"), cfg.fmt)
    silver = ledgers.without_erased(silver_ops.to_silver(accepted, mode=cfg.mask_mode), ledgers.erased(spark, cfg.root))
    columns = [c for c in silver.columns if c not in (*_POSITION_ONLY, BATCH_COL)]
    full, increments = F.col(BATCH_COL) == bronze_ops.FULL_LOAD, [e for e in known.values() if e.seq]
    if not increments:
        return silver.filter(full).select(*columns)
    # one row per batch that was ever loaded
    order = spark.createDataFrame([(e.batch, e.seq) for e in known.values()], f"{BATCH_COL} string, _seq long")
    silver = silver.join(F.broadcast(order), BATCH_COL)
    keyed, unkeyed = silver.filter(F.col(KEY_COL).isNotNull()), silver.filter(F.col(KEY_COL).isNull())
    newest = maintain.latest_per_key(keyed.filter(~full), KEY_COL, ["_seq", *bronze_ops.POSITION_COLS])
    kept = keyed.filter(full)
    if any(e.batch == bronze_ops.FULL_LOAD for e in known.values()):
        kept = semi_join_keys(kept, keyed.filter(~full).select(KEY_COL).distinct(), KEY_COL, anti=True)
    # rows without a key: those of the last batch that read their raw file
    last = unkeyed.groupBy(SOURCE_FILE_COL).agg(F.max("_seq").alias("_last"))
    unkeyed = unkeyed.join(last, SOURCE_FILE_COL).filter(F.col("_seq") == F.col("_last"))
    return kept.select(*columns).unionByName(newest.select(*columns)).unionByName(unkeyed.select(*columns))


def rebuild_layers(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Silver and Gold anew from all of Bronze (C6); a table that is there already is
    switched to its new version when that is whole."""
    out: dict = {}
    for layer, source, made in (
            ("silver", "bronze", lambda: silver_of_bronze(spark, cfg)),
            ("gold", "silver", lambda: gold_ops.risk_profile(read_layer(spark, cfg.path("silver"), cfg.fmt),
                                                             cfg.risk_threshold))):
        t = time.perf_counter()
        content, path = made(), cfg.path(layer)
        with sized_shuffles(spark, read_layer(spark, cfg.path(source), cfg.fmt)):
            if _exists(spark, path, cfg.fmt):
                versions.replace(spark, path, content, [DATE_COL], cfg.fmt, gone=None)
            else:
                write_layer(content, path, fmt=cfg.fmt, partition_by=[DATE_COL])
        cfg.publish(spark, layer, schema=content.schema)
        out[f"{layer}_s"] = time.perf_counter() - t
    _loaded(spark, cfg, list(ledgers.batches(spark, cfg.root)))
    return out


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """C7 (phase 3): raw JSON -> Bronze -> Silver -> Gold; rows and seconds per stage.

    The raw drop becomes (or replaces) the ``full`` batch of Bronze; Silver is then
    built from all of Bronze, earlier increments included.  Like the reference's full
    load it keeps every record; only increments replace records by key.
    """
    t = time.perf_counter()
    ingest(spark, cfg)
    out: dict = {"bronze_s": time.perf_counter() - t, **rebuild_layers(spark, cfg)}
    for layer in ("bronze", "silver", "gold"):
        out[f"{layer}_rows"] = _count(spark, cfg.path(layer), cfg.fmt)
    return out


def run_pipeline_p2(spark: SparkSession, root: str, n: int, profile: P2Profile = P2Profile(),
                    fmt: str = "parquet") -> dict:
    """C2 + C4 + C5 (phase 2): generate -> Bronze -> Silver (regex mask) -> Gold features."""
    bronze_path, silver_path, gold_path = (f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    bronze_ops.save_to_bronze(generate(spark, profile, n), bronze_path, fmt)
    write_layer(silver_ops.to_silver_p2(read_layer(spark, bronze_path, fmt)), silver_path, fmt)
    write_layer(gold_ops.daily_features(read_layer(spark, silver_path, fmt)), gold_path, fmt,
                partition_by=[DATE_COL])
    return {"bronze_rows": _count(spark, bronze_path, fmt),
            "silver_rows": _count(spark, silver_path, fmt),
            "gold_rows": _count(spark, gold_path, fmt)}


def run_batch(spark: SparkSession, cfg: PipelineConfig, raw_path: str, batch_id: int) -> dict:
    """R1 (daily increment): one raw batch of JSON files through every layer.
    See ``process_batch``."""
    raw = read_raw_json(spark, raw_path, cfg.schema)
    raw = bronze_ops.add_lineage(bronze_ops.add_position(raw))
    return process_batch(spark, cfg, bronze_ops.classify(raw), batch_id, source=raw_path)


def process_batch(spark: SparkSession, cfg: PipelineConfig, classified: DataFrame,
                  batch_id: int, origin: str = "batch", source: str = "") -> dict:
    """One classified raw batch (position, lineage, ``_status``) through every layer,
    touching only the partitions it has to.

    * Bronze: the batch is its own ``_batch_id=<origin>-<id>`` partition (a rerun
      replaces it; batch and stream ids never meet) and an entry of the batch ledger;
    * Silver: the batch's valid rows are upserted by ``transaction_id`` into
      the date partitions they touch (late and restated rows included).  Of
      several versions in a batch the one that arrived last stays: by file
      time, file, then position in the file;
    * Gold: recomputed for exactly those dates from the Silver table.

    Rows with a NULL ``transaction_id`` cannot be matched; they replace those of
    the same raw files.  A replay of the same files changes nothing.  Where an
    upsert could not give what Bronze and the ledger define (no Silver yet, a batch
    that is in Bronze only, a replay with other files), Silver is rebuilt from Bronze.
    """
    batch = f"{origin}-{int(batch_id)}"
    silver_path, gold_path = cfg.path("silver"), cfg.path("gold")
    t = time.perf_counter()
    known = ledgers.batches(spark, cfg.root)
    entry, before = _load_bronze(spark, cfg, classified, batch, source)
    out: dict = {"batch_id": batch_id, "rows": entry.rows, "bronze_s": time.perf_counter() - t}

    t = time.perf_counter()
    waiting = [b for b, e in known.items() if b != batch and e.state != ledgers.LOADED]
    same = before is not None and before.mark == entry.mark
    if not _exists(spark, silver_path, cfg.fmt) or waiting or (before is not None and not same):
        out.update(rebuild_layers(spark, cfg))
        out["touched_dates"] = len(maintain.touched_values(read_layer(spark, gold_path, cfg.fmt)))
        return out
    touched = []
    if not (same and before.state == ledgers.LOADED):
        accepted = (bronze_ops.read_bronze(spark, cfg.path("bronze"), cfg.fmt)
                    .filter(F.col(BATCH_COL) == F.lit(batch)).drop(BATCH_COL))
        new_silver = ledgers.without_erased(silver_ops.to_silver(accepted, mode=cfg.mask_mode),
                                            ledgers.erased(spark, cfg.root))
        with sized_shuffles(spark, accepted, read_layer(spark, silver_path, cfg.fmt).select(KEY_COL, DATE_COL)):
            touched = maintain.upsert(spark, silver_path, new_silver, key=KEY_COL,
                                      order_col=bronze_ops.POSITION_COLS, fmt=cfg.fmt,
                                      key_scope=cfg.key_scope, null_scope=SOURCE_FILE_COL)["touched"]
        cfg.publish(spark, "silver", touched)
    out["silver_s"] = time.perf_counter() - t
    out["touched_dates"] = len(touched)

    t = time.perf_counter()
    if touched:
        maintain.refresh_gold(spark, silver_path, gold_path, touched, cfg.risk_threshold, cfg.fmt)
        cfg.publish(spark, "gold", touched)
    _loaded(spark, cfg, [batch])
    out["gold_s"] = time.perf_counter() - t
    return out


def erase_subjects(spark: SparkSession, cfg: PipelineConfig, subjects: DataFrame,
                   subject_col: str = "user_id") -> dict:
    """R3 across the layers: record the users in the erasure ledger, then remove their
    rows from Gold, Silver and Bronze.  Gold (one row per user-day) locates the Silver
    partitions to rewrite, so Silver is read only where the users have rows.

    The ledger comes first: if a rewrite fails, a rerun or a rebuild still leaves them
    out.  A raw line that could not be parsed (``_corrupt_record``) names no user and stays.
    """
    ledgers.record_erased(spark, cfg.root, subjects, subject_col)
    gold_path, silver_path, bronze_path = cfg.path("gold"), cfg.path("silver"), cfg.path("bronze")
    gold = read_layer(spark, gold_path, cfg.fmt)
    silver_stats = maintain.erase(spark, silver_path, subjects, subject_col, fmt=cfg.fmt,
                                  locate_in=gold)
    cfg.publish(spark, "silver", silver_stats["touched"])
    gold_stats = maintain.erase(spark, gold_path, subjects, subject_col, fmt=cfg.fmt)
    cfg.publish(spark, "gold", gold_stats["touched"])
    out = {"silver": silver_stats, "gold": gold_stats}
    if _exists(spark, bronze_path, cfg.fmt):
        out["bronze"] = _erase_bronze(spark, bronze_path, subjects, subject_col, cfg.fmt)
    return out


def _erase_bronze(spark: SparkSession, path: str, subjects: DataFrame, subject_col: str, fmt: str) -> dict:
    """Rewrite the batches that hold a row of the subjects."""
    base, layout = read_layer(spark, path, fmt), [BATCH_COL, bronze_ops.STATUS_COL]
    ids = subjects.select(subject_col).where(F.col(subject_col).isNotNull()).distinct()
    held = base.select(subject_col, *layout).distinct()
    touched = [tuple(r) for r in semi_join_keys(held, ids, subject_col).select(*layout).distinct().collect()]
    if not touched:
        return {"rewritten": 0, "emptied": 0}
    scope = base.filter(F.concat_ws("/", *layout).isin(["/".join(t) for t in touched])
                        & F.col(BATCH_COL).isin(sorted({t[0] for t in touched})))
    kept = semi_join_keys(scope.filter(F.col(subject_col).isNotNull()), ids, subject_col, anti=True)
    kept = kept.unionByName(scope.filter(F.col(subject_col).isNull()))
    gone = ["/".join(f"{c}={v}" for c, v in zip(layout, t, strict=True)) for t in touched]
    done = versions.replace(spark, path, kept, layout, fmt, gone=gone, rebalance=False, keep=1)
    return {"rewritten": len(done["written"]), "emptied": len(done["left"])}


def _exists(spark: SparkSession, path: str, fmt: str) -> bool:
    """Whether the layer has data.  Only a missing or an empty path counts as absent;
    any other failure of the read is raised, never taken for an empty table."""
    try:
        read_layer(spark, path, fmt).schema
        return True
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
