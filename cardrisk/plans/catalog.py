"""The registered query catalogue.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built over the
whole driver tables.  Outputs use oracle-friendly types: money leaves as
DOUBLE (after an exact DECIMAL sum), counts as BIGINT.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bronze as bronze_ops
from ..operators import generate as gen
from ..operators import gold as gold_ops
from ..operators import joins, maintain, quality, reports
from ..operators import silver as silver_ops
from ..operators.caching import cached
from ..schemas import DATE_COL, TX_RAW_SCHEMA
from ..session import checkpoint_root, scratch_path
from ..sinks.writers import write_layer, write_text_lines
from ..sources.fixtures import load_table, transactions, transactions_json_lines
from ..sources.readers import conform, read_raw_json_inferred, read_layer, read_raw_json, register_table
from ..streaming.filedrop import ingest_available
from .params import (BASE_BEFORE, CORRECTIONS_FROM, DAY, ERASE_USERS, MOVED_MERCHANT, ODD_AMOUNTS,
                     SPLIT_HOUR, UPSERT_FROM)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str) -> Callable[[QueryFn], QueryFn]:
    """Register a query; its result leaves through ``oracle_types``."""
    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return oracle_types(fn(spark, sf_dir))
        run.__name__ = run.__qualname__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return wrap


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to DOUBLE (output normalisation only)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields])


def oracle_types(df: DataFrame) -> DataFrame:
    """Output normalisation for the comparison with the SQL oracle: DECIMAL
    -> DOUBLE (after exact sums) and DATE -> TIMESTAMP_NTZ at midnight (the
    driver tables carry their dates as timestamps, so results do too).
    The library functions themselves keep DECIMAL money and DATE columns."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in df.schema.fields])


# -- shared plans -----------------------------------------------------------

def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str, mode: str = "affix") -> DataFrame:
    return silver_ops.to_silver(tx(spark, sf_dir), mode=mode)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_ops.risk_profile(silver(spark, sf_dir))


def gold_p2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_ops.daily_features(silver(spark, sf_dir, mode="regex"))


# -- Silver / Gold -----------------------------------------------------------

@register("silver_affix_mask")
def q_silver_affix(spark, sf_dir):
    return decimals_as_double(silver(spark, sf_dir, "affix"))


@register("silver_regex_mask")
def q_silver_regex(spark, sf_dir):
    return decimals_as_double(silver(spark, sf_dir, "regex"))


@register("silver_strict_mask")
def q_silver_strict(spark, sf_dir):
    return decimals_as_double(silver(spark, sf_dir, "strict"))


@register("gold_risk_profile")
def q_gold_risk(spark, sf_dir):
    return decimals_as_double(gold(spark, sf_dir))


@register("gold_daily_features")
def q_gold_daily(spark, sf_dir):
    return decimals_as_double(gold_p2(spark, sf_dir))


# -- reports -------------------------------------------------------------------

@register("top_user_days")
def q_top10(spark, sf_dir):
    return decimals_as_double(reports.top_user_days(gold(spark, sf_dir), 10))


@register("top5_user_days")
def q_top5(spark, sf_dir):
    return decimals_as_double(reports.top_user_days(gold(spark, sf_dir), 5))


@register("high_risk_list")
def q_high_risk(spark, sf_dir):
    return decimals_as_double(reports.high_risk_list(gold(spark, sf_dir)))


@register("daily_volume_7d")
def q_daily_volume(spark, sf_dir):
    return reports.daily_volume(silver(spark, sf_dir), days=7)


@register("risk_global")
def q_risk_global(spark, sf_dir):
    return reports.risk_global(gold(spark, sf_dir))


@register("currency_mix")
def q_currency_mix(spark, sf_dir):
    return reports.currency_mix(silver(spark, sf_dir))


@register("layer_counts")
def q_layer_counts(spark, sf_dir):
    return reports.layer_counts({"Silver": silver(spark, sf_dir), "Gold": gold(spark, sf_dir)})


@register("category_day_count")
def q_category_day(spark, sf_dir):
    return reports.category_day_count(silver(spark, sf_dir), DAY)


@register("risk_day_histogram")
def q_risk_day(spark, sf_dir):
    return reports.risk_day_histogram(gold_p2(spark, sf_dir), DAY)


@register("distinct_users")
def q_distinct_users(spark, sf_dir):
    return reports.distinct_users(gold(spark, sf_dir))


# -- generators (ids = the events ids, so the work grows with the tables) ------

def event_ids(spark, sf_dir):
    return gen.ids_from(load_table(spark, sf_dir, "events"), "event_id")


@register("generate_p2")
def q_generate_p2(spark, sf_dir):
    return decimals_as_double(gen.generate_p2(event_ids(spark, sf_dir)))


@register("generate_p3")
def q_generate_p3(spark, sf_dir):
    return gen.generate_p3(event_ids(spark, sf_dir))


@register("generate_demo")
def q_generate_demo(spark, sf_dir):
    return gen.generate_demo(event_ids(spark, sf_dir))


@register("generate_lognormal")
def q_generate_lognormal(spark, sf_dir):
    p = gen.P3Profile()
    return event_ids(spark, sf_dir).select(
        "id", gen.lognormal_pool_amount(F.col("id"), p.salt, p.amount_pool, p.mu, p.sigma)
        .alias("amount"))


@register("generate_gauss")
def q_generate_gauss(spark, sf_dir):
    p = gen.DemoProfile()
    return event_ids(spark, sf_dir).select(
        "id", gen.folded_gauss_amount(F.col("id"), p.salt, p.mean, p.std).alias("amount"))


# -- quality -----------------------------------------------------------------------

@register("reconcile_layers")
def q_reconcile(spark, sf_dir):
    return quality.reconcile_layers(tx(spark, sf_dir))


@register("run_summary")
def q_run_summary(spark, sf_dir):
    return quality.run_summary(tx(spark, sf_dir), silver(spark, sf_dir), gold(spark, sf_dir))


@register("pii_leak_scan")
def q_pii_leak_scan(spark, sf_dir):
    scans = [quality.pii_leak_scan(silver(spark, sf_dir, mode), f"silver_{mode}")
             for mode in ("affix", "regex", "strict")]
    out = scans[0]
    for other in scans[1:]:
        out = out.unionByName(other)
    return out


@register("card_number_scan")
def q_card_number_scan(spark, sf_dir):
    """Card numbers of the raw records in every form: as text, with separators and a date
    behind, as numbers and nested; beside them epoch times of the same lengths."""
    card, millis = F.col("card"), F.unix_millis(F.col("event_ts").cast("timestamp"))
    spaced = F.regexp_replace(card, "([0-9]{4})", "$1 ")
    rows = tx(spark, sf_dir).select(
        "card", F.concat(spaced, F.date_format("event_ts", "yyyy-MM-dd")).alias("spaced"),
        card.cast("decimal(20,0)").alias("number"), card.cast("long").alias("whole"),
        F.struct(F.array(F.lit("none"), F.concat(F.lit("card "), card)).alias("notes")).alias("nested"),
        millis.alias("millis"), (millis * 1000).cast("string").alias("micros"))
    return quality.card_scan(rows, "raw")


# -- bronze: raw JSON drop, batch and streaming ingestion --------------------------

def json_drop(spark, sf_dir) -> str:
    """Write the fixture as a raw JSON Lines drop (K4) with injected bad lines."""
    path = scratch_path(spark, "raw")
    write_text_lines(transactions_json_lines(tx(spark, sf_dir)), path, records_per_file=50_000)
    return path


@register("bronze_lineage")
def q_bronze_lineage(spark, sf_dir):
    raw = json_drop(spark, sf_dir)
    bronze = scratch_path(spark, "bronze")
    bronze_ops.ingest_bronze(spark, raw, bronze, TX_RAW_SCHEMA)
    return bronze_ops.read_bronze(spark, bronze)


@register("bronze_rejects")
def q_bronze_rejects(spark, sf_dir):
    """Reject reasons counted from the quarantine that ingestion wrote."""
    bronze = scratch_path(spark, "bronze")
    bronze_ops.ingest_bronze(spark, json_drop(spark, sf_dir), bronze, TX_RAW_SCHEMA)
    return bronze_ops.reject_counts(bronze_ops.read_bronze(spark, bronze, status=bronze_ops.REJECTED))


@register("quarantine_amounts")
def q_quarantine_amounts(spark, sf_dir):
    """Amounts that money cannot hold: every row of the fixture, with the amounts of
    four merchants replaced, through Bronze (quarantined with a reason) into Silver."""
    amount, merchant = F.col("amount").cast("double"), F.col("merchant")
    odd = F.lit(None).cast("double")
    for name, value in ODD_AMOUNTS.items():
        odd = F.when(merchant == F.lit(name), F.lit(value).cast("double")).otherwise(odd)
    rows = tx(spark, sf_dir).withColumn(
        "amount", F.when(amount.isNotNull(), F.coalesce(odd, amount)))
    path = scratch_path(spark, "bronze")
    bronze_ops.save_to_bronze(bronze_ops.classify(rows), path, partition_by=[bronze_ops.STATUS_COL])
    kept = silver_ops.to_silver(bronze_ops.read_bronze(spark, path))
    gone = bronze_ops.read_bronze(spark, path, status=bronze_ops.REJECTED)
    kept = kept.groupBy("merchant", F.lit("silver").alias("outcome")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").cast("double").alias("total"))
    gone = gone.groupBy("merchant", F.col(bronze_ops.REASON_COL).alias("outcome")).agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(0.0).alias("total"))
    return kept.unionByName(gone)


@register("bronze_quarantine")
def q_bronze_quarantine(spark, sf_dir):
    """The quarantine partition of Bronze after ingesting the raw drop: the
    reject reason and the fields Spark could parse (a truncated line parses
    to NULLs, a wrong-typed line keeps its other fields)."""
    raw = json_drop(spark, sf_dir)
    bronze = scratch_path(spark, "bronze")
    bronze_ops.ingest_bronze(spark, raw, bronze, TX_RAW_SCHEMA)
    rejected = bronze_ops.read_bronze(spark, bronze, status=bronze_ops.REJECTED)
    # user_id is NULL on unparseable lines; it leaves as text so a NULL id
    # does not turn the whole column into floats in a pandas comparison
    return rejected.select(F.col(bronze_ops.REASON_COL).alias("reason"), "transaction_id",
                           F.col("user_id").cast("string").alias("user_id"), "amount", DATE_COL,
                           "merchant")


@register("bronze_stream_ingest")
def q_bronze_stream(spark, sf_dir):
    raw = json_drop(spark, sf_dir)
    bronze, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "stream-ckpt")
    ingest_available(spark, raw, bronze, ckpt, TX_RAW_SCHEMA)
    ingest_available(spark, raw, bronze, ckpt, TX_RAW_SCHEMA)   # second run adds nothing
    cols = [f.name for f in TX_RAW_SCHEMA.fields]
    return bronze_ops.read_bronze(spark, bronze).select(*cols)


# -- layout and joins ------------------------------------------------------------------

@register("partitioned_roundtrip")
def q_partitioned_roundtrip(spark, sf_dir):
    """K3 + S6: Gold written by date, registered as a catalog table with
    tracked partitions, read back with a date range (only the matching
    partition directories are listed and scanned)."""
    path = scratch_path(spark, "gold")
    write_layer(gold(spark, sf_dir), path, partition_by=[DATE_COL])
    name = "gold_" + path.rsplit("-", 1)[-1]
    register_table(spark, name, path, partition_by=[DATE_COL])
    back = spark.table(name).filter(F.col(DATE_COL) >= F.lit(_dt.date.fromisoformat(DAY)))
    return decimals_as_double(back.select(*reports.GOLD_REPORT_COLUMNS))


def _customers_by_nation(joined: DataFrame) -> DataFrame:
    return (joined.groupBy("n_name")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.sum(F.col("c_acctbal").cast("decimal(15,2)")).cast("double")
                  .alias("total_acctbal")))


@register("join_broadcast_dim")
def q_join_broadcast(spark, sf_dir):
    customer = load_table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    nation = load_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined, _ = joins.join_dimension(customer, nation, "c_nationkey")
    return _customers_by_nation(joined)


@register("join_merge_dim")
def q_join_merge(spark, sf_dir):
    customer = load_table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    nation = load_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return _customers_by_nation(joins.join_merge(customer, nation, "c_nationkey"))


def lineitem_by_supplier_nation(joined: DataFrame) -> DataFrame:
    return (joined.groupBy("s_nationkey")
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum(F.col("l_quantity").cast("decimal(15,2)")).cast("double").alias("quantity"),
                 F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast("double")
                  .alias("revenue")))


def lineitem_supplier(spark, sf_dir):
    lineitem = load_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("suppkey"), "l_quantity", "l_extendedprice")
    supplier = load_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), "s_nationkey")
    return lineitem, supplier


@register("join_fact_dim")
def q_join_fact_dim(spark, sf_dir):
    """J1 at fact scale: lineitem joined with the supplier dimension (broadcast
    only behind the size check), revenue per supplier nation."""
    lineitem, supplier = lineitem_supplier(spark, sf_dir)
    joined, _ = joins.join_dimension(lineitem, supplier, "suppkey")
    return lineitem_by_supplier_nation(joined)


# -- maintenance (R1-R5) ------------------------------------------------------------

def _d(text: str) -> _dt.date:
    return _dt.date.fromisoformat(text)


def _silver_table(spark, sf_dir, df=None) -> str:
    """Write Silver (or ``df``) as a date-partitioned table in the scratch area."""
    path = scratch_path(spark, "silver")
    write_layer(silver(spark, sf_dir) if df is None else df, path, partition_by=[DATE_COL])
    return path


def _silver_out(df: DataFrame) -> DataFrame:
    cols = ["transaction_id", "user_id", "card_masked", "amount", DATE_COL, "event_ts",
            "merchant", "merchant_category", "currency", "is_fraud_suspect"]
    extra = [c for c in df.columns if c not in cols]
    return decimals_as_double(df.select(*cols, *extra))


def _incremental_tables(spark, sf_dir) -> tuple[str, str]:
    """R1 scenario: the first load holds only the morning of DAY; the full day
    then arrives and replaces that one partition in Silver and in Gold."""
    full = silver(spark, sf_dir)
    first = full.filter(~((F.col(DATE_COL) == F.lit(_d(DAY)))
                          & (F.hour("event_ts") >= F.lit(SPLIT_HOUR))))
    silver_path = _silver_table(spark, sf_dir, first)
    gold_path = scratch_path(spark, "gold")
    write_layer(gold_ops.risk_profile(read_layer(spark, silver_path)), gold_path,
                partition_by=[DATE_COL])
    day = full.filter(F.col(DATE_COL) == F.lit(_d(DAY)))
    maintain.replace_partitions(day, silver_path)
    maintain.refresh_gold(spark, silver_path, gold_path, [_d(DAY)])
    return silver_path, gold_path


@register("incremental_day")
def q_incremental_day(spark, sf_dir):
    silver_path, _ = _incremental_tables(spark, sf_dir)
    return _silver_out(read_layer(spark, silver_path))


@register("incremental_gold")
def q_incremental_gold(spark, sf_dir):
    _, gold_path = _incremental_tables(spark, sf_dir)
    return decimals_as_double(read_layer(spark, gold_path).select(*reports.GOLD_REPORT_COLUMNS))


@register("upsert_transactions")
def q_upsert(spark, sf_dir):
    full = silver(spark, sf_dir)
    path = _silver_table(spark, sf_dir, full.filter(F.col(DATE_COL) < F.lit(_d(BASE_BEFORE))))
    recent = full.filter((F.col(DATE_COL) >= F.lit(_d(UPSERT_FROM)))
                         & F.col("transaction_id").isNotNull())
    v1 = recent.withColumns({"amount": F.col("amount") + 1, "_seq": F.lit(1)})
    v2 = recent.withColumns({
        "amount": F.col("amount") + 2, "_seq": F.lit(2),
        DATE_COL: F.when(F.col("merchant") == F.lit(MOVED_MERCHANT), F.date_sub(DATE_COL, 1))
                   .otherwise(F.col(DATE_COL))})
    maintain.upsert(spark, path, v1.unionByName(v2), order_col="_seq")
    return _silver_out(read_layer(spark, path))


@register("erase_user")
def q_erase(spark, sf_dir):
    path = _silver_table(spark, sf_dir)
    request = spark.createDataFrame([(u,) for u in ERASE_USERS], "user_id bigint")
    maintain.erase(spark, path, request)
    return _silver_out(read_layer(spark, path))


def _history(spark, sf_dir) -> str:
    """R4 scenario: batch 1 = Silver, batch 2 = corrections (amount + 1) of the last days."""
    path = scratch_path(spark, "history")
    full = silver(spark, sf_dir)
    maintain.append_batch(full, path, 1)
    corrections = full.filter((F.col(DATE_COL) >= F.lit(_d(CORRECTIONS_FROM)))
                              & F.col("transaction_id").isNotNull())
    maintain.append_batch(corrections.withColumn("amount", (F.col("amount") + 1)
                                                 .cast("decimal(12,2)")), path, 2)
    return path


@register("as_of_batch")
def q_as_of(spark, sf_dir):
    return _silver_out(maintain.read_as_of(spark, _history(spark, sf_dir), 1))


def _versions(spark, sf_dir) -> str:
    """The same scenario as an interval-coded history."""
    path = scratch_path(spark, "versions")
    full = silver(spark, sf_dir)
    maintain.append_version(full, path, 1)
    recent = full.filter((F.col(DATE_COL) >= F.lit(_d(CORRECTIONS_FROM))) & F.col("transaction_id").isNotNull())
    maintain.append_version(recent.withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)")), path, 2)
    return path


@register("latest_as_of")
def q_latest_as_of(spark, sf_dir):
    return _silver_out(maintain.read_version(spark, _versions(spark, sf_dir), 2))


@register("version_as_of_first")
def q_version_as_of_first(spark, sf_dir):
    """The history as it was before its last batch."""
    return _silver_out(maintain.read_version(spark, _versions(spark, sf_dir), 1))


@register("log_latest_as_of")
def q_log_latest_as_of(spark, sf_dir):
    """The latest version of each key, picked from the append-only log."""
    return _silver_out(maintain.read_as_of(spark, _history(spark, sf_dir), 2, key="transaction_id"))


@register("published_gold")
def q_published_gold(spark, sf_dir):
    return decimals_as_double(maintain.published_view(gold(spark, sf_dir), "gold", "analyst"))


# -- caching -----------------------------------------------------------------------

@register("cached_filter")
def q_cached_filter(spark, sf_dir):
    checkpoint_root(spark)
    day = reports.on_day(silver(spark, sf_dir), DAY).select("merchant_category")
    with cached(day) as hot:
        # the day is already selected: grouping the cached frame itself reads the cache
        result = hot.groupBy("merchant_category").agg(F.count(F.lit(1)).alias("count"))
        result = result.checkpoint(eager=True)
    return result


# -- the whole pipeline, batch by batch (R1 + C7) ----------------------------------

@register("incremental_batches")
def q_incremental_batches(spark, sf_dir):
    """Three raw JSON batches through Bronze -> Silver -> Gold with
    ``run_batch``: the days before DAY, the days from DAY on, then a
    restatement of the two days before DAY (idempotent keyed upsert)."""
    from .pipeline import PipelineConfig, run_batch
    full = tx(spark, sf_dir)
    day, date = F.lit(_d(DAY)), F.col(DATE_COL)
    batches = [full.filter(date < day), full.filter(date >= day),
               full.filter((date >= F.date_sub(day, 2)) & (date < day)
                           & F.col("transaction_id").isNotNull())]
    cfg = PipelineConfig(raw_path="", root=scratch_path(spark, "lake"), schema=TX_RAW_SCHEMA)
    for batch_id, batch in enumerate(batches, 1):
        raw = scratch_path(spark, f"raw-batch{batch_id}")
        write_text_lines(transactions_json_lines(batch), raw)
        run_batch(spark, cfg, raw, batch_id)
    return decimals_as_double(read_layer(spark, cfg.path("gold"))
                              .select(*reports.GOLD_REPORT_COLUMNS))


@register("full_then_incremental")
def q_full_then_incremental(spark, sf_dir):
    """A full load of the days before DAY, then one increment on the same root: the
    days from DAY on (NULL ids included), where a second file corrects every
    amount by +1.  The increment runs twice; the replay changes nothing."""
    from .pipeline import PipelineConfig, run_batch, run_pipeline
    full, date, day = tx(spark, sf_dir), F.col(DATE_COL), F.lit(_d(DAY))
    raw, drop = scratch_path(spark, "raw-full"), scratch_path(spark, "raw-day")
    write_text_lines(transactions_json_lines(full.filter(date < day)), raw)
    first = full.filter(date >= day)
    fixed = first.filter(F.col("transaction_id").isNotNull()).withColumn(
        "amount", F.when(F.col("amount") > 0, (F.col("amount") + 1).cast("decimal(12,2)")).otherwise(F.col("amount")))
    write_text_lines(transactions_json_lines(first), f"{drop}/1")
    write_text_lines(transactions_json_lines(fixed), f"{drop}/2")
    cfg = PipelineConfig(raw_path=raw, root=scratch_path(spark, "lake"), schema=TX_RAW_SCHEMA)
    run_pipeline(spark, cfg)
    for _ in range(2):
        run_batch(spark, cfg, f"{drop}/*", 1)
    return _silver_out(read_layer(spark, cfg.path("silver")).drop("_ingestion_ts", "_source_file"))


def _lake(spark, raw: str = ""):
    from .pipeline import PipelineConfig
    return PipelineConfig(raw_path=raw, root=scratch_path(spark, "lake"), schema=TX_RAW_SCHEMA)


def _drop(spark, rows: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    write_text_lines(transactions_json_lines(rows), path)
    return path


@register("rebuild_keeps_increments")
def q_rebuild_keeps_increments(spark, sf_dir):
    """C7 + R1: a full load of the days before DAY, an increment with the later days (every
    amount corrected by +1 in a second file), then the full load again: Silver is
    rebuilt from all of Bronze, the increment included."""
    from .pipeline import run_batch, run_pipeline
    full, late = tx(spark, sf_dir), F.col(DATE_COL) >= F.lit(_d(DAY))
    cfg = _lake(spark, _drop(spark, full.filter(~late), "raw-full"))
    first = full.filter(late)
    drop = scratch_path(spark, "raw-day")
    write_text_lines(transactions_json_lines(first), f"{drop}/1")
    write_text_lines(transactions_json_lines(_corrected(first)), f"{drop}/2")
    run_pipeline(spark, cfg)
    run_batch(spark, cfg, f"{drop}/*", 1)
    run_pipeline(spark, cfg)
    return _silver_out(read_layer(spark, cfg.path("silver")).drop("_ingestion_ts", "_source_file"))


def _corrected(rows: DataFrame) -> DataFrame:
    """The rows with a key, positive amounts one unit higher."""
    higher = F.when(F.col("amount") > 0, (F.col("amount") + 1).cast("decimal(12,2)")).otherwise(F.col("amount"))
    return rows.filter(F.col("transaction_id").isNotNull()).withColumn("amount", higher)


@register("one_lake_any_order")
def q_one_lake(spark, sf_dir):
    """C3, C7, R1 on one root: the first third of the month is ingested into Bronze only, the
    second comes as an increment (which takes the ingested rows up), the last as a
    stream; then a full run over the first third again."""
    from ..streaming.filedrop import run_stream_pipeline
    from .pipeline import ingest, run_batch, run_pipeline
    full, day = tx(spark, sf_dir), F.dayofmonth(DATE_COL)
    cfg = _lake(spark, _drop(spark, full.filter(day <= 10), "raw-first"))
    ingest(spark, cfg)
    run_batch(spark, cfg, _drop(spark, full.filter((day > 10) & (day <= 20)), "raw-second"), 7)
    run_stream_pipeline(spark, cfg, _drop(spark, full.filter(day > 20), "raw-third"), scratch_path(spark, "ckpt"))
    run_pipeline(spark, cfg)
    return _silver_out(read_layer(spark, cfg.path("silver")).drop("_ingestion_ts", "_source_file"))


@register("erase_then_rebuild")
def q_erase_then_rebuild(spark, sf_dir):
    """R3 + C7: users are erased from every layer; neither a full load of the same raw
    drop nor an increment that names them again brings them back."""
    from .pipeline import erase_subjects, run_batch, run_pipeline
    full = tx(spark, sf_dir)
    raw = _drop(spark, full, "raw-full")
    cfg = _lake(spark, raw)
    run_pipeline(spark, cfg)
    erase_subjects(spark, cfg, spark.createDataFrame([(u,) for u in ERASE_USERS], "user_id bigint"))
    run_pipeline(spark, cfg)
    again = _corrected(full.filter(F.col("user_id").isin(list(ERASE_USERS))))
    run_batch(spark, cfg, _drop(spark, again, "raw-again"), 1)
    return _silver_out(read_layer(spark, cfg.path("silver")).drop("_ingestion_ts", "_source_file"))


@register("batch_ledger")
def q_batch_ledger(spark, sf_dir):
    """The ledger of a full load and two increments: files, rows and accepted rows of each."""
    from . import ledgers
    from .pipeline import run_batch, run_pipeline
    full, day = tx(spark, sf_dir), F.dayofmonth(DATE_COL)
    cfg = _lake(spark, _drop(spark, full.filter(day <= 10), "raw-first"))
    run_pipeline(spark, cfg)
    run_batch(spark, cfg, _drop(spark, full.filter((day > 10) & (day <= 20)), "raw-second"), 1)
    run_batch(spark, cfg, _drop(spark, full.filter(day > 20), "raw-third"), 2)
    events = ledgers.read_batches(spark, cfg.root)
    newest = events.groupBy("batch").agg(F.max_by(F.struct("seq", "state", "rows", "accepted"), "event").alias("e"))
    return newest.select("batch", "e.*")


@register("phase2_layers")
def q_phase2_layers(spark, sf_dir):
    """The phase-2 flow on disk: Bronze as given, Silver with the card
    masked, daily features."""
    from .. import api
    root = scratch_path(spark, "p2")
    bronze = tx(spark, sf_dir).withColumnRenamed("card", "card_number")
    api.save_to_bronze_layer(bronze, f"{root}/bronze")
    api.build_silver_layer(spark, f"{root}/bronze", f"{root}/silver")
    return decimals_as_double(api.build_gold_layer(spark, f"{root}/silver", f"{root}/gold"))


@register("conformed_json")
def q_conformed_json(spark, sf_dir):
    """S1 inferred, X13, X14: a JSON drop read with inference, then conformed to the declared schema."""
    path = scratch_path(spark, "raw")
    write_text_lines(transactions_json_lines(tx(spark, sf_dir), defects=False), path)
    return conform(read_raw_json_inferred(spark, path), TX_RAW_SCHEMA)


@register("stream_file_drops")
def q_stream_file_drops(spark, sf_dir):
    """Two file drops streamed through Bronze -> Silver -> Gold with
    ``readStream`` + ``trigger(availableNow)`` + ``foreachBatch`` (run once per drop)."""
    from ..streaming.filedrop import run_stream_pipeline
    from .pipeline import PipelineConfig
    full = tx(spark, sf_dir)
    day, date = F.lit(_d(DAY)), F.col(DATE_COL)
    raw, ckpt = scratch_path(spark, "stream-raw"), scratch_path(spark, "stream-ckpt")
    cfg = PipelineConfig(raw_path="", root=scratch_path(spark, "stream-lake"), schema=TX_RAW_SCHEMA)
    for name, part in (("d1", full.filter(date < day)), ("d2", full.filter(date >= day))):
        write_text_lines(transactions_json_lines(part), f"{raw}/{name}")
        run_stream_pipeline(spark, cfg, f"{raw}/*", ckpt)
    return decimals_as_double(read_layer(spark, cfg.path("gold"))
                              .select(*reports.GOLD_REPORT_COLUMNS))


# -- the six reports through the SQL entry point (S6) ------------------------------

def _sql_report(name: str) -> QueryFn:
    def run(spark, sf_dir):
        from .sql_reports import run_report
        suffix = scratch_path(spark, "v").rsplit("-", 1)[-1]
        silver_view, gold_view = f"silver_{suffix}", f"gold_{suffix}"
        silver(spark, sf_dir).createOrReplaceTempView(silver_view)
        gold(spark, sf_dir).createOrReplaceTempView(gold_view)
        return decimals_as_double(run_report(spark, name, silver_view, gold_view))
    run.__name__ = f"q_sql_{name}"
    return run


for _name in ("top_user_days", "high_risk_list", "daily_volume_7d", "risk_global",
              "currency_mix", "layer_counts"):
    register(f"sql_{_name}")(_sql_report(_name))
