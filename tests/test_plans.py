"""Plan tests: the physical plans are the ones we want at scale."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from cardrisk.operators import gold, joins, reports, silver
from cardrisk.plans import catalog
from cardrisk.plans.timing import plan_text
from cardrisk.schemas import DATE_COL
from cardrisk.sinks.writers import write_layer
from cardrisk.sources.fixtures import load_table, transactions
from cardrisk.sources.readers import read_layer

from conftest import SF001


def _bronze_parquet(spark):
    path = tempfile.mkdtemp(prefix="cardrisk-plan-") + "/bronze"
    transactions(spark, SF001).write.parquet(path)
    return read_layer(spark, path)


def test_amount_filter_is_pushed_to_parquet(spark):
    plan = plan_text(silver.to_silver(_bronze_parquet(spark)))
    assert "PushedFilters: [IsNotNull(amount), GreaterThan(amount,0" in plan


def test_column_pruning_in_gold(spark):
    plan = plan_text(gold.risk_profile(silver.filter_valid(_bronze_parquet(spark))))
    read_schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "card" not in read_schema and "merchant" not in read_schema
    assert "user_id" in read_schema and "amount" in read_schema


def test_partial_aggregation_before_shuffle(spark):
    plan = plan_text(gold.risk_profile(silver.to_silver(transactions(spark, SF001))))
    assert "partial_count" in plan and "partial_sum" in plan
    assert plan.index("partial_count") > plan.index("Exchange")  # printed bottom-up


def test_partition_pruning_on_date(spark):
    path = tempfile.mkdtemp(prefix="cardrisk-plan-") + "/gold"
    write_layer(gold.risk_profile(silver.to_silver(transactions(spark, SF001))), path,
                partition_by=[DATE_COL])
    day = reports.on_day(read_layer(spark, path), "2024-01-15")
    plan = plan_text(day)
    assert "PartitionFilters: [isnotnull(transaction_date" in plan
    assert "(transaction_date" in plan and "= 2024-01-15)" in plan
    assert day.count() > 0


def test_rebalance_before_partitioned_write(spark):
    df = silver.to_silver(transactions(spark, SF001)).hint("rebalance", DATE_COL)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(df)


def test_top_k_is_take_ordered(spark):
    plan = plan_text(reports.top_user_days(catalog.gold(spark, SF001), 10))
    assert "TakeOrderedAndProject" in plan


def test_broadcast_join_only_when_dimension_fits(spark):
    customer = load_table(spark, SF001, "customer")
    nation = load_table(spark, SF001, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    joined, how = joins.join_dimension(customer, nation, "c_nationkey")
    assert how == "broadcast"
    assert "BroadcastHashJoin" in plan_text(joined)
    # a bound the dimension does not meet: no broadcast hint, a shuffled join
    big, how = joins.join_dimension(customer, nation, "c_nationkey", max_rows=10)
    assert how == "shuffle"
    assert big.count() == joined.count()


def test_merge_hint_gives_sort_merge_join(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        customer = load_table(spark, SF001, "customer")
        nation = load_table(spark, SF001, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
        assert "SortMergeJoin" in plan_text(joins.join_merge(customer, nation, "c_nationkey"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_dimension_probe_is_exact_and_single_pass(spark):
    fits, rows, size = joins.dimension_fits(spark.range(1_000_000), max_rows=100)
    assert not fits and rows == 1_000_000 and size > 0
    fits, rows, _ = joins.dimension_fits(spark.range(50), max_rows=100)
    assert fits and rows == 50


def test_distinct_users_without_expand(spark):
    plan = plan_text(reports.risk_global(catalog.gold(spark, SF001)))
    assert "Expand" not in plan


def test_trailing_window_uses_data_date_not_clock(spark):
    out = reports.daily_volume(catalog.silver(spark, SF001), 7).collect()
    assert [r.transaction_date for r in out][0] == dt.date(2024, 1, 30)
    assert len(out) == 8


def test_cache_after_filter_keeps_pruning(spark):
    path = tempfile.mkdtemp(prefix="cardrisk-plan-") + "/silver"
    write_layer(catalog.silver(spark, SF001), path, partition_by=[DATE_COL])
    df = reports.on_day(read_layer(spark, path), "2024-01-15").cache()
    try:
        plan = plan_text(df.groupBy("currency").count())
        assert "InMemoryTableScan" in plan and "PartitionFilters" in plan
    finally:
        df.unpersist()


def test_rebalance_splits_a_hot_date(spark):
    """A date holding a third of the rows is written by several tasks (AQE
    splits the skewed REBALANCE partition), not by one straggler."""
    import glob
    from cardrisk.session import scratch_path
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(dt.date(2024, 1, 1)))
         .otherwise(F.date_add(F.lit(dt.date(2024, 1, 2)), (F.col("id") % 60).cast("int")))
         .alias(DATE_COL),
        F.md5(F.col("id").cast("string")).alias("payload"))
    path = scratch_path(spark, "skew")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_layer(df, path, partition_by=[DATE_COL])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = glob.glob(f"{path}/{DATE_COL}=2024-01-01/*.parquet")
    cold = glob.glob(f"{path}/{DATE_COL}=2024-01-03/*.parquet")
    assert len(hot) > 1 and len(cold) >= 1
    assert read_layer(spark, path).count() == 300_000


def test_catalog_table_lists_only_pruned_partitions(spark):
    from cardrisk.session import scratch_path
    from cardrisk.sources.readers import register_table, sync_partitions
    path = scratch_path(spark, "gold")
    gold_df = gold.risk_profile(silver.to_silver(transactions(spark, SF001)))
    write_layer(gold_df.filter(F.col(DATE_COL) < F.lit(dt.date(2024, 1, 20))), path,
                partition_by=[DATE_COL])
    name = "gold_" + path.rsplit("-", 1)[-1]
    register_table(spark, name, path, partition_by=[DATE_COL])
    day = spark.table(name).filter(F.col(DATE_COL) == F.lit(dt.date(2024, 1, 15)))
    plan = plan_text(day)
    assert "Location: InMemoryFileIndex" in plan and "transaction_date=2024-01-15]" in plan
    # a later incremental write by path becomes visible after syncing its partitions
    later = gold_df.filter(F.col(DATE_COL) >= F.lit(dt.date(2024, 1, 20)))
    write_layer(later, path, partition_by=[DATE_COL], dynamic=True)
    sync_partitions(spark, name, DATE_COL,
                    [r[0] for r in later.select(DATE_COL).distinct().collect()])
    assert spark.table(name).count() == gold_df.count()
