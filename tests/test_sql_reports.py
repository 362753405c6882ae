"""The SQL entry point: the six reports with spark.sql over catalog tables
give the same rows as the DataFrame reports."""

from cardrisk.operators import reports
from cardrisk.plans import catalog
from cardrisk.plans.sql_reports import REPORTS, run_report
from cardrisk.schemas import DATE_COL
from cardrisk.session import scratch_path
from cardrisk.sinks.writers import write_layer
from cardrisk.sources.readers import register_table

from conftest import SF001


def _rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def test_sql_reports_equal_dataframe_reports(spark):
    silver_df, gold_df = catalog.silver(spark, SF001), catalog.gold(spark, SF001)
    names = {}
    for layer, df in (("silver", silver_df), ("gold", gold_df)):
        path = scratch_path(spark, layer)
        write_layer(df, path, partition_by=[DATE_COL])
        names[layer] = register_table(spark, f"{layer}_{path.rsplit('-', 1)[-1]}", path,
                                      partition_by=[DATE_COL], schema=df.schema)
    silver_t, gold_t = spark.table(names["silver"]), spark.table(names["gold"])
    expected = {
        "top_user_days": reports.top_user_days(gold_t, 10),
        "high_risk_list": reports.high_risk_list(gold_t),
        "daily_volume_7d": reports.daily_volume(silver_t, 7),
        "risk_global": reports.risk_global(gold_t),
        "currency_mix": reports.currency_mix(silver_t),
        "layer_counts": reports.layer_counts({"Silver": silver_t, "Gold": gold_t}),
    }
    assert set(expected) == set(REPORTS)
    for name, df in expected.items():
        got = run_report(spark, name, names["silver"], names["gold"])
        assert got.columns == df.columns, name
        assert _rows(got) == _rows(df), name


def test_newest_date_comes_from_catalog_partitions(spark):
    from cardrisk.sources.readers import latest_partition_value
    silver_df = catalog.silver(spark, SF001)
    path = scratch_path(spark, "silver")
    write_layer(silver_df, path, partition_by=[DATE_COL])
    name = register_table(spark, f"silver_{path.rsplit('-', 1)[-1]}", path,
                          partition_by=[DATE_COL], schema=silver_df.schema)
    assert latest_partition_value(spark, name, DATE_COL) == "2024-01-30"
    silver_df.createOrReplaceTempView("silver_view_for_partitions")
    assert latest_partition_value(spark, "silver_view_for_partitions", DATE_COL) is None
