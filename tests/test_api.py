"""The reference's entry points run end to end on this package."""

import datetime as dt

from pyspark.sql import functions as F

from cardrisk import api
from cardrisk.operators import generate as gen
from cardrisk.session import scratch_path
from cardrisk.sinks.writers import write_json_lines


def test_phase2_entry_points(spark):
    assert api.get_spark_session() is spark
    day = dt.date(2026, 6, 30)
    df = api.generate_synthetic_transactions(spark, total_rows=5_000, as_of=day)
    assert df.count() == 5_000
    root = scratch_path(spark, "p2api")
    api.save_to_bronze_layer(df, f"{root}/bronze")
    silver = api.build_silver_layer(spark, f"{root}/bronze", f"{root}/silver")
    assert "card_number" not in silver.columns and silver.count() == 5_000
    assert silver.filter(~F.col("card_number_masked").rlike("^4152-XXXX-XXXX-[0-9]{4}$")).count() == 0
    gold = api.build_gold_layer(spark, f"{root}/silver", f"{root}/gold")
    assert gold.agg(F.sum("cantidad_transacciones_diarias")).first()[0] == 5_000
    assert gold.agg(F.max("transaction_date")).first()[0] == day


def test_phase3_entry_points(spark):
    raw = scratch_path(spark, "p3raw")
    write_json_lines(gen.generate(spark, gen.P3Profile(), 5_000, 2), raw,
                     timestamp_format="yyyy-MM-dd'T'HH:mm:ss")
    root = scratch_path(spark, "p3api")
    assert api.run_ingestion(spark, raw, root) == f"{root}/bronze"
    out = api.run_transformations(spark, root)
    assert out == {**out, **{k: v for k, v in api.run_all(spark, raw, root).items() if k.endswith("_rows")}}
    assert out["bronze_rows"] == 5_000 and out["silver_rows"] == 5_000 - 5_000 // 50


def test_run_ingestion_and_p3_silver(spark):
    from cardrisk.operators import bronze, silver
    raw = scratch_path(spark, "p3raw")
    write_json_lines(gen.generate(spark, gen.P3Profile(), 2_000, 2), raw,
                     timestamp_format="yyyy-MM-dd'T'HH:mm:ss")
    out = api.run_ingestion(spark, raw, scratch_path(spark, "p3bronze"))
    accepted = bronze.read_bronze(spark, out)
    assert accepted.count() == 2_000
    sv = silver.to_silver_p3(accepted)
    assert "card" not in sv.columns and sv.count() == 2_000 - 2_000 // 50
    assert sv.filter(~F.col("card_masked").rlike("^[0-9]{4}-XXXX-XXXX-[0-9]{4}$")).count() == 0
