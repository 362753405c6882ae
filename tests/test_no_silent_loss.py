"""Stored data is never cut, replaced or dropped in silence."""

import pytest
from pyspark.sql import functions as F

from cardrisk.functions.hashing import pool_label, zero_pad
from cardrisk.operators import generate
from cardrisk.plans import pipeline
from cardrisk.session import SESSION_DEFAULTS, get_spark_session


def test_long_ids_stay_distinct(spark):
    ids = [7, 10_000_000, 100_000_000, 100_000_009, 1_000_009]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    out = [r[0] for r in df.select(zero_pad(F.col("id").cast("string"), 6)).collect()]
    assert out == ["000007", "10000000", "100000000", "100000009", "1000009"]
    label = [r[0] for r in df.select(pool_label("m_", F.col("id"), 10**9, 3)).collect()]
    assert len(set(label)) == len(ids)


def test_only_a_missing_layer_counts_as_absent(spark, tmp_path, monkeypatch):
    assert not pipeline._exists(spark, f"{tmp_path}/none", "parquet")

    def fails(*a, **k):
        raise RuntimeError("store is down")
    monkeypatch.setattr(pipeline, "read_layer", fails)
    with pytest.raises(RuntimeError):
        pipeline._exists(spark, f"{tmp_path}/none", "parquet")


def test_defaults_do_not_replace_a_running_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_spark_session() is spark and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert "spark.ui.enabled" not in SESSION_DEFAULTS and generate is not None


def test_amounts_that_money_cannot_hold_are_quarantined(spark):
    import datetime as dt
    from cardrisk.operators import bronze, silver
    day = dt.date(2026, 1, 1)
    rows = [(str(i), a, day) for i, a in enumerate([10.0, 1e11, 0.004, float("nan"), float("inf"), -1.0, None])]
    df = bronze.classify(spark.createDataFrame(rows, "card string, amount double, transaction_date date"))
    reasons = {r.card: r[bronze.REASON_COL] for r in df.collect()}
    assert reasons == {"0": None, "1": "amount_range", "2": "amount_rounds_to_zero", "3": None, "4": "amount_range",
                       "5": None, "6": "null_amount"}
    stored = silver.to_silver(df)
    assert stored.filter("amount is null or amount <= 0").count() == 0 and stored.count() == 1


def test_last_arrival_wins_and_replay_adds_nothing(spark, tmp_path):
    """Corrections within one file and across batches; NULL ids once per raw file."""
    import json
    from cardrisk.sources.readers import read_layer
    cfg = pipeline.PipelineConfig(raw_path="", root=f"{tmp_path}/lake")

    def drop(name, rows):
        (tmp_path / name).mkdir()
        lines = [json.dumps({"transaction_id": t, "user_id": "u", "card": "4532015112890367", "amount": a,
                             "transaction_date": "2026-01-01"}) for t, a in rows]
        (tmp_path / name / "part.json").write_text("\n".join(lines))
        return f"{tmp_path}/{name}"

    def stored():
        return sorted(((r.transaction_id or ""), float(r.amount))
                      for r in read_layer(spark, cfg.path("silver")).collect())
    one = drop("one", [("a", 100.0), ("a", 50.0), (None, 7.0)])
    two = drop("two", [("b", 9.0), ("a", 30.0), ("a", 20.0), (None, 8.0)])
    pipeline.run_batch(spark, cfg, one, 1)
    assert stored() == [("", 7.0), ("a", 50.0)]
    for _ in range(2):
        pipeline.run_batch(spark, cfg, two, 2)
        assert stored() == [("", 7.0), ("", 8.0), ("a", 20.0), ("b", 9.0)]


def test_a_table_name_follows_its_location(spark, tmp_path):
    from cardrisk.sources.readers import register_table
    for n in (1, 2, 2):
        spark.range(n).write.mode("overwrite").parquet(f"{tmp_path}/t{n}")
        register_table(spark, "moved_table", f"{tmp_path}/t{n}")
        assert spark.table("moved_table").count() == n
    spark.sql("DROP TABLE moved_table")
