"""End-to-end: generated raw JSON drop -> Bronze -> Silver -> Gold (C7),
with the phase-3 acceptance rule silver = n - n/50."""

from cardrisk.operators import generate as gen
from cardrisk.plans.pipeline import PipelineConfig, run_pipeline, run_pipeline_p2
from cardrisk.session import scratch_path
from cardrisk.sinks.writers import write_json_lines


def test_p3_pipeline_counts(spark):
    n = 20_000
    raw = scratch_path(spark, "raw")
    write_json_lines(gen.generate(spark, gen.P3Profile(), n, 4), raw, records_per_file=5_000,
                     timestamp_format="yyyy-MM-dd'T'HH:mm:ss")
    out = run_pipeline(spark, PipelineConfig(raw_path=raw, root=scratch_path(spark, "lake")))
    assert out["bronze_rows"] == n
    assert out["silver_rows"] == n - n // 50
    assert 0 < out["gold_rows"] <= out["silver_rows"]


def test_p2_pipeline_counts(spark):
    out = run_pipeline_p2(spark, scratch_path(spark, "lake2"), 10_000)
    assert out["bronze_rows"] == out["silver_rows"] == 10_000
    assert out["gold_rows"] > 0


def test_batches_equal_one_full_run(spark):
    """Two daily batches plus a restated batch give the same Gold as one full run."""
    import datetime as dt
    from pyspark.sql import functions as F
    from cardrisk.plans.pipeline import run_batch
    from cardrisk.sources.readers import read_layer
    data = gen.generate(spark, gen.P3Profile(), 20_000, 4)
    cut = F.lit(dt.date(2026, 3, 1))
    parts = [data.filter(F.col("transaction_date") < cut), data.filter(F.col("transaction_date") >= cut),
             data.filter(F.col("transaction_date") >= cut).limit(500)]
    cfg = PipelineConfig(raw_path="", root=scratch_path(spark, "inc"))
    for i, part in enumerate(parts, 1):
        raw = scratch_path(spark, f"raw{i}")
        write_json_lines(part, raw, timestamp_format="yyyy-MM-dd'T'HH:mm:ss")
        stats = run_batch(spark, cfg, raw, i)
        assert stats["touched_dates"] > 0
    full_raw = scratch_path(spark, "rawall")
    write_json_lines(data, full_raw, timestamp_format="yyyy-MM-dd'T'HH:mm:ss")
    full = PipelineConfig(raw_path=full_raw, root=scratch_path(spark, "full"))
    run_pipeline(spark, full)
    a = read_layer(spark, cfg.path("gold"))
    b = read_layer(spark, full.path("gold")).select(*a.columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_erase_subjects_from_silver_and_gold(spark):
    from pyspark.sql import functions as F
    from cardrisk.plans.pipeline import erase_subjects
    from cardrisk.sources.readers import read_layer
    n = 20_000
    raw = scratch_path(spark, "raw")
    write_json_lines(gen.generate(spark, gen.P3Profile(), n, 4), raw,
                     timestamp_format="yyyy-MM-dd'T'HH:mm:ss")
    cfg = PipelineConfig(raw_path=raw, root=scratch_path(spark, "lake"),
                         tables={"silver": "silver_" + raw.rsplit("-", 1)[-1],
                                 "gold": "gold_" + raw.rsplit("-", 1)[-1]})
    before = run_pipeline(spark, cfg)
    victims = read_layer(spark, cfg.path("gold")).groupBy("user_id").count() \
        .orderBy(F.desc("count"), "user_id").limit(3).select("user_id")
    names = [r.user_id for r in victims.collect()]
    victim_rows = read_layer(spark, cfg.path("silver")).filter(F.col("user_id").isin(names)).count()
    erase_subjects(spark, cfg, spark.createDataFrame([(u,) for u in names], "user_id string"))
    silver_after = spark.table(cfg.tables["silver"])
    assert silver_after.filter(F.col("user_id").isin(names)).count() == 0
    assert silver_after.count() == before["silver_rows"] - victim_rows
    assert spark.table(cfg.tables["gold"]).filter(F.col("user_id").isin(names)).count() == 0
