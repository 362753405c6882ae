"""availableNow file-drop ingestion: exactly the new files, once."""

from cardrisk.operators import bronze
from cardrisk.schemas import TX_RAW_SCHEMA
from cardrisk.session import scratch_path
from cardrisk.sinks.writers import write_text_lines
from cardrisk.sources.fixtures import transactions, transactions_json_lines
from cardrisk.streaming.filedrop import ingest_available

from conftest import SF001


def test_available_now_is_incremental(spark):
    tx = transactions(spark, SF001)
    raw, out, ckpt = (scratch_path(spark, n) for n in ("raw", "bronze", "ckpt"))
    early = tx.filter("transaction_date < DATE'2024-01-15'")
    late = tx.filter("transaction_date >= DATE'2024-01-15'")
    write_text_lines(transactions_json_lines(early, defects=False), raw + "/day1")
    first = ingest_available(spark, raw + "/*", out, ckpt, TX_RAW_SCHEMA)
    assert first == early.count()
    assert ingest_available(spark, raw + "/*", out, ckpt, TX_RAW_SCHEMA) == 0
    write_text_lines(transactions_json_lines(late, defects=False), raw + "/day2")
    assert ingest_available(spark, raw + "/*", out, ckpt, TX_RAW_SCHEMA) == late.count()
    total = bronze.read_bronze(spark, out).count() + \
        bronze.read_bronze(spark, out, status="rejected").count()
    assert total == tx.count()


def test_stream_pipeline_matches_batch_pipeline(spark):
    """File drops streamed through Bronze -> Silver -> Gold (foreachBatch) give
    the same Gold as the batch pipeline over all files; a rerun is a no-op."""
    from cardrisk.plans.pipeline import PipelineConfig, run_pipeline
    from cardrisk.sources.readers import read_layer
    from cardrisk.streaming.filedrop import run_stream_pipeline
    tx = transactions(spark, SF001)
    raw, ckpt = scratch_path(spark, "sraw"), scratch_path(spark, "sckpt")
    cfg = PipelineConfig(raw_path="", root=scratch_path(spark, "slake"), schema=TX_RAW_SCHEMA)
    write_text_lines(transactions_json_lines(tx.filter("transaction_date < DATE'2024-01-15'")),
                     raw + "/d1")
    first = run_stream_pipeline(spark, cfg, raw + "/*", ckpt)
    assert len(first) == 1
    write_text_lines(transactions_json_lines(tx.filter("transaction_date >= DATE'2024-01-15'")),
                     raw + "/d2")
    second = run_stream_pipeline(spark, cfg, raw + "/*", ckpt)
    assert len(second) == 1 and second[0]["batch_id"] == 1
    assert run_stream_pipeline(spark, cfg, raw + "/*", ckpt) == []
    full = PipelineConfig(raw_path=raw + "/*", root=scratch_path(spark, "flake"),
                          schema=TX_RAW_SCHEMA)
    run_pipeline(spark, full)
    a = read_layer(spark, cfg.path("gold"))
    b = read_layer(spark, full.path("gold")).select(*a.columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
