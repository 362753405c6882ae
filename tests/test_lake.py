"""One lake under any order of loads: versioned swaps, Bloom-filtered upserts, ledgers, erasure."""

import datetime as dt
import json
import os
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from cardrisk.__main__ import main
from cardrisk.operators import bloom, bronze, maintain
from cardrisk.plans import ledgers, pipeline
from cardrisk.plans.timing import plan_text
from cardrisk.schemas import DATE_COL
from cardrisk.session import scratch_path
from cardrisk.sinks.writers import write_layer
from cardrisk.sources import versions
from cardrisk.sources.readers import read_layer, register_table, sync_partitions

SCHEMA = "transaction_id string, user_id long, amount decimal(12,2), transaction_date date"
DAYS = [dt.date(2024, 1, d) for d in range(1, 6)]


def table(spark, rows):
    path = scratch_path(spark, "t")
    write_layer(spark.createDataFrame(rows, SCHEMA), path, partition_by=[DATE_COL])
    return path


def rows_of(spark, path):
    return sorted(((r.transaction_id, r.user_id, float(r.amount), r.transaction_date)
                   for r in read_layer(spark, path).collect()), key=str)


def some(n=40):
    return [(f"k{i}", i % 7, Dec(i + 1), DAYS[i % 5]) for i in range(n)]


# -- versioned swap ------------------------------------------------------------------

def test_failure_before_the_switch_leaves_the_table_whole(spark, monkeypatch):
    path = table(spark, some())
    before = rows_of(spark, path)
    update = spark.createDataFrame([("k3", 1, Dec("9.00"), DAYS[0])], SCHEMA)
    real = versions.commit
    for fails_at in (0, 1):  # the first change of a table, then a later one
        def broken(spark, path, state):
            if state["version"] > fails_at:
                raise RuntimeError("store is down")
            real(spark, path, state)
        monkeypatch.setattr(versions, "commit", broken)
        with pytest.raises(RuntimeError):
            maintain.upsert(spark, path, update)
        assert rows_of(spark, path) == before
        monkeypatch.setattr(versions, "commit", real)
        maintain.upsert(spark, path, update)
        before = rows_of(spark, path)
        assert ("k3", 1, 9.0, DAYS[0]) in before and len(before) == 40


def test_one_write_per_rewrite_and_old_versions_go(spark, monkeypatch):
    path = table(spark, some())
    writes = []
    real = versions.write_layer
    monkeypatch.setattr(versions, "write_layer", lambda df, p, **k: writes.append(p) or real(df, p, **k))
    for amount in range(1, 5):
        maintain.replace_partitions(spark.createDataFrame([("z", 1, Dec(amount), DAYS[1])], SCHEMA), path)
    assert len(writes) == 4
    local = path.removeprefix("file:")
    files = [f for f in sorted(os.listdir(f"{local}/_manifest")) if not f.startswith(".")]
    assert files == ["000000000003.json", "000000000004.json"]
    held = {v for v in os.listdir(f"{local}/_versions") if os.path.isdir(f"{local}/_versions/{v}/{DATE_COL}=2024-01-02")}
    assert held == {"_v=3", "_v=4"} and not os.path.exists(f"{local}/{DATE_COL}=2024-01-02")
    assert len(rows_of(spark, path)) == 33


def test_second_writer_of_one_version_fails(spark):
    path = table(spark, some())
    maintain.replace_partitions(spark.createDataFrame([("z", 1, Dec(1), DAYS[1])], SCHEMA), path)
    state = versions.manifest(spark, path)
    with pytest.raises(RuntimeError):
        versions.commit(spark, path, state)
    with pytest.raises(ValueError):  # a plain append would not be seen
        write_layer(spark.createDataFrame(some(), SCHEMA), path, mode="append", partition_by=[DATE_COL])
    with pytest.raises(ValueError):
        versions.replace(spark, path, read_layer(spark, path), [DATE_COL], fmt="delta")


def test_reads_prune_and_catalog_follows_the_manifest(spark):
    path = table(spark, some())
    name = "lake_" + path.rsplit("-", 1)[-1]
    register_table(spark, name, path, partition_by=[DATE_COL])
    stats = maintain.erase(spark, path, spark.createDataFrame([(u,) for u in range(5)], "user_id long"))
    sync_partitions(spark, name, DATE_COL, stats["touched"])
    want = [r for r in rows_of(spark, path)]
    got = spark.table(name).select("transaction_id", "user_id", "amount", DATE_COL).collect()
    assert sorted(((r[0], r[1], float(r[2]), r[3]) for r in got), key=str) == want and {r[1] for r in want} == {5, 6}
    plan = plan_text(read_layer(spark, path).filter(F.col(DATE_COL) == DAYS[2]))
    assert "PartitionFilters: [" in plan and "2024-01-03" in plan
    # a date that lost all its rows leaves the table and the catalog
    one_day = [r.transaction_id for r in read_layer(spark, path).filter(F.col(DATE_COL) == DAYS[0]).collect()]
    moved = spark.createDataFrame([(k, 5, Dec(1), DAYS[1]) for k in one_day], SCHEMA)
    stats = maintain.upsert(spark, path, moved)
    assert stats["emptied"] == 1
    sync_partitions(spark, name, DATE_COL, stats["touched"])
    assert f"{DATE_COL}=2024-01-01" not in {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    register_table(spark, f"{name}_b", path, partition_by=[DATE_COL])
    assert spark.table(f"{name}_b").count() == spark.table(name).count() == len(rows_of(spark, path))


# -- Bloom filter ----------------------------------------------------------------------

def test_bloom_passes_every_key_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    seen = bloom.key_filter(keys, "k", 20_000)
    assert bloom.may_hold(keys, seen, "k", 20_000).count() == 20_000
    others = spark.range(100_000).select(F.concat(F.lit("o"), F.col("id")).alias("k"))
    assert bloom.may_hold(others, seen, "k", 20_000).count() < 5_000
    few = bloom.key_filter(keys, "k", 5)  # far too small: passes more, loses none
    assert bloom.may_hold(keys, few, "k", 5).count() == 20_000
    null = spark.createDataFrame([(None,)], "k string")
    assert bloom.marked(null, seen, "k", 20_000).first()[bloom.MARK] is False
    assert bloom.may_hold(others, bloom.key_filter(null, "k", 0), "k", 0).count() == 0


def test_upsert_with_a_key_set_too_large_to_broadcast(spark, monkeypatch):
    update = [(f"k{i}", 9, Dec(100 + i), DAYS[(i + 1) % 5]) for i in range(0, 60, 3)] + [(None, 1, Dec(5), DAYS[0])]
    base = some() + [(None, 2, Dec(6), DAYS[0])]
    paths, plans = [], []
    real = versions.write_layer

    def watched(df, p, **k):
        plans.append(plan_text(df))
        return real(df, p, **k)
    monkeypatch.setattr(versions, "write_layer", watched)
    for fits in (True, False):
        monkeypatch.setattr(maintain, "dimension_fits", lambda df, fits=fits: (fits, df.count(), 0))
        paths.append(table(spark, base))
        maintain.upsert(spark, paths[-1], spark.createDataFrame(update, SCHEMA))
    assert rows_of(spark, paths[0]) == rows_of(spark, paths[1])
    assert len(rows_of(spark, paths[0])) == 41 + sum(i >= 40 for i in range(0, 60, 3)) + 1
    # the stored rows meet the filter inside their scan stage: every exchange above a scan of the
    # table has the filter's join below it
    assert "BroadcastHashJoin" in plans[1] and "bit_or" in plans[1] and "bit_or" not in plans[0]


def test_key_history_is_not_shuffled_unfiltered(spark):
    path = table(spark, some())
    keys = spark.createDataFrame([(f"k{i}",) for i in range(9)], "transaction_id string")
    base = read_layer(spark, path).select("transaction_id", DATE_COL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = bloom.may_hold(base, bloom.key_filter(keys, "transaction_id", 9), "transaction_id", 9)
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above = plan[:plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in above and "Exchange" not in above.replace("BroadcastExchange", "")


# -- batch ledger ------------------------------------------------------------------------

def lake(tmp_path, name="lake"):
    return pipeline.PipelineConfig(raw_path="", root=f"{tmp_path}/{name}")


def drop(tmp_path, name, rows):
    (tmp_path / name).mkdir(exist_ok=True)
    lines = [json.dumps({"transaction_id": t, "user_id": u, "card": "4532015112890367", "amount": a,
                         "transaction_date": d}) for t, u, a, d in rows]
    (tmp_path / name / "part.json").write_text("\n".join(lines))
    return f"{tmp_path}/{name}"


A = [("a", "u1", 1.0, "2026-01-01"), ("b", "u2", 2.0, "2026-01-02"), (None, "u1", 3.0, "2026-01-02"), ("a", "u1", 4.0, "2026-01-01")]
B = [("b", "u2", 20.0, "2026-01-03"), ("c", "u3", 30.0, "2026-01-03"), ("c", "u3", 31.0, "2026-01-04"), (None, "u3", 5.0, "2026-01-04")]
C = [("c", "u3", 300.0, "2026-01-04"), ("d", "u1", 40.0, "2026-01-01")]
WANT = [("", "u1", 3.0), ("", "u3", 5.0), ("a", "u1", 1.0), ("a", "u1", 4.0), ("b", "u2", 20.0), ("c", "u3", 300.0), ("d", "u1", 40.0)]


def stored(spark, cfg, layer="silver"):
    return sorted((r.transaction_id or "", r.user_id, float(r.amount)) for r in read_layer(spark, cfg.path(layer)).collect())


@pytest.mark.parametrize("order", ["run,b,c,run", "ingest,b,ingest,c", "b,c,run", "b,run,b,c,c"])
def test_every_order_of_loads_gives_one_lake(spark, tmp_path, order):
    raw = {n: drop(tmp_path, n, rows) for n, rows in (("a", A), ("b", B), ("c", C))}
    cfg = lake(tmp_path)
    root = ["--root", cfg.root]
    for step in order.split(","):
        if step in ("run", "ingest"):
            main([step, "--raw", raw["a"], *root], spark)
        else:
            main(["batch", "--raw", raw[step], "--batch-id", "1" if step == "b" else "2", *root], spark)
    assert stored(spark, cfg) == WANT
    gold = {(r.user_id, str(r.transaction_date)): r.tx_count for r in read_layer(spark, cfg.path("gold")).collect()}
    assert gold == {("u1", "2026-01-01"): 3, ("u1", "2026-01-02"): 1, ("u2", "2026-01-03"): 1, ("u3", "2026-01-04"): 2}
    assert {e.state for e in ledgers.batches(spark, cfg.root).values()} == {ledgers.LOADED}
    assert bronze.read_bronze(spark, cfg.path("bronze")).count() == 10


def test_replay_with_other_content_replaces_the_batch(spark, tmp_path):
    cfg = lake(tmp_path)
    pipeline.run_batch(spark, cfg, drop(tmp_path, "b", B), 1)
    pipeline.run_batch(spark, cfg, drop(tmp_path, "c", C), 2)
    pipeline.run_batch(spark, cfg, drop(tmp_path, "b2", B[1:2]), 1)  # batch 1 lost rows; batch 2 still wins over it
    assert stored(spark, cfg) == [("c", "u3", 300.0), ("d", "u1", 40.0)]


def test_load_that_stops_half_way_is_taken_up(spark, tmp_path, monkeypatch):
    cfg = lake(tmp_path)
    pipeline.run_batch(spark, cfg, drop(tmp_path, "b", B), 1)
    with monkeypatch.context() as m:
        def down(*a, **k):
            raise RuntimeError("store is down")
        m.setattr(maintain, "upsert", down)
        with pytest.raises(RuntimeError):
            pipeline.run_batch(spark, cfg, drop(tmp_path, "c", C), 2)
    assert ledgers.batches(spark, cfg.root)["batch-2"].state == ledgers.BRONZE
    pipeline.run_batch(spark, cfg, drop(tmp_path, "e", [("e", "u9", 9.0, "2026-01-09")]), 3)
    assert stored(spark, cfg) == [x for x in WANT if x[0] in "bcd" and x != ("", "u1", 3.0)] + [("e", "u9", 9.0)]


def test_stream_counts_rows_beyond_the_progress_history(spark, tmp_path):
    from cardrisk.schemas import P3_RAW_SCHEMA
    from cardrisk.streaming.filedrop import ingest_available
    for i in range(7):
        drop(tmp_path, f"s{i}", [(f"x{i}", "u", 1.0, "2026-01-01"), (f"y{i}", "u", 1.0, "2026-01-01")])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        added = ingest_available(spark, f"{tmp_path}/s*", f"{tmp_path}/bronze", f"{tmp_path}/ckpt", P3_RAW_SCHEMA,
                                 max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert added == 14 == bronze.read_bronze(spark, f"{tmp_path}/bronze").count()


# -- erasure ledger ------------------------------------------------------------------------

def test_erased_users_stay_out_of_every_layer(spark, tmp_path):
    raw = {n: drop(tmp_path, n, rows) for n, rows in (("a", A), ("b", B), ("c", C))}
    cfg = lake(tmp_path)
    cfg.raw_path = raw["a"]
    pipeline.run_pipeline(spark, cfg)
    pipeline.run_batch(spark, cfg, raw["b"], 1)
    pipeline.erase_subjects(spark, cfg, spark.createDataFrame([("u3",), (None,), ("u3",)], "user_id string"))
    left = [x for x in WANT if x[1] != "u3" and x[0] != "d"]
    assert stored(spark, cfg) == left
    assert "u3" not in {r.user_id for r in read_layer(spark, cfg.path("bronze")).collect()}
    assert "u3" not in {r.user_id for r in read_layer(spark, cfg.path("gold")).collect()}
    for folder, _, files in os.walk(f"{tmp_path}/lake"):  # nor in an older version on disk
        for f in (f for f in files if f.endswith(".parquet") and "_erased" not in folder and "_batches" not in folder):
            part = spark.read.parquet(f"{folder}/{f}")
            assert "user_id" not in part.columns or part.where("user_id = 'u3'").count() == 0
    pipeline.run_pipeline(spark, cfg)
    assert stored(spark, cfg) == left
    pipeline.run_batch(spark, cfg, raw["c"], 2)
    assert stored(spark, cfg) == [x for x in WANT if x[1] != "u3"]
    history = scratch_path(spark, "hist")
    maintain.append_batch(read_layer(spark, cfg.path("silver")).withColumn("user_id", F.lit("u3")), history, 1)
    assert maintain.read_as_of(spark, history, 1, erased=ledgers.erased(spark, cfg.root)).count() == 0
    maintain.erase(spark, history, spark.createDataFrame([("u3",)], "user_id string"), partition_col="_batch_id")
    maintain.append_batch(read_layer(spark, cfg.path("silver")), history, 2)
    assert maintain.read_as_of(spark, history, 2).count() == len(WANT) - 2
    with pytest.raises(ValueError):
        maintain.append_batch(read_layer(spark, cfg.path("silver")), history, 2)
