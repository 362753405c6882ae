"""Partition-scoped maintenance: upsert, erase, incremental replace, as-of."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cardrisk.operators import maintain
from cardrisk.schemas import DATE_COL
from cardrisk.session import checkpoint_root, scratch_path
from cardrisk.sinks.writers import write_layer
from cardrisk.sources.readers import read_layer

SCHEMA = "transaction_id string, user_id long, amount decimal(12,2), transaction_date date"


def _table(spark, rows):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame(rows, SCHEMA)
    write_layer(df, path, partition_by=[DATE_COL])
    return path


D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def _rows(spark, path):
    return sorted(((r.transaction_id, r.user_id, float(r.amount), r.transaction_date)
                   for r in read_layer(spark, path).collect()), key=str)


def test_upsert_moves_row_and_empties_old_partition(spark):
    from decimal import Decimal as Dec
    path = _table(spark, [("a", 1, Dec("1.00"), D1), ("b", 2, Dec("2.00"), D2),
                          (None, 3, Dec("3.00"), D2)])
    upd = spark.createDataFrame(
        [("a", 1, 10.0, D3, 1), ("a", 1, 11.0, D3, 2), ("c", 4, 5.0, D2, 1)],
        "transaction_id string, user_id long, amount double, transaction_date date, _seq int")
    stats = maintain.upsert(spark, path, upd, order_col="_seq")
    assert stats["emptied"] == 1                  # D1 lost its only row
    assert _rows(spark, path) == sorted([
        ("a", 1, 11.0, D3), ("b", 2, 2.0, D2), (None, 3, 3.0, D2), ("c", 4, 5.0, D2)], key=str)


def test_erase_user_everywhere(spark):
    from decimal import Decimal as Dec
    path = _table(spark, [("a", 1, Dec("1.00"), D1), ("b", 2, Dec("2.00"), D1),
                          ("c", 1, Dec("3.00"), D2)])
    stats = maintain.erase(spark, path, spark.createDataFrame([(1,)], "user_id long"))
    assert (stats["rewritten"], stats["emptied"]) == (1, 1)
    assert stats["touched"] == [D1, D2]
    assert [r[0] for r in _rows(spark, path)] == ["b"]
    assert read_layer(spark, path).filter(F.col(DATE_COL) == D2).count() == 0


def test_erase_keeps_rows_without_subject_and_leaves_no_scratch(spark):
    from decimal import Decimal as Dec
    path = _table(spark, [("a", 1, Dec("1.00"), D1), ("b", None, Dec("2.00"), D1)])
    before = _scratch(spark)
    maintain.erase(spark, path, spark.createDataFrame([(1,), (None,)], "user_id long"))
    maintain.upsert(spark, path, spark.createDataFrame([("c", 4, Dec("5.00"), D1)], SCHEMA))
    assert [r[0] for r in _rows(spark, path)] == ["b", "c"]
    assert _scratch(spark) == before


def _scratch(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    return sorted(x for x in os.listdir(root) if x.startswith(("rewrite-", "changes-")))


def test_replace_partitions_touches_only_present_dates(spark):
    from decimal import Decimal as Dec
    path = _table(spark, [("a", 1, Dec("1.00"), D1), ("b", 2, Dec("2.00"), D2)])
    new = spark.createDataFrame([("z", 9, Dec("9.00"), D2)], SCHEMA)
    maintain.replace_partitions(new, path)
    assert [r[0] for r in _rows(spark, path)] == ["a", "z"]


def test_as_of_reads_history(spark):
    from decimal import Decimal as Dec
    path = scratch_path(spark, "hist")
    maintain.append_batch(spark.createDataFrame([("a", 1, Dec("1.00"), D1)], SCHEMA), path, 1)
    maintain.append_batch(spark.createDataFrame([("a", 1, Dec("5.00"), D1),
                                                 ("b", 2, Dec("2.00"), D1)], SCHEMA), path, 2)
    v1 = maintain.read_as_of(spark, path, 1)
    assert [(r.transaction_id, float(r.amount)) for r in v1.collect()] == [("a", 1.0)]
    v2 = maintain.read_as_of(spark, path, 2, key="transaction_id")
    assert sorted((r.transaction_id, float(r.amount)) for r in v2.collect()) == \
        [("a", 5.0), ("b", 2.0)]
    from cardrisk.plans.timing import plan_text
    assert "PartitionFilters: [isnotnull(_batch_id" in plan_text(v1)


def test_latest_per_key_skewed_key(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") < 10_000, F.lit("hot")).otherwise(F.col("id").cast("string"))
         .alias("transaction_id"),
        F.col("id").alias("_seq"))
    out = maintain.latest_per_key(df, "transaction_id", "_seq")
    assert out.count() == 10_001
    assert out.filter("transaction_id = 'hot'").first()._seq == 9_999


def test_upsert_dedupes_repeated_records(spark):
    from decimal import Decimal as Dec
    path = _table(spark, [("a", 1, Dec("1.00"), D1)])
    upd = spark.createDataFrame([("b", 2, Dec("2.00"), D1), ("b", 2, Dec("2.00"), D1),
                                 ("a", 1, Dec("3.00"), D1)], SCHEMA)
    maintain.upsert(spark, path, upd)
    assert _rows(spark, path) == [("a", 1, 3.0, D1), ("b", 2, 2.0, D1)]


def test_upsert_date_scoped_lookup(spark):
    from decimal import Decimal as Dec
    from cardrisk.plans.timing import plan_text
    path = _table(spark, [("a", 1, Dec("1.00"), D1), ("b", 2, Dec("2.00"), D2)])
    upd = spark.createDataFrame([("b", 2, Dec("9.00"), D2), ("c", 3, Dec("3.00"), D2)], SCHEMA)
    stats = maintain.upsert(spark, path, upd, key_scope="dates")
    assert stats["touched"] == [D2]
    assert _rows(spark, path) == [("a", 1, 1.0, D1), ("b", 2, 9.0, D2), ("c", 3, 3.0, D2)]
    scoped = read_layer(spark, path).filter(F.col(DATE_COL).isin([D2]))
    assert "PartitionFilters: [" in plan_text(scoped) and "2024-01-02" in plan_text(scoped)


def test_winner_is_found_by_hash_aggregate(spark):
    """Random rows, NULL and equal orders, whole duplicates, against a plain max."""
    from cardrisk.plans.timing import plan_text
    rows = [(f"k{i % 7}" if i % 11 else None, None if i % 5 == 0 else i % 4, f"v{i % 9}", dt.date(2024, 1, 1 + i % 3))
            for i in range(400)]
    df = spark.createDataFrame(rows, "transaction_id string, _seq int, v string, d date").repartition(5)
    out = maintain.latest_per_key(df, "transaction_id", "_seq")
    assert "SortAggregate" not in plan_text(out) and "HashAggregate" in plan_text(out)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == 7 + sum(r[0] is None for r in rows)
    for key in {r[0] for r in rows} - {None}:
        mine = [r for r in got if r[0] == key]
        top = max(-1 if r[1] is None else r[1] for r in rows if r[0] == key)
        assert len(mine) == 1 and mine[0] in rows and mine[0][1] == top
    days = {r.transaction_id: r.d for r in maintain.latest_per_key(df, "transaction_id", "d").collect()}
    assert all(days[k] == max(r[3] for r in rows if r[0] == k) for k in {r[0] for r in rows} - {None})


def test_interval_history_equals_replay(spark, monkeypatch):
    """Every batch's state against a replay in Python; the read has no sort, join or aggregate."""
    import random
    from decimal import Decimal as Dec
    import pytest
    from cardrisk.plans.timing import plan_text
    rng = random.Random(5)
    for small in (True, False):
        if not small:  # the way of a large batch: Bloom filter and shuffled joins
            monkeypatch.setattr(maintain, "dimension_fits", lambda df, *a: (False, df.count(), 0))
        path, state, states = scratch_path(spark, "intervals"), {}, []
        for batch in range(1, 4):
            rows = [(f"t{rng.randrange(12)}", batch, Dec(rng.randrange(100)), rng.choice([D1, D2, D3])) for _ in range(8)]
            rows = list({r[0]: r for r in rows}.values()) + [(None, batch, Dec(1), D1)]
            state = {**state, **{r[0] or (None, batch): r for r in rows}}
            states.append(sorted(((r[0], r[1], r[2], r[3]) for r in state.values()), key=str))
            maintain.append_version(spark.createDataFrame(rows, SCHEMA), path, batch)
        for batch, want in enumerate(states, 1):
            got = maintain.read_version(spark, path, batch)
            rows = sorted(((r.transaction_id, r.user_id, r.amount, r.transaction_date) for r in got.collect()), key=str)
            assert rows == want
            text = plan_text(got)
            assert not any(x in text for x in ("Sort", "Join", "Aggregate", "Exchange"))
            assert "_to" in text.split("PartitionFilters", 1)[1].split("\n")[0]
        with pytest.raises(ValueError):
            maintain.append_version(spark.createDataFrame([], SCHEMA), path, 2)
        maintain.append_version(spark.createDataFrame([], SCHEMA), path, 9)
        assert maintain.read_version(spark, path, 9).count() == len(states[-1])
