"""Every registered query against its DuckDB oracle on the smallest scale."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() == 10
    assert df.columns == ["user_id", "transaction_date", "tx_count", "daily_total",
                          "is_high_risk"]


def test_every_query_has_oracle_or_is_declared_rows_only():
    import __spark_entry__ as entry
    from cardrisk.plans import catalog
    rows_only = set(catalog.QUERIES) - set(entry.oracle_sql())
    assert rows_only == {"bronze_lineage"}


# Operators that must not appear in any registered query's plan: no cross
# joins, no Python evaluation (all work stays in the JVM).
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonMapInArrow",
             "FlatMapCoGroupsInPandas", "AggregateInPandas", "WindowInPandas")


@pytest.fixture(scope="module")
def oracle_run(spark):
    """Every registered query once at sf0.001: oracle comparison + final plans."""
    from compare_oracle import compare
    plans = {}
    from cardrisk.plans import catalog
    return compare(spark, SF001, names=set(catalog.QUERIES), verbose=False, plans=plans), plans


def test_queries_match_oracle(oracle_run):
    results, _ = oracle_run
    bad = {k: v for k, v in results.items() if v[0] == "MISMATCH"}
    assert not bad


def test_no_cross_joins_and_no_python_in_any_query(oracle_run):
    import re
    _, plans = oracle_run
    offenders = {name: [op for op in FORBIDDEN if re.search(rf"\b{op}\b", text)]
                 for name, text in plans.items()}
    from cardrisk.plans import catalog
    assert set(plans) == set(catalog.QUERIES)
    assert not {k: v for k, v in offenders.items() if v}
