"""Layer invariants and the expected fixture counts (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from cardrisk.operators import quality, reports
from cardrisk.plans import catalog

from conftest import SF001, SF01

EXPECTED = {
    SF001: dict(tx=1000, silver=964, gold=382, high_risk=0, users=15, hr_users=0, max_tx=9,
                leaks=11),
    SF01: dict(tx=10000, silver=9640, gold=3520, high_risk=144, users=150, hr_users=5,
               max_tx=32, leaks=108),
}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_fixture_counts(spark, sf):
    e = EXPECTED[sf]
    tx, sv, gd = catalog.tx(spark, sf), catalog.silver(spark, sf), catalog.gold(spark, sf)
    assert tx.count() == e["tx"]
    assert sv.count() == e["silver"]
    g = gd.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_high_risk").alias("hr"),
               F.max("tx_count").alias("mx"), F.sum("tx_count").alias("s"),
               F.sum("daily_total").alias("total")).first()
    assert (g.n, g.hr, g.mx) == (e["gold"], e["high_risk"], e["max_tx"])
    # every silver row is counted once in gold, and money adds up exactly
    assert g.s == e["silver"]
    assert g.total == sv.agg(F.sum("amount")).first()[0]
    rg = reports.risk_global(gd).first()
    assert (rg.total_usuarios, rg.usuarios_high_risk) == (e["users"], e["hr_users"])


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_bronze_is_silver_plus_rejected(spark, sf):
    r = quality.reconcile_layers(catalog.tx(spark, sf)).first()
    assert r.bronze_rows == r.silver_rows + r.rejected_rows


def test_leak_scan_counts(spark):
    leaks = {(r.layer, r.column_name): r.violations
             for r in catalog.QUERIES["pii_leak_scan"](spark, SF001).collect()}
    assert leaks[("silver_regex", "card_masked")] == EXPECTED[SF001]["leaks"]
    assert leaks[("silver_affix", "card_masked")] == 0
    assert leaks[("silver_strict", "card_masked")] == 0
    assert sum(v for (layer, _), v in leaks.items() if layer != "silver_regex") == 0


def test_publication_gate_blocks_leaky_silver(spark):
    from cardrisk.operators.maintain import published_view
    leaky = catalog.silver(spark, SF001, "regex")
    with pytest.raises(quality.QualityError):
        published_view(leaky, "silver", role="engineer")
    with pytest.raises(PermissionError):
        published_view(leaky, "silver", role="analyst")
    clean = published_view(catalog.silver(spark, SF001, "strict"), "silver", role="engineer")
    assert "card" not in clean.columns


def test_run_summary_consistent(spark):
    s = catalog.QUERIES["run_summary"](spark, SF01).first()
    e = EXPECTED[SF01]
    assert (s.bronze_rows, s.silver_rows, s.gold_rows) == (e["tx"], e["silver"], e["gold"])
    assert (s.high_risk_user_days, s.high_risk_users) == (e["high_risk"], e["hr_users"])
    assert s.retention_pct == 96.4
