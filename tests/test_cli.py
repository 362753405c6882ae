"""The job command line, run in-process on the test session."""

from cardrisk.__main__ import main
from cardrisk.session import scratch_path


def test_generate_run_report_erase(spark):
    raw, root = scratch_path(spark, "cliraw"), scratch_path(spark, "clilake")
    assert main(["generate", "--profile", "p3", "--rows", "4000", "--out", raw], spark)["rows"] == 4000
    out = main(["run", "--raw", raw, "--root", root, "--tables"], spark)
    assert out["bronze_rows"] == 4000 and out["silver_rows"] == 4000 - 4000 // 50
    top = main(["report", "top_user_days", "--rows", "5"], spark)["rows"]
    assert len(top) == 5 and top[0]["tx_count"] >= top[-1]["tx_count"]
    vol = main(["report", "daily_volume_7d"], spark)["rows"]
    assert len(vol) == 8
    victim = top[0]["user_id"]
    main(["erase", "--root", root, "--users", victim, "--tables"], spark)
    assert spark.table("silver_transactions").filter(f"user_id = '{victim}'").count() == 0


def test_report_registers_tables_from_root(spark):
    raw, root = scratch_path(spark, "cliraw2"), scratch_path(spark, "clilake2")
    main(["generate", "--profile", "p3", "--rows", "3000", "--out", raw], spark)
    main(["run", "--raw", raw, "--root", root], spark)      # no catalog tables
    tag = root.rsplit("-", 1)[-1]
    out = main(["report", "layer_counts", "--root", root, "--silver", f"s_{tag}",
                "--gold", f"g_{tag}"], spark)["rows"]
    counts = {r["capa"]: r["filas"] for r in out}
    assert counts["Silver"] == 3000 - 3000 // 50 and counts["Gold"] > 0
