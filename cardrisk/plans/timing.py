"""Timed A/B of two plans for the same result (B4) and plan inspection helpers."""

from __future__ import annotations

import contextlib
import io
import time
from collections.abc import Callable

from pyspark.sql import DataFrame


def run_action(df: DataFrame) -> None:
    """Execute the whole plan.

    ``write.format("noop")`` runs every stage without collecting to the
    driver or writing output, so the time is the plan's own.
    """
    df.write.format("noop").mode("overwrite").save()


def timed(fn: Callable[[], object]) -> tuple[float, object]:
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def ab_compare(name_a: str, plan_a: Callable[[], DataFrame],
               name_b: str, plan_b: Callable[[], DataFrame]) -> dict:
    """Run two plans that must give the same result and report the gain of B over A.

    Both sides run the *same* query (the reference's notebook compared two
    different queries on two different tables).
    """
    ta, _ = timed(lambda: run_action(plan_a()))
    tb, _ = timed(lambda: run_action(plan_b()))
    gain = (ta - tb) / ta * 100.0 if ta > 0 else 0.0
    return {name_a: ta, name_b: tb, "gain_pct": round(gain, 1)}


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (``explain`` prints; this captures it)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
