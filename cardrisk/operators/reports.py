"""The six SQL reports and the notebook day breakdowns.

Each report is a DataFrame expression over a Silver or Gold DataFrame:

* top-k (O1, O2) is ``orderBy(...).limit(k)``, which Spark plans as
  ``TakeOrderedAndProject``: every partition keeps only its own k rows.
  Ties are broken on ``user_id, transaction_date`` so the result is a total
  order (the reference's bare ``ORDER BY tx_count DESC`` is not).
* the distinct-user figures (A7, A8) first reduce Gold to one row per user
  (a normal partial/final aggregate) and then count, instead of planning two
  DISTINCT aggregates through ``Expand``.
* the trailing-window report (F4) takes an explicit ``as_of`` date, or the
  newest date in the data through a scalar subquery, never the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct, round_money
from ..schemas import DATE_COL

GOLD_REPORT_COLUMNS = ("user_id", DATE_COL, "tx_count", "daily_total", "is_high_risk")


def _date_lit(day: str | _dt.date | Column) -> Column:
    if isinstance(day, Column):
        return day
    return F.lit(day if isinstance(day, _dt.date) else _dt.date.fromisoformat(day))


def top_user_days(gold: DataFrame, k: int = 10,
                  columns: tuple[str, ...] = GOLD_REPORT_COLUMNS) -> DataFrame:
    """O1 (k=10) / O2 (k=5): the k user-days with the most transactions."""
    return (gold.orderBy(F.col("tx_count").desc(), F.col("user_id").asc(),
                         F.col(DATE_COL).asc())
            .limit(k)
            .select(*columns))


def high_risk_list(gold: DataFrame, flag_col: str = "is_high_risk") -> DataFrame:
    """F3 + O3 (query 2): every high-risk user-day, most transactions first."""
    return (gold.filter(F.col(flag_col))
            .select("user_id", DATE_COL, "tx_count", "daily_total")
            .orderBy(F.col("tx_count").desc(), F.col("user_id").asc(), F.col(DATE_COL).asc()))


def latest_date(df: DataFrame, date_col: str = DATE_COL) -> Column:
    """Scalar subquery: the newest date present in ``df``."""
    return df.select(F.max(date_col)).scalar()


def daily_volume(silver: DataFrame, days: int = 7,
                 as_of: str | _dt.date | Column | None = None) -> DataFrame:
    """F4 + A3 + O4 (query 3): count and rounded total per day over the last
    ``days`` days up to ``as_of`` (boundary day included: days + 1 dates)."""
    anchor = latest_date(silver) if as_of is None else _date_lit(as_of)
    return (silver.filter(F.col(DATE_COL) >= F.date_sub(anchor, days))
            .groupBy(DATE_COL)
            .agg(F.count(F.lit(1)).alias("total_transacciones"),
                 round_money(F.sum("amount")).alias("monto_total"))
            .orderBy(F.col(DATE_COL).desc()))


def per_user_flag(gold: DataFrame, flag_col: str = "is_high_risk") -> DataFrame:
    """One row per (non-NULL) user with ``max(flag)``: ever high-risk."""
    return (gold.filter(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.max(F.col(flag_col).cast("boolean")).alias("ever_high_risk")))


def risk_global(gold: DataFrame, flag_col: str = "is_high_risk") -> DataFrame:
    """A7 + A8 + A9 (query 4): distinct users, distinct high-risk users, % high-risk."""
    users = per_user_flag(gold, flag_col)
    return (users.agg(F.count(F.lit(1)).alias("total_usuarios"),
                      F.count_if(F.col("ever_high_risk")).alias("usuarios_high_risk"))
            .withColumn("pct_high_risk", pct("usuarios_high_risk", "total_usuarios")))


def currency_mix(silver: DataFrame) -> DataFrame:
    """A4 + O5 (query 5): transactions and rounded mean amount per currency."""
    return (silver.groupBy("currency")
            .agg(F.count(F.lit(1)).alias("cantidad"),
                 round_money(F.avg("amount")).alias("monto_promedio"))
            .orderBy(F.col("cantidad").desc(), F.col("currency").asc()))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """U1 + A10 (query 6): one row per layer with its row count, stacked (UNION ALL)."""
    out = None
    for name, df in layers.items():
        row = df.agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(name).alias("capa"), F.col("filas"))
        out = row if out is None else out.unionByName(row)
    return out


def on_day(df: DataFrame, day: str | _dt.date) -> DataFrame:
    """equality on one date (a partition filter on a date-partitioned table)."""
    return df.filter(F.col(DATE_COL) == _date_lit(day))


def category_day_count(silver: DataFrame, day: str | _dt.date) -> DataFrame:
    """F2 + A5: transactions per merchant category on one day."""
    return (on_day(silver, day).groupBy("merchant_category")
            .agg(F.count(F.lit(1)).alias("count")))


def risk_day_histogram(gold: DataFrame, day: str | _dt.date,
                       flag_col: str = "perfil_alto_riesgo") -> DataFrame:
    """F2 + A6: user-days per risk flag value on one day."""
    return on_day(gold, day).groupBy(flag_col).agg(F.count(F.lit(1)).alias("count"))


def distinct_users(gold: DataFrame) -> DataFrame:
    """The distinct user ids of a layer."""
    return gold.select("user_id").distinct()


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """K5: the first ``n`` rows as a DataFrame (``show`` without the driver print)."""
    return df.limit(n)
