"""The six reports as Spark SQL over catalog names (S6, SQL entry point).

The reference runs these as SQL against catalog tables; here they run with
``spark.sql`` against any registered name (a catalog table from
``register_table`` or a temp view).  Differences from the original text,
on purpose: ties are broken so LIMIT is deterministic, the trailing window
is anchored on ``as_of`` (default: the newest date in Silver) instead of
the wall clock, distinct users are counted from a one-row-per-user
reduction, and ratios are computed on DOUBLE with ``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import latest_partition_value

REPORTS = {
    # query 1: top 10 user-days by transactions
    "top_user_days": """
        SELECT user_id, transaction_date, tx_count, daily_total, is_high_risk
        FROM {gold}
        ORDER BY tx_count DESC, user_id, transaction_date
        LIMIT 10""",
    # query 2: high-risk user-days
    "high_risk_list": """
        SELECT user_id, transaction_date, tx_count, daily_total
        FROM {gold}
        WHERE is_high_risk = true
        ORDER BY tx_count DESC, user_id, transaction_date""",
    # query 3: daily volume over the trailing 7 days (8 dates with the boundary)
    "daily_volume_7d": """
        SELECT transaction_date, COUNT(*) AS total_transacciones,
               CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS monto_total
        FROM {silver}
        WHERE transaction_date >= date_sub({as_of}, 7)
        GROUP BY transaction_date
        ORDER BY transaction_date DESC""",
    # query 4: distinct users, distinct high-risk users, share
    "risk_global": """
        WITH users AS (
            SELECT user_id, MAX(CAST(is_high_risk AS INT)) AS ever_high_risk
            FROM {gold} WHERE user_id IS NOT NULL GROUP BY user_id)
        SELECT COUNT(*) AS total_usuarios,
               COUNT_IF(ever_high_risk = 1) AS usuarios_high_risk,
               ROUND(try_divide(CAST(COUNT_IF(ever_high_risk = 1) AS DOUBLE) * 100.0,
                                CAST(COUNT(*) AS DOUBLE)), 2) AS pct_high_risk
        FROM users""",
    # query 5: transactions and mean amount per currency
    "currency_mix": """
        SELECT currency, COUNT(*) AS cantidad,
               CAST(ROUND(AVG(amount), 2) AS DOUBLE) AS monto_promedio
        FROM {silver}
        GROUP BY currency
        ORDER BY cantidad DESC, currency""",
    # query 6: rows per layer
    "layer_counts": """
        SELECT 'Silver' AS capa, COUNT(*) AS filas FROM {silver}
        UNION ALL
        SELECT 'Gold', COUNT(*) FROM {gold}""",
}


def report_sql(name: str, silver: str = "silver_transactions", gold: str = "gold_risk_profile",
               as_of: str | None = None) -> str:
    """The SQL text of report ``name`` for the given catalog names."""
    anchor = f"DATE '{as_of}'" if as_of else f"(SELECT MAX(transaction_date) FROM {silver})"
    return REPORTS[name].format(silver=silver, gold=gold, as_of=anchor)


def run_report(spark: SparkSession, name: str, silver: str = "silver_transactions",
               gold: str = "gold_risk_profile", as_of: str | None = None) -> DataFrame:
    """Run report ``name`` with ``spark.sql``.

    Without ``as_of`` the trailing window is anchored on the newest Silver
    date, read from the catalog's partition list when Silver is a catalog
    table (no file is opened), else with a scalar subquery.
    """
    if as_of is None and "{as_of}" in REPORTS[name]:
        as_of = latest_partition_value(spark, silver, "transaction_date")
    return spark.sql(report_sql(name, silver, gold, as_of))
