"""Gold layer: daily per-user aggregates and the risk flag.

One ``groupBy(user_id, transaction_date)``: Spark plans a partial
(map-side) aggregate, a hash exchange on the two keys and a final
aggregate.  The partial aggregate collapses a hot user's rows to one row
per map task before the shuffle, so a user holding a third of the data
does not turn into one oversized reduce task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DATE_COL

RISK_THRESHOLD = 12  # strictly more than 12 transactions in a day is high risk


def risk_profile(silver: DataFrame, threshold: int = RISK_THRESHOLD,
                 user_col: str = "user_id", date_col: str = DATE_COL) -> DataFrame:
    """A2 + P6 (phase 3): ``tx_count = count(*)``, ``daily_total = sum(amount)``,
    ``is_high_risk = tx_count > threshold``."""
    return (silver.groupBy(user_col, date_col)
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 F.sum("amount").alias("daily_total"))
            .withColumn("is_high_risk", F.col("tx_count") > F.lit(threshold)))


def daily_features(silver: DataFrame, threshold: int = RISK_THRESHOLD,
                   user_col: str = "user_id", date_col: str = DATE_COL) -> DataFrame:
    """A1 + X6 (phase 2): sum of amount, ``count(transaction_id)`` (NULL ids
    are not counted), ``max(is_fraud_suspect)`` and an int risk flag."""
    count_col = "cantidad_transacciones_diarias"
    return (silver.groupBy(user_col, date_col)
            .agg(F.sum("amount").alias("total_monto_diario"),
                 F.count("transaction_id").alias(count_col),
                 F.max("is_fraud_suspect").alias("contiene_sospecha_fraude"))
            .withColumn("perfil_alto_riesgo",
                        F.when(F.col(count_col) > F.lit(threshold), 1).otherwise(0)))
