"""Driver tables -> the ``transactions`` fixture (FIXTURES.md §3).

``events`` is the only driver table with one amount, one user and one time
per row.  The fixture maps it onto the card-transaction schema and injects
deterministic skew (30 % of the rows go to at most five hot users) and
defects (NULL ids, NULL / zero / negative amounts, NULL and 15-digit cards)
so that the quality filter, both card masks and the risk flag are exercised.
Every column is a pure function of the event row, so the view is identical
in Spark and in the DuckDB oracle and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import zero_pad
from ..schemas import MONEY

# Fixed values of the fixture (FIXTURES.md §3), in the order they are applied.
NULL_ID_EVERY = 83
HOT_USER_SHARE = 3          # event_id % 10 < 3 -> hot user
HOT_USERS = 5               # hot user = user_id % 5
NULL_CARD_EVERY = 97
SHORT_CARD_EVERY = 89
SHORT_CARD_VALUE = "453201511289036"
CARD_PREFIX = "4532"
CARD_MULTIPLIER = 104729
CARD_OFFSET = 15485863
CARD_MODULUS = 1000000000000
NULL_AMOUNT_EVERY = 61
NEGATIVE_AMOUNT_EVERY = 100
ZERO_AMOUNT_EVERY = 50
MERCHANTS = 500
# currency by event_id % 20: [0,10) USD, [10,14) EUR, [14,17) CLP, [17,19) BRL, 19 MXN
CURRENCY_BANDS = ((10, "USD"), (14, "EUR"), (17, "CLP"), (19, "BRL"))
CURRENCY_LAST = "MXN"
FRAUD_SUSPECT_FROM = 97     # event_id % 100 >= 97

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (lazy parquet scan)."""
    return spark.read.parquet(table_path(sf_dir, name))


def _currency(eid: Column) -> Column:
    bucket = eid % 20
    expr = None
    for upper, code in CURRENCY_BANDS:
        expr = F.when(bucket < upper, F.lit(code)) if expr is None else \
            expr.when(bucket < upper, F.lit(code))
    return expr.otherwise(F.lit(CURRENCY_LAST))


def events_to_transactions(events: DataFrame) -> DataFrame:
    """Narrow projection of ``events`` onto the transaction schema."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    value = F.col("value").cast(MONEY)
    card_digits = F.lpad(((uid * CARD_MULTIPLIER + CARD_OFFSET) % CARD_MODULUS).cast("string"),
                         12, "0")
    return events.select(
        F.when(eid % NULL_ID_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("tx-"), zero_pad(eid.cast("string"), 8)))
         .alias("transaction_id"),
        F.when(eid % 10 < HOT_USER_SHARE, uid % HOT_USERS).otherwise(uid).alias("user_id"),
        F.when(eid % NULL_CARD_EVERY == 0, F.lit(None).cast("string"))
         .when(eid % SHORT_CARD_EVERY == 0, F.lit(SHORT_CARD_VALUE))
         .otherwise(F.concat(F.lit(CARD_PREFIX), card_digits)).alias("card"),
        F.when(eid % NULL_AMOUNT_EVERY == 0, F.lit(None).cast(MONEY))
         .when(eid % NEGATIVE_AMOUNT_EVERY == 0, -value)
         .when(eid % ZERO_AMOUNT_EVERY == 0, F.lit(0).cast(MONEY))
         .otherwise(value).alias("amount"),
        F.col("ts").cast("date").alias("transaction_date"),
        F.col("ts").alias("event_ts"),
        F.concat(F.lit("merchant_"), (eid % MERCHANTS).cast("string")).alias("merchant"),
        F.col("event_type").alias("merchant_category"),
        _currency(eid).alias("currency"),
        F.when(eid % 100 >= FRAUD_SUSPECT_FROM, 1).otherwise(0).alias("is_fraud_suspect"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``transactions`` fixture over the whole ``events`` table."""
    return events_to_transactions(load_table(spark, sf_dir, "events"))


def transactions_sql(string_type: str = "VARCHAR") -> str:
    """The same view as SQL text; ``string_type`` is STRING (Spark) or VARCHAR (DuckDB)."""
    s = string_type
    return f"""SELECT CASE WHEN event_id % 83 = 0 THEN NULL
            ELSE concat('tx-', lpad(CAST(event_id AS {s}), CAST(greatest(length(CAST(event_id AS {s})), 8) AS INT), '0')) END      AS transaction_id,
       CASE WHEN event_id % 10 < 3 THEN user_id % 5 ELSE user_id END         AS user_id,
       CASE WHEN event_id % 97 = 0 THEN NULL
            WHEN event_id % 89 = 0 THEN '453201511289036'
            ELSE concat('4532', lpad(CAST((user_id * 104729 + 15485863) % 1000000000000 AS {s}), 12, '0'))
       END                                                                   AS card,
       CASE WHEN event_id % 61 = 0  THEN NULL
            WHEN event_id % 100 = 0 THEN -CAST(value AS DECIMAL(12,2))
            WHEN event_id % 50 = 0  THEN CAST(0 AS DECIMAL(12,2))
            ELSE CAST(value AS DECIMAL(12,2)) END                            AS amount,
       CAST(ts AS DATE)                                                      AS transaction_date,
       ts                                                                    AS event_ts,
       concat('merchant_', CAST(event_id % 500 AS {s}))                      AS merchant,
       event_type                                                            AS merchant_category,
       CASE WHEN event_id % 20 < 10 THEN 'USD' WHEN event_id % 20 < 14 THEN 'EUR'
            WHEN event_id % 20 < 17 THEN 'CLP' WHEN event_id % 20 < 19 THEN 'BRL'
            ELSE 'MXN' END                                                   AS currency,
       CASE WHEN event_id % 100 >= 97 THEN 1 ELSE 0 END                      AS is_fraud_suspect
FROM events"""


# Raw-drop defects (fixed values): a wrong-typed amount and a truncated line,
# keyed on the merchant so the oracle can state them in SQL.
WRONG_TYPE_MERCHANT = "merchant_7"
TRUNCATED_MERCHANT = "merchant_11"
TRUNCATE_AT = 20
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def transactions_json_lines(tx: DataFrame, defects: bool = True) -> DataFrame:
    """The fixture rendered as JSON Lines text (column ``value``).

    ``to_json`` omits NULL fields.  With ``defects`` two deterministic kinds
    of bad line are injected: the amount of ``merchant_7`` rows is written
    as a string (wrong type), and ``merchant_11`` lines are cut after 20
    characters (malformed JSON).
    """
    cols = [F.col(c) for c in tx.columns]
    line = F.to_json(F.struct(*cols), {"timestampNTZFormat": JSON_TS_FORMAT,
                                       "dateFormat": "yyyy-MM-dd"})
    if defects:
        merchant = F.col("merchant")
        line = (F.when(merchant == F.lit(TRUNCATED_MERCHANT), F.substring(line, 1, TRUNCATE_AT))
                 .when(merchant == F.lit(WRONG_TYPE_MERCHANT),
                       F.regexp_replace(line, r'"amount":(-?[0-9.]+)', '"amount":"$1x"'))
                 .otherwise(line))
    return tx.select(line.alias("value"))
