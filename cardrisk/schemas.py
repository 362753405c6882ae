"""Declared schemas and allow-lists for every layer.

Raw JSON is always read with a declared schema: no inference pass over the
files, dates arrive as ``DateType`` and a malformed line lands in
``_corrupt_record`` instead of changing the schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"
DATE_COL = "transaction_date"
KEY_COL = "transaction_id"
INGEST_TS_COL = "_ingestion_ts"
SOURCE_FILE_COL = "_source_file"
BATCH_COL = "_batch_id"
FROM_COL = "_from"         # validity interval of a version: batches _from <= b < _to
TO_COL = "_to"
SOURCE_TIME_COL = "_source_time"
SOURCE_BLOCK_COL = "_source_block"
SOURCE_ROW_COL = "_source_row"

# P3 raw JSON Lines, as produced by the phase-3 generator.
P3_RAW_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("card", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("currency", T.StringType()),
])

# The driver-table fixture (sources.fixtures.transactions) as a raw file drop.
TX_RAW_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("card", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("is_fraud_suspect", T.IntegerType()),
])

# P2 bronze, built from expressions by the phase-2 generator (G1).
P2_BRONZE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("card_number", T.StringType()),
    T.StructField("amount", T.DecimalType(10, 2)),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("is_fraud_suspect", T.IntegerType()),
])

MONEY = T.DecimalType(12, 2)

# Columns that hold a full card number and must never leave Bronze.
RESTRICTED_COLUMNS = ("card", "card_number", CORRUPT_COL)

# Role-scoped publication (R5): what each role may read from each layer.
PUBLISHED_COLUMNS = {
    ("analyst", "gold"): ("user_id", "transaction_date", "tx_count", "daily_total",
                          "is_high_risk"),
    ("analyst", "gold_p2"): ("user_id", "transaction_date", "total_monto_diario",
                             "cantidad_transacciones_diarias", "contiene_sospecha_fraude",
                             "perfil_alto_riesgo"),
    ("engineer", "silver"): ("transaction_id", "user_id", "card_masked", "amount",
                             "transaction_date", "event_ts", "timestamp", "merchant",
                             "merchant_category", "currency", "is_fraud_suspect",
                             INGEST_TS_COL, SOURCE_FILE_COL),
}


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """Add the ``_corrupt_record`` column a PERMISSIVE JSON read fills."""
    if CORRUPT_COL in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
