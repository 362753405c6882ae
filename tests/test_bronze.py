"""Raw JSON with a declared schema: rejects, lineage and the quarantine split."""

import tempfile

from pyspark.sql import functions as F

from cardrisk.operators import bronze
from cardrisk.schemas import P3_RAW_SCHEMA
from cardrisk.sources.readers import read_raw_json

GOOD = ('{"transaction_id":"tx-1","user_id":"u1","card":"4532015112890367","amount":10.5,'
        '"transaction_date":"2026-01-02","timestamp":"2026-01-02T00:00:00",'
        '"merchant":"m","currency":"USD"}')
INT_ZERO = GOOD.replace('"tx-1"', '"tx-2"').replace("10.5", "0")
NO_AMOUNT = GOOD.replace('"tx-1"', '"tx-3"').replace('"amount":10.5,', "")
WRONG_TYPE = GOOD.replace('"tx-1"', '"tx-4"').replace("10.5", '"ten"')
BAD_DATE = GOOD.replace('"tx-1"', '"tx-5"').replace("2026-01-02", "2026-13-01", 1)
TRUNCATED = GOOD[:25]
NAN = GOOD.replace('"tx-1"', '"tx-6"').replace("10.5", "NaN")


def _drop(lines):
    d = tempfile.mkdtemp(prefix="cardrisk-raw-")
    with open(f"{d}/part-0.json", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return d


def test_declared_schema_keeps_types_and_flags_bad_lines(spark):
    raw = read_raw_json(spark, _drop([GOOD, INT_ZERO, NO_AMOUNT, WRONG_TYPE, BAD_DATE,
                                      TRUNCATED, NAN]), P3_RAW_SCHEMA)
    assert dict(raw.dtypes)["transaction_date"] == "date"
    assert dict(raw.dtypes)["timestamp"] == "timestamp_ntz"
    got = {r.reason: r.row_count for r in bronze.reject_counts(raw).collect()}
    assert got == {"malformed": 3, "null_amount": 1}
    ok = bronze.classify(raw).filter(F.col("_status") == "accepted")
    assert sorted(r.transaction_id for r in ok.collect()) == ["tx-1", "tx-2", "tx-6"]


def test_ingest_writes_quarantine_partition_with_lineage(spark):
    src = _drop([GOOD, TRUNCATED, NO_AMOUNT])
    out = tempfile.mkdtemp(prefix="cardrisk-bronze-") + "/bronze"
    bronze.ingest_bronze(spark, src, out, P3_RAW_SCHEMA)
    accepted = bronze.read_bronze(spark, out)
    rejected = bronze.read_bronze(spark, out, status="rejected")
    assert accepted.count() == 1 and rejected.count() == 2
    row = accepted.first()
    assert row._source_file.endswith("part-0.json")
    assert row._ingestion_ts is not None
    assert "_corrupt_record" not in accepted.columns
    assert "_corrupt_record" in rejected.columns


def test_lineage_label_for_generated_frames(spark):
    df = bronze.add_lineage(spark.range(2), source_label="demo_generated")
    assert {r._source_file for r in df.collect()} == {"demo_generated"}


def test_inferred_read_then_conform_matches_declared(spark):
    from cardrisk.sources.readers import conform, read_raw_json_inferred
    src = _drop([GOOD, INT_ZERO, BAD_DATE])
    inferred = read_raw_json_inferred(spark, src)
    assert dict(inferred.dtypes)["transaction_date"] == "string"   # the reference's text dates
    fixed = conform(inferred, P3_RAW_SCHEMA)
    assert fixed.columns == P3_RAW_SCHEMA.fieldNames()
    assert fixed.schema == P3_RAW_SCHEMA
    rows = {r.transaction_id: r for r in fixed.collect()}
    assert rows["tx-5"].transaction_date is None                   # 2026-13-01
    assert rows["tx-2"].amount == 0.0
    assert str(rows["tx-1"].transaction_date) == "2026-01-02"


def test_date_helpers(spark):
    from cardrisk.functions.dates import days_back, format_date, parse_date
    import datetime as dt
    row = spark.createDataFrame([("2026-02-30", "2024-01-15")], "a string, b string").select(
        parse_date("a").alias("bad"), format_date(parse_date("b"), "dd/MM/yyyy").alias("fmt"),
        days_back(dt.date(2024, 1, 30), 7).alias("back")).first()
    assert row.bad is None and row.fmt == "15/01/2024" and row.back == dt.date(2024, 1, 23)
