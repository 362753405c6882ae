"""Unit tests on the real transforms: the reference's three literal cases plus
the edge rows it never tested (FIXTURES.md §1)."""

import math
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.functions.masking import mask_card
from cardrisk.operators import gold, silver
from cardrisk.sources.readers import rows_to_df

CARD_SCHEMA = T.StructType([T.StructField("user_id", T.StringType()),
                            T.StructField("amount", T.DoubleType()),
                            T.StructField("card", T.StringType())])


def test_positive_amount_filter(spark):
    rows = [("u1", 100.0, "4532015112890367"), ("u2", 0.0, "4916123456789012"),
            ("u3", -50.0, "4556123456789013"), ("u4", 250.0, "4929123456789014")]
    out = silver.filter_valid(rows_to_df(spark, rows, CARD_SCHEMA))
    assert sorted(r.user_id for r in out.collect()) == ["u1", "u4"]


def test_filter_edge_rows_null_nan_zero(spark):
    rows = [("a", None, "x"), ("b", math.nan, "x"), ("c", 0.0, "x"), ("d", 0.01, "x"),
            ("e", -0.0, "x"), ("f", math.inf, "x")]
    out = silver.filter_valid(rows_to_df(spark, rows, CARD_SCHEMA))
    # NaN sorts above every number in Spark, so it must be removed explicitly
    assert sorted(r.user_id for r in out.collect()) == ["d", "f"]


def test_filter_on_decimal_amount(spark):
    df = spark.createDataFrame([(1, "0.00"), (2, "0.01"), (3, None), (4, "-3.50")],
                               "id int, a string").select(
        "id", F.col("a").cast("decimal(12,2)").alias("amount"))
    assert [r.id for r in silver.filter_valid(df).collect()] == [2]


@pytest.mark.parametrize("card,mode,expected", [
    ("4532015112890367", "affix", "4532-XXXX-XXXX-0367"),
    ("4532015112890367", "regex", "4532-XXXX-XXXX-0367"),
    ("4532015112890367", "strict", "4532-XXXX-XXXX-0367"),
    ("4152889912345678", "regex", "4152-XXXX-XXXX-5678"),
    # 15 digits: the anchored regex leaves it whole, the affix mask hides the middle
    ("453201511289036", "regex", "453201511289036"),
    ("453201511289036", "affix", "4532-XXXX-XXXX-9036"),
    ("453201511289036", "strict", "XXXX-XXXX-XXXX-XXXX"),
    # short values: affix repeats them, strict hides them
    ("abc", "affix", "abc-XXXX-XXXX-abc"),
    ("4532", "regex", "4532"),
    ("abc", "strict", "XXXX-XXXX-XXXX-XXXX"),
    (None, "affix", None),
    (None, "regex", None),
    (None, "strict", None),
    # a trailing newline is not a 16-digit card for the strict mask
    ("4532015112890367\n", "strict", "XXXX-XXXX-XXXX-XXXX"),
])
def test_card_masks(spark, card, mode, expected):
    df = spark.createDataFrame([(card,)], "card string")
    assert df.select(mask_card("card", mode).alias("m")).first().m == expected


def test_mask_rejects_unknown_mode():
    with pytest.raises(ValueError):
        mask_card("card", "rot13")


def test_to_silver_drops_card_and_keeps_order(spark):
    rows = [("u1", 10.5, "4532015112890367")]
    out = silver.to_silver(rows_to_df(spark, rows, CARD_SCHEMA), mode="affix")
    assert out.columns == ["user_id", "amount", "card_masked"]
    assert out.schema["amount"].dataType == T.DecimalType(12, 2)
    assert out.first().card_masked == "4532-XXXX-XXXX-0367"


def test_to_silver_p2_names(spark):
    df = spark.createDataFrame([(1, "4152889912345678", 10.0)],
                               "id long, card_number string, amount double")
    out = silver.to_silver_p2(df)
    assert "card_number" not in out.columns
    assert out.first().card_number_masked == "4152-XXXX-XXXX-5678"


def _user_days(spark, counts):
    rows = [(u, "2024-01-01", f"t-{u}-{i}", 1.0, 0) for u, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "user_id string, d string, transaction_id string, "
                                       "amount double, is_fraud_suspect int") \
        .withColumn("transaction_date", F.to_date("d")).drop("d")


def test_risk_threshold_is_strict(spark):
    df = _user_days(spark, {"u1": 5, "u2": 15, "u3": 12, "u4": 13})
    out = gold.risk_profile(df).filter("is_high_risk").collect()
    assert sorted(r.user_id for r in out) == ["u2", "u4"]
    p2 = gold.daily_features(df).filter("perfil_alto_riesgo = 1").collect()
    assert sorted(r.user_id for r in p2) == ["u2", "u4"]


def test_count_semantics_null_ids(spark):
    df = spark.createDataFrame(
        [("u", None, 1.0, 0), ("u", "a", 2.0, 1), ("u", "b", 3.0, 0)],
        "user_id string, transaction_id string, amount double, is_fraud_suspect int") \
        .withColumn("transaction_date", F.to_date(F.lit("2024-01-01")))
    p3 = gold.risk_profile(df).first()
    p2 = gold.daily_features(df).first()
    assert p3.tx_count == 3                      # count(*)
    assert p2.cantidad_transacciones_diarias == 2  # count(transaction_id)
    assert p2.contiene_sospecha_fraude == 1
    assert p3.daily_total == 6.0


def test_session_factory_reuses_active_session(spark):
    from cardrisk.session import get_spark_session, shuffle_partitions_for
    assert get_spark_session("other-app") is spark
    assert shuffle_partitions_for(4_800 * 1024 * 1024) == 32   # 4.8 GB / 150 MB
    assert shuffle_partitions_for(0) == 1


def test_small_helpers(spark):
    from cardrisk.operators.caching import cache_and_count
    from cardrisk.operators.reports import preview
    from cardrisk.sources.readers import run_sql
    df = spark.range(100)
    assert preview(df, 7).count() == 7
    persisted, n = cache_and_count(df.filter("id % 2 = 0"))
    try:
        assert n == 50 and persisted.is_cached
    finally:
        persisted.unpersist()
    out = run_sql(spark, "SELECT COUNT(*) AS n FROM helper_view WHERE id < 10",
                  {"helper_view": df}).first()
    assert out.n == 10


def test_card_scan_finds_numbers_in_every_form(spark):
    from cardrisk.operators.quality import card_scan
    good, bad = "4111111111111111", "4111111111111112"
    texts = [good, f"card {good[:4]}-{good[4:8]}-{good[8:12]}-{good[12:]} exp 2030", "3782 822463 10005",
             "4111.1111.1111.1111.2024", "6011000990139424", bad, f"9{good}", f"{good}9999", "1700000000000", "1700000000000000", "", None,
             "4111  1111 1111 1111", "12 34 56"]
    rows = [(t, int(good) if i == 0 else 1700000000000 + i, None if i else 4111111111111111.0,
             {"k": [good if i == 3 else "x"]}, (good if i == 4 else None, [i])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "a.b string, n long, d double, m map<string,array<string>>, s struct<x:string,y:array<int>>"
                               .replace("a.b", "`a.b`"))
    df = df.withColumn("money", F.col("n").cast("decimal(20,2)")).withColumn("day", F.current_date())
    got = {r.column_name: r.violations for r in card_scan(df, "raw").collect()}
    assert got == {"a.b": 5, "n": 1, "d": 1, "m": 1, "s.x": 1, "money": 1}
    assert card_scan(df.select("day")).count() == 0 and {r[2] for r in card_scan(df.limit(0)).collect()} == {0}


def _holds_card(text, first="23456"):
    """Every sequence of whole groups of every chain, as the scan's contract says it."""
    def luhn(d):
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
        return sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    for chain in re.findall("[0-9](?:[ .-]?[0-9])*", text):
        groups = re.split("[ .-]", chain)
        for i in range(len(groups)):
            for j in range(i, len(groups)):
                d = "".join(groups[i:j + 1])
                if 13 <= len(d) <= 19 and d[0] in first and luhn(d):
                    return True
    return False


def test_card_scan_tests_every_sequence_of_groups(spark):
    from cardrisk.operators.quality import card_scan
    rng, texts = random.Random(3), []
    for _ in range(1500):
        most, marks = rng.choice([2, 4, 7, 16, 22]), rng.choice([" ", " .-", [" ", "-", "", "  ", ", "]])
        groups = ["".join(rng.choices("0123456789", k=rng.randint(1, most))) + rng.choice(marks) for _ in range(rng.randint(4, 16))]
        texts.append(rng.choice(["", "no 7, ", "12 34  "]) + "".join(groups) + rng.choice(["", "x", "\n"]))
    texts += ["4111111111111111\n", "\u0664111111111111111", "", "1", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    want = [i for i, t in enumerate(texts) if _holds_card(t)]
    assert 200 < len(want) < 1300        # of both kinds
    assert card_scan(df.select("t")).first().violations == len(want)
    assert card_scan(df.filter(F.col("id").isin(want)).select("t")).first().violations == len(want)
    nested = df.select(F.array(F.struct("t")).alias("a"))
    assert card_scan(nested).first().violations == len(want)


def test_card_scan_tests_numbers_without_looking_for_chains(spark):
    from cardrisk.operators.quality import card_scan
    rows = [(4111111111111111, Decimal("4111111111111111"), 4111111111111111.5),
            (-4111111111111111, Decimal("-4111111111111111"), -4111111111111110.5),
            (-2**63, Decimal(9) * 10**18, math.nan), (None, None, None)]
    found = card_scan(spark.createDataFrame(rows, "n long, m decimal(20,0), d double"))
    assert {r.column_name: r.violations for r in found.collect()} == {"n": 2, "m": 2, "d": 2}
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_card_scan_of_long_chains(spark):
    """A chain's length takes no stack, and the work grows with it, not with the pairs of its groups."""
    from cardrisk.operators.quality import card_scan
    texts = ["4" * 40_000, "1 " * 20_000, "1-" * 20_000 + "4111.1111.1111.1111"]
    assert card_scan(spark.createDataFrame([(t,) for t in texts], "t string")).first().violations == 1


def test_shuffles_are_sized_by_their_inputs(spark, monkeypatch, tmp_path):
    from cardrisk import session
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert 0 < session.input_bytes(df) < 100_000
    with session.sized_shuffles(spark, df) as n:     # set at launch (conftest): left as it is
        assert n == int(before) == int(spark.conf.get(key))
    monkeypatch.setattr(session, "_given_by_launcher", lambda *a: False)
    for size, want in ((10, int(before)), (4_800 << 20, 32), (100 << 40, 699051)):
        monkeypatch.setattr(session, "input_bytes", lambda _: size)
        with session.sized_shuffles(spark, df) as n:
            assert n == want == int(spark.conf.get(key))
        assert spark.conf.get(key) == before
