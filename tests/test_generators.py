"""Generator profiles: determinism and the distribution numbers of SURVEY §5."""

import datetime as dt

from pyspark.sql import functions as F

from cardrisk.operators import generate as gen

N = 100_000


def test_p3_profile_distribution(spark):
    df = gen.generate(spark, gen.P3Profile(), N, partitions=8)
    s = df.agg(F.count(F.lit(1)).alias("n"),
               F.count_if(F.col("amount") <= 0).alias("bad"),
               F.count_distinct("user_id").alias("users"),
               F.count_distinct("card").alias("cards"),
               F.count_distinct("merchant").alias("merchants"),
               F.min("transaction_date").alias("d0"), F.max("transaction_date").alias("d1"),
               F.count_if(F.length("card") != 16).alias("short_cards")).first()
    assert s.n == N
    assert s.bad == N // 50                      # every 50th row, exactly
    assert s.users <= 10_000 and s.cards <= 2_000 and s.merchants <= 500
    assert s.d0 >= dt.date(2026, 1, 1) and s.d1 <= dt.date(2026, 6, 30)
    assert s.short_cards == 0
    mix = {r.currency: r["count"] / N for r in df.groupBy("currency").count().collect()}
    for code, w in zip(gen.P3_CURRENCIES, gen.P3_CURRENCY_WEIGHTS):
        assert abs(mix[code] - w / 100) < 0.01
    # the amount pool has at most 10,000 distinct positive values
    assert df.filter("amount > 0").select("amount").distinct().count() <= 10_000


def test_p2_profile_distribution(spark):
    p = gen.P2Profile()
    df = gen.generate(spark, p, N, partitions=8)
    s = df.agg(F.min("amount").alias("lo"), F.max("amount").alias("hi"),
               F.avg("is_fraud_suspect").alias("suspect"),
               F.min("transaction_date").alias("d0"), F.max("transaction_date").alias("d1"),
               F.count_distinct("transaction_id").alias("ids"),
               F.count_if(~F.col("card_number").rlike("^4152[0-9]{12}$")).alias("bad_cards"),
               F.max("user_id").alias("max_user")).first()
    assert float(s.lo) >= 5.0 and float(s.hi) < 4505.0
    assert abs(s.suspect - 0.03) < 0.005
    assert s.d1 == p.as_of and s.d0 == p.as_of - dt.timedelta(days=p.days - 1)
    assert s.ids == N and s.bad_cards == 0 and s.max_user < 50_000
    assert df.schema["amount"].dataType.simpleString() == "decimal(10,2)"


def test_demo_profile(spark):
    df = gen.generate(spark, gen.DemoProfile(), 50_000, partitions=4)
    s = df.agg(F.count_if(F.col("amount") <= 0).alias("bad"),
               F.count_distinct("user_id").alias("users"),
               F.count_distinct(F.hour("timestamp")).alias("hours"),
               F.min("amount").alias("lo")).first()
    assert s.bad == -(-50_000 // 75)
    assert s.users <= 500 and s.hours == 24
    assert set(r.merchant for r in df.select("merchant").distinct().collect()) <= set(gen.DEMO_MERCHANTS)


def test_generation_is_deterministic_across_partitionings(spark):
    a = gen.generate(spark, gen.P3Profile(), 5_000, partitions=1)
    b = gen.generate(spark, gen.P3Profile(), 5_000, partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_p3_acceptance_numbers_at_the_same_density(spark):
    """SURVEY §5: at lambda = 5.414 rows per user-day (9.8M / (10,000 x 181)),
    about 0.39 % of the user-days are high-risk and about 50.9 % of the users are
    high-risk on some day.  Same density with 1,000 users and 1M rows."""
    from cardrisk.operators import gold, silver
    from cardrisk.operators.reports import risk_global
    df = gen.generate(spark, gen.P3Profile(users=1_000), 1_000_000, partitions=8)
    g = gold.risk_profile(silver.to_silver(df)).cache()
    try:
        s = g.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("is_high_risk").cast("double"))
                  .alias("share")).first()
        users = risk_global(g).first()
    finally:
        g.unpersist()
    assert abs(s.share - 0.0039) < 0.0012
    assert abs(users.pct_high_risk - 50.9) < 6
    assert s.n <= 1_000 * 181


def test_p2_high_risk_share_at_the_same_density(spark):
    """SURVEY §5: at lambda = 6.67 (15M / (50,000 x 45)) about 1.9 % of the
    user-days are high-risk.  Same density with 3,333 users and 1M rows."""
    from cardrisk.operators import gold, silver
    df = gen.generate(spark, gen.P2Profile(users=3_333), 1_000_000, partitions=8)
    g = gold.daily_features(silver.to_silver_p2(df))
    share = g.agg(F.avg("perfil_alto_riesgo")).first()[0]
    assert abs(share - 0.019) < 0.005
