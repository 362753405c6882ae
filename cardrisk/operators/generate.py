"""Synthetic transaction generators (G1-G9), one Spark job per profile.

A profile is a narrow projection over a DataFrame of row ids: every column
is a hash-derived function of ``id`` (``functions.hashing``), so the data is
generated in parallel on the executors, is identical on every evaluation
and task retry, and never passes through the driver.  ``ids`` is either
``spark.range(n)`` (S4) or any id column Spark already has (the registered
queries use the ``events`` ids, so their work grows with the tables).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import (hash_int, hash_normal, hash_uuid, pick, pick_weighted, zero_pad,
                                 pool_label)
from ..sources.readers import id_range

# ---------------------------------------------------------------------------
# Fixed values of the reference's generators.
P2_CATEGORIES = ("Retail", "Banca", "Restaurantes", "Viajes", "E-Commerce")
P3_CURRENCIES = ("USD", "EUR", "CLP", "BRL", "MXN")
P3_CURRENCY_WEIGHTS = (50, 20, 15, 10, 5)
DEMO_MERCHANTS = ("Amazon", "Netflix", "Spotify", "Uber", "Rappi", "Falabella",
                  "MercadoLibre", "Disney+", "Apple", "Google")
DEMO_CARDS = ("4532015112890367", "4916123456789012", "4556123456789013",
              "4929123456789014", "4539123456789015", "4485123456789016",
              "4716123456789017", "4024123456789018", "4532123456789019",
              "4913123456789020")
DEMO_CURRENCIES = ("USD", "EUR", "CLP", "BRL")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class P2Profile:
    """G1: phase-2 profile (15M rows in the reference)."""
    users: int = 50_000
    card_prefix: str = "4152"
    amount_min_cents: int = 500
    amount_span_cents: int = 450_000
    days: int = 45
    as_of: _dt.date = _dt.date(2026, 6, 30)
    suspect_per_100: int = 3
    salt: str = "p2"


@dataclass(frozen=True)
class P3Profile:
    """Phase-3 profile (10M rows in files of 50,000 in the reference)."""
    users: int = 10_000
    merchants: int = 500
    cards: int = 2_000
    start: _dt.date = _dt.date(2026, 1, 1)
    days: int = 181
    amount_pool: int = 10_000
    mu: float = 3.0
    sigma: float = 1.2
    defect_every: int = 50
    currencies: tuple = P3_CURRENCIES
    currency_weights: tuple = P3_CURRENCY_WEIGHTS
    salt: str = "p3"


@dataclass(frozen=True)
class DemoProfile:
    """The 50,000-row notebook profile."""
    users: int = 500
    merchants: tuple = DEMO_MERCHANTS
    cards: tuple = DEMO_CARDS
    currencies: tuple = DEMO_CURRENCIES
    start: _dt.date = _dt.date(2026, 1, 1)
    days: int = 181
    hours: int = 24
    mean: float = 150.0
    std: float = 300.0
    defect_every: int = 75
    salt: str = "demo"


def ids_from(df: DataFrame, col: str) -> DataFrame:
    """Use an existing id column (BIGINT) as the generator's ``id``."""
    return df.select(F.col(col).cast("bigint").alias("id"))


def lognormal_pool_amount(row_id: Column, salt: str, pool: int, mu: float, sigma: float) -> Column:
    """Draw from a pool of ``pool`` log-normal(mu, sigma) amounts, rounded to cents."""
    k = hash_int(f"{salt}/amount_idx", row_id) % F.lit(pool)
    return F.round(F.exp(F.lit(mu) + F.lit(sigma) * hash_normal(f"{salt}/lognormal", k)), 2)


def folded_gauss_amount(row_id: Column, salt: str, mean: float, std: float) -> Column:
    """``round(|gauss(mean, std)| + 0.01, 2)``."""
    z = hash_normal(f"{salt}/gauss", row_id)
    return F.round(F.abs(F.lit(mean) + F.lit(std) * z) + F.lit(0.01), 2)


def with_defects(amount: Column, row_id: Column, every: int, salt: str,
                 choices: int = 2) -> Column:
    """Every ``every``-th row gets ``-|amount|`` or ``0.0`` (hash choice)."""
    pick_neg = hash_int(f"{salt}/defect", row_id) % F.lit(choices) == 0
    return (F.when(row_id % F.lit(every) == 0,
                   F.when(pick_neg, -F.abs(amount)).otherwise(F.lit(0.0)))
             .otherwise(amount))


def generate_p2(ids: DataFrame, profile: P2Profile = P2Profile()) -> DataFrame:
    """G1: ``id, transaction_id, user_id, card_number, amount decimal(10,2),
    merchant_category, transaction_date, is_fraud_suspect``."""
    p, i = profile, F.col("id")
    cents = F.lit(p.amount_min_cents) + hash_int(f"{p.salt}/amount", i) % F.lit(p.amount_span_cents)
    return ids.select(
        i.alias("id"),
        hash_uuid(f"{p.salt}/txid", i).alias("transaction_id"),
        (hash_int(f"{p.salt}/user", i) % F.lit(p.users)).cast("int").alias("user_id"),
        F.concat(F.lit(p.card_prefix),
                 F.lpad((hash_int(f"{p.salt}/card", i, 12) % F.lit(10 ** 12)).cast("string"),
                        12, "0")).alias("card_number"),
        (cents / F.lit(100.0)).cast("decimal(10,2)").alias("amount"),
        pick(P2_CATEGORIES, hash_int(f"{p.salt}/category", i)).alias("merchant_category"),
        F.date_sub(F.lit(p.as_of), (hash_int(f"{p.salt}/date", i) % F.lit(p.days)).cast("int"))
         .alias("transaction_date"),
        F.when(hash_int(f"{p.salt}/suspect", i) % F.lit(100) >= F.lit(100 - p.suspect_per_100), 1)
         .otherwise(0).alias("is_fraud_suspect"),
    )


def generate_p3(ids: DataFrame, profile: P3Profile = P3Profile()) -> DataFrame:
    """The phase-3 raw schema (``transaction_id, user_id, card, amount,
    transaction_date, timestamp, merchant, currency``)."""
    p, i = profile, F.col("id")
    user_idx = hash_int(f"{p.salt}/user", i) % F.lit(p.users)
    card_idx = hash_int(f"{p.salt}/card", i) % F.lit(p.cards)
    card_no = F.concat(F.lit("4"), F.lpad(
        (hash_int(f"{p.salt}/card_no", card_idx, 15) % F.lit(10 ** 15)).cast("string"), 15, "0"))
    amount = lognormal_pool_amount(i, p.salt, p.amount_pool, p.mu, p.sigma)
    day = F.date_add(F.lit(p.start), (hash_int(f"{p.salt}/date", i) % F.lit(p.days)).cast("int"))
    return ids.select(
        F.concat(F.lit("tx-"), zero_pad(i.cast("string"), 8)).alias("transaction_id"),
        hash_uuid(f"{p.salt}/user_id", user_idx).alias("user_id"),
        card_no.alias("card"),
        with_defects(amount, i, p.defect_every, p.salt, choices=3).alias("amount"),
        day.alias("transaction_date"),
        day.cast("timestamp_ntz").alias("timestamp"),
        pool_label("merchant_", hash_int(f"{p.salt}/merchant", i), p.merchants, 3)
         .alias("merchant"),
        pick_weighted(p.currencies, p.currency_weights, hash_int(f"{p.salt}/currency", i))
         .alias("currency"),
    )


def generate_demo(ids: DataFrame, profile: DemoProfile = DemoProfile()) -> DataFrame:
    """The notebook profile (random hour of day, folded-Gaussian amounts)."""
    p, i = profile, F.col("id")
    day_offset = (hash_int(f"{p.salt}/date", i) % F.lit(p.days)).cast("int")
    hour = (hash_int(f"{p.salt}/hour", i) % F.lit(p.hours)).cast("int")
    ts = F.make_timestamp_ntz(F.lit(p.start.year), F.lit(p.start.month), F.lit(p.start.day),
                              hour, F.lit(0), F.lit(0))
    ts = F.timestamp_add("DAY", day_offset, ts)
    amount = folded_gauss_amount(i, p.salt, p.mean, p.std)
    return ids.select(
        F.concat(F.lit("demo-"), zero_pad(i.cast("string"), 6)).alias("transaction_id"),
        hash_uuid(f"{p.salt}/user_id", hash_int(f"{p.salt}/user", i) % F.lit(p.users))
         .alias("user_id"),
        pick(p.cards, hash_int(f"{p.salt}/card", i)).alias("card"),
        with_defects(amount, i, p.defect_every, p.salt, choices=2).alias("amount"),
        F.to_date(ts).alias("transaction_date"),
        ts.alias("timestamp"),
        pick(p.merchants, hash_int(f"{p.salt}/merchant", i)).alias("merchant"),
        pick(p.currencies, hash_int(f"{p.salt}/currency", i)).alias("currency"),
    )


def generate(spark: SparkSession, profile, n: int, partitions: int | None = None) -> DataFrame:
    """Generate ``n`` rows of ``profile`` from ``spark.range(n)``."""
    ids = id_range(spark, n, partitions)
    if isinstance(profile, P2Profile):
        return generate_p2(ids, profile)
    if isinstance(profile, P3Profile):
        return generate_p3(ids, profile)
    if isinstance(profile, DemoProfile):
        return generate_demo(ids, profile)
    raise TypeError(f"unknown profile {type(profile).__name__}")
