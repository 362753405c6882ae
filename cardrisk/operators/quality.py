"""Data-quality and audit operators (Q1-Q6).

Every check is one aggregate over the layer (a single scan, partial
aggregation on the executors, one row to the driver at most).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import pct, storable_amount
from ..schemas import KEY_COL, RESTRICTED_COLUMNS

# A run of 13 to 19 digits is a possible full card number (PAN lengths).
PAN_PATTERN = "[0-9]{13,19}"
# At least 13 digits, single separators between them allowed; as long as possible (possessive:
# there is nothing to give back, and the length of a chain takes no stack).
CARD_CHAIN = "[0-9](?:[ .-]?+[0-9]){12,}+"


class QualityError(RuntimeError):
    """A publication gate (Q3 / Q4) failed."""


def reconcile_layers(bronze: DataFrame, amount_col: str = "amount") -> DataFrame:
    """Q1 + Q2: bronze rows, rows that pass the Silver filter, rejected rows and
    retention %, in one pass over Bronze (bronze = silver + rejected)."""
    ok = F.coalesce(storable_amount(amount_col, bronze.schema[amount_col].dataType), F.lit(False))
    return (bronze.agg(F.count(F.lit(1)).alias("bronze_rows"),
                       F.count_if(ok).alias("silver_rows"),
                       F.count_if(~ok).alias("rejected_rows"))
            .withColumn("retention_pct", pct("silver_rows", "bronze_rows")))


def restricted_columns_present(df: DataFrame,
                               restricted: tuple[str, ...] = RESTRICTED_COLUMNS) -> list[str]:
    """Q3: restricted column names present in the schema (a schema check, no job)."""
    names = {c.lower() for c in df.columns}
    return [c for c in restricted if c.lower() in names]


def assert_no_restricted_columns(df: DataFrame) -> None:
    found = restricted_columns_present(df)
    if found:
        raise QualityError(f"restricted columns present: {found}")


def pii_leak_scan(df: DataFrame, layer: str = "silver", pattern: str = PAN_PATTERN) -> DataFrame:
    """Q4: per string column, how many values contain a possible full card number.

    One aggregate with a ``count_if(rlike)`` per string column, then an
    unpivot to ``(layer, column_name, violations)``; every count must be 0.
    """
    string_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not string_cols:
        return df.sparkSession.createDataFrame(
            [], "layer string, column_name string, violations bigint")
    counts = df.agg(*[F.count_if(F.col(c).rlike(pattern)).alias(c) for c in string_cols])
    return (counts.unpivot([], string_cols, "column_name", "violations")
            .select(F.lit(layer).alias("layer"), "column_name", "violations"))


def _card_in_digits(digits: Column, first: str) -> Column:
    """Whether digits without separators are a card number as a whole: 13 to 19 of them, a
    card's first digit and a right check digit."""
    return digits.rlike(rf"\A[{first}][0-9]{{12,18}}\z") & F.call_function("luhn_check", digits)


def _card_in_text(text: Column, first: str) -> Column:
    """Whether a text holds a card number: 13 to 19 digits, in groups that single blanks,
    dots or hyphens separate, with a card's first digit and a right check digit.

    A chain of digit groups may hold more than the number (a date after it), so every
    sequence of whole groups is tested that has a card's length: from each group that starts
    as a card does, up to 19 digits on (and one more, that tells whether a group ends there).
    """
    starts = rf"(?<![0-9])(?=([{first}](?:[ .-]?+[0-9]){{12,18}}+[0-9]?))"

    def with_digits(part: Column) -> Column:
        digits = reduce(lambda d, mark: F.replace(d, F.lit(mark), F.lit("")), " .-", part)
        return F.struct(part.alias("text"), digits.alias("digits"))

    def in_groups(part: Column) -> Column:
        return reduce(lambda a, b: a | b, [
            F.call_function("luhn_check", part.digits.substr(1, n)) & part.text.rlike(rf"\A(?:[ .-]?+[0-9]){{{n}}}+(?![0-9])")
            for n in range(13, 20)])

    def in_chain(chain: Column) -> Column:
        parts = F.transform(F.regexp_extract_all(chain, F.lit(starts), F.lit(1)), with_digits)
        return F.when(chain.rlike("[ .-]"), F.exists(parts, in_groups)).otherwise(_card_in_digits(chain, first))

    chains = F.regexp_extract_all(text, F.lit(CARD_CHAIN), F.lit(0))
    return (F.when(text.rlike(r"\A[0-9]*\z"), _card_in_digits(text, first))
            .when(text.rlike(CARD_CHAIN), F.exists(chains, in_chain)).otherwise(F.lit(False)))


def _holds_card(col: Column, kind: T.DataType, first: str) -> Column | None:
    if isinstance(kind, T.StringType):
        return _card_in_text(col, first)
    if isinstance(kind, T.LongType) or isinstance(kind, T.DecimalType) and kind.scale == 0:
        return _card_in_digits(F.translate(col.cast("string"), "-", ""), first)
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        return _card_in_digits(F.abs(F.floor(col.try_cast("decimal(38,4)"))).cast("string"), first)
    if isinstance(kind, T.ArrayType):
        inner = _holds_card(F.lit(None).cast(kind.elementType), kind.elementType, first)
        return None if inner is None else F.exists(col, lambda x: _holds_card(x, kind.elementType, first))
    if isinstance(kind, T.MapType):
        sides = [_holds_card(f(col), T.ArrayType(t), first)
                 for f, t in ((F.map_keys, kind.keyType), (F.map_values, kind.valueType))]
    elif isinstance(kind, T.StructType):
        sides = [_holds_card(col.getField(f.name), f.dataType, first) for f in kind.fields]
    else:
        return None
    sides = [F.coalesce(s, F.lit(False)) for s in sides if s is not None]
    return reduce(lambda a, b: a | b, sides) if sides else None


def card_scan(df: DataFrame, layer: str = "silver", first_digits: str = "23456") -> DataFrame:
    """Q4 with check digits: per column, how many values hold a card number.

    Unlike ``pii_leak_scan`` it sees numbers written with separators, in integral,
    decimal and floating columns and inside structs, arrays and maps, and
    tests the Luhn check digit and the first digit (``first_digits``: payment cards;
    epoch times and other digit runs pass neither).  Fields of structs are reported by
    path.  Digits that do not stand as whole groups (a number inside a longer run of
    digits) are no card number.  NULL values hold none; columns of other types
    (dates, booleans, binary) are not listed.
    """
    tests: list[tuple[str, Column]] = []

    def walk(path: str, col: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f"{path}.{f.name}", col.getField(f.name), f.dataType)
        elif (test := _holds_card(col, kind, first_digits)) is not None:
            tests.append((path, test))

    for f in df.schema.fields:
        walk(f.name, F.col(f"`{f.name.replace('`', '``')}`"), f.dataType)
    if not tests:
        return df.sparkSession.createDataFrame([], "layer string, column_name string, violations bigint")
    counts = df.agg(*[F.count_if(t).alias(f"c{i}") for i, (_, t) in enumerate(tests)])
    names = F.array(*[F.struct(F.lit(p).alias("column_name"), F.col(f"c{i}").alias("violations"))
                      for i, (p, _) in enumerate(tests)])
    return counts.select(F.inline(names)).select(F.lit(layer).alias("layer"), "column_name", "violations")


def assert_no_leaks(df: DataFrame, layer: str = "silver",
                    id_columns: tuple[str, ...] = (KEY_COL, "user_id")) -> None:
    """Q3 + Q4 gate used before publishing a layer: long digit runs in text, card
    numbers in any form.  Keys (``id_columns``) may be long numbers, of which some pass the
    check digit by chance; only their digit runs in text are tested."""
    assert_no_restricted_columns(df)
    scans = pii_leak_scan(df, layer).unionByName(card_scan(df.drop(*id_columns), layer))
    bad = scans.groupBy("column_name").agg(F.max("violations").alias("violations")).filter("violations > 0").collect()
    if bad:
        raise QualityError("possible card numbers in " +
                           ", ".join(f"{r.column_name} ({r.violations})" for r in bad))


def user_rollup(gold: DataFrame, flag_col: str = "is_high_risk") -> DataFrame:
    """Gold reduced to one row per user: user-days and high-risk user-days."""
    return (gold.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("days"),
                 F.count_if(F.col(flag_col).cast("boolean")).alias("risk_days")))


def run_summary(bronze: DataFrame, silver: DataFrame, gold: DataFrame,
                flag_col: str = "is_high_risk") -> DataFrame:
    """Q5 + Q6: one row with rows per layer, retention, users and high-risk
    figures.  High-risk *user-days* and high-risk *users* are reported
    separately (the notebook labels the first as users).

    Gold is aggregated once (per user, then globally); the Bronze and Silver
    counts enter as scalar subqueries, so no join is planned.
    """
    users = user_rollup(gold, flag_col)
    base = users.agg(F.sum("days").alias("gold_rows"),
                     F.count("user_id").alias("unique_users"),
                     F.sum("risk_days").alias("high_risk_user_days"),
                     F.count_if((F.col("risk_days") > 0) & F.col("user_id").isNotNull())
                      .alias("high_risk_users"))
    bronze_rows = bronze.agg(F.count(F.lit(1))).scalar()
    silver_rows = silver.agg(F.count(F.lit(1))).scalar()
    return (base.select(
        bronze_rows.alias("bronze_rows"),
        silver_rows.alias("silver_rows"),
        pct(silver_rows, bronze_rows).alias("retention_pct"),
        F.coalesce(F.col("gold_rows"), F.lit(0)).cast("bigint").alias("gold_rows"),
        F.col("unique_users"),
        F.coalesce(F.col("high_risk_user_days"), F.lit(0)).cast("bigint")
         .alias("high_risk_user_days"),
        F.col("high_risk_users")))
