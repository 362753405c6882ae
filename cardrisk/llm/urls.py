"""URL filters: host and path rules, and gradient-boosted trees for the rest (native).

Method.  Lexical features of a URL (lengths, depth, digit ratio, entropy, hyphens,
parameter counts, and the smoothed block rate of its host suffix) feed gradient-
boosted trees.  Labelled URLs are those that a rule decides, plus URLs whose host
holds one of ``SEED_TERMS`` (labelled block).  The rule's verdict stands where a
rule fits; the trees decide the rest.

Scale.  Features are column expressions.  Training rows are grouped by their
(rounded) feature vector, with counts as weights, so the trees are fitted to
distinct vectors; suffix statistics are one pre-aggregated group-by.

A NULL URL, or one without ``://``, has an empty host and path, matches no rule and
is scored on its empty parts.  If the labelled URLs are all of one kind, that is the
verdict; without any it is ``allow``.  Repeated rows give equal rows.  Columns of the
input with the name of an added or a feature column are left out of the result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (verdict, rule); a rule is a host suffix and a path prefix.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
SEED_TERMS = ("casino", "bets", "betting", "pills", "viagra", "ads", "track", "porn", "xxx", "loan", "warez")
FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "hyphens",
            "entropy", "params", "has_fragment", "secure", "suffix_rate"]


def host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of columns host and path: the longest fitting rule, else NULL."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = (F.col("host") == name) | F.col("host").endswith("." + name)
        fits = fits & F.col("path").startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def with_features(df: DataFrame) -> DataFrame:
    """Add ``suffix`` and the lexical features but the suffix statistic."""
    url = F.coalesce("url", F.lit(""))
    length = F.char_length(url)

    def count(text, pattern):
        return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("double")
    letters = F.array_compact(F.split(F.lower(F.col("host")), ""))
    letters = F.filter(letters, lambda c: c != "")
    size = F.size(letters)
    entropy = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda s, c: s - (
        F.size(F.filter(letters, lambda x: x == c)) / size) * F.log2(F.size(F.filter(letters, lambda x: x == c)) / size))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.withColumns({
        "suffix": F.substring_index("host", ".", -1),
        "url_length": F.round(length / 4).cast("double"),
        "host_length": F.char_length("host").cast("double"),
        "path_length": F.char_length("path").cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
        "labels": F.size(F.split("host", r"\.")).cast("double"),
        "digit_ratio": F.round(F.when(length > 0, count(url, "[0-9]") / length).otherwise(0.0), 1),
        "host_digits": count(F.col("host"), "[0-9]"),
        "hyphens": count(F.col("host"), "-"),
        "entropy": F.round(F.coalesce(entropy, F.lit(0.0)), 1),
        "params": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "has_fragment": F.instr(url, "#").cast("boolean").cast("double"),
        "secure": F.lower(url).startswith("https://").cast("double")})


def judged(pages: DataFrame, rules=RULES, seeds=SEED_TERMS, iterations: int = 10, depth: int = 4,
           block_at: float = 0.8) -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_score (of the trees).

    Without a rule a URL is blocked at a score over ``block_at``: a path-scoped rule
    labels URLs that look like their neighbours outside the path, so scores near
    one half mean no more than that.
    """
    added = ["host", "path", "rule", "verdict", "block_score", "suffix", "_rule", "_verdict", "_y", "_x",
             "rawPrediction", "probability", "prediction", *FEATURES]
    own = [c for c in pages.columns if c not in added]
    rule, verdict = rule_columns(rules)
    rows = with_features(host_and_path(pages.select(*own))).withColumns({"_rule": rule, "_verdict": verdict})
    seed = F.col("host").rlike("(^|[.-])(" + "|".join(seeds) + ")([.-]|$)")
    rows = rows.withColumn("_y", F.when(F.col("_verdict").isNotNull(), (F.col("_verdict") == "block").cast("double"))
                           .when(seed, 1.0))
    lexical = FEATURES[:-1]
    known = staged(rows.where("_y is not null").groupBy("suffix", "_y", *lexical).agg(F.count("*").alias("n")),
                   "op8-known")
    kinds = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.sum("n").alias("n")).collect()}  # at most two rows
    share = kinds.get(1.0, 0) / max(1, sum(kinds.values()))
    rate = staged(known.groupBy("suffix").agg(
        F.round((F.sum(F.col("n") * F.col("_y")) + 10 * share) / (F.sum("n") + 10), 2).alias("suffix_rate")), "op8-suffix")
    rows = rows.join(broadcast_if_small(rate), "suffix", "left").fillna({"suffix_rate": round(share, 2)})
    if len(kinds) < 2:
        rows = rows.withColumn("block_score", F.lit(float(share)))
    else:
        put = VectorAssembler(inputCols=FEATURES, outputCol="_x")
        train = put.transform(known.join(broadcast_if_small(rate), "suffix")).select("_x", "_y", "n")
        model = GBTClassifier(featuresCol="_x", labelCol="_y", weightCol="n", maxIter=iterations, maxDepth=depth,
                              stepSize=0.3, seed=5).fit(train)
        rows = model.transform(put.transform(rows)).withColumn("block_score", vector_to_array("probability")[1])
    return rows.select(*own, "host", "path", F.col("_rule").alias("rule"), F.coalesce(
        "_verdict", F.when(F.col("block_score") > block_at, "block").otherwise("allow")).alias("verdict"), "block_score")
