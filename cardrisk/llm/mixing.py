"""Mixing sources to target weights by iterative proportional fitting (native).

Method.  Token counts are summed per cell (source, language, topic).  Raking
visits the three dimensions in turn and scales each value's factor so that the
weighted tokens of the value meet its target share, until none moves by 1e-4.  Targets
that no weights of the cells can meet leave a residual, which is returned (``mix_residual``) and
raises ``RakingError`` where it is over the one allowed.  A
document's weight w is the product of its three factors.  The expected number of
its copies is c*w, with one scale c for all: the least that keeps the expected share
``keep`` of the tokens, each document counted once, or that keeps the hottest
cell whole if this is more.  The sampling probability is min(1, c*w); ``mix_repeats``
says how often a document is to be repeated, so that the expected repeated tokens
have the target marginals.  A hash of doc_id decides.

Scale.  One narrow pass and a pre-aggregated shuffle to cells; raking works on
the cells with partial sums, a staged table per step.  No step depends on the
number of documents, and no dimension value is collected.

NULL source, language or topic is a value of its own, ``(null)``.  Texts without
words have no tokens and get their cell's factors.  Cells whose target is
missing get factor 0.  Repeated rows are decided alike; NULL ids share one hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged

DIMS = ("source", "lang", "topic")
# Default topic rules, in this order: (topic, pattern on the lower-cased text).
TOPICS = (("legal", "licen[sc]e|copyright|all rights reserved"), ("contact", r"@[a-z0-9.-]+\.[a-z]{2,}"),
          ("code", "token *=|password *=|api[_-]?key"), ("table", r"\|[^|\n]*\|"))
NAMES = ["source", "lang", "topic", "n_tokens"]


def topic_of(text: Column) -> Column:
    """The first topic whose pattern is found; ``prose`` otherwise."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(low.rlike(pattern), name).otherwise(out)
    return out


def with_cells(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``docs`` with ``_source, _lang, _topic`` (never NULL) and ``n_tokens`` (words)."""
    topic = topic_of(F.col("text").cast("string")) if topic is None else topic
    blanks = r"[\x20\x09-\x0D]+"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n = F.size(F.filter(F.split(text, blanks), lambda w: w != "")).cast("long")

    def known(c):
        return F.coalesce(c.cast("string"), F.lit("(null)"))
    return docs.select(*[c for c in docs.columns if c not in ("_source", "_lang", "_topic", "n_tokens")],
                       known(F.col("source")).alias("_source"), known(F.col("lang")).alias("_lang"),
                       known(topic).alias("_topic"), n.alias("n_tokens"))


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(value, target): shares of the cells' tokens raised to ``power`` and renormalised."""
    value = cells.groupBy(F.col(f"_{dim}").alias("value")).agg(F.sum("tokens").alias("t")).where("t > 0")
    value = value.withColumn("p", F.pow(F.col("t").cast("double"), power))
    whole = value.agg(F.sum("p")).first()[0] or 1.0
    return value.select("value", (F.col("p") / F.lit(whole)).alias("target"))


class RakingError(Exception):
    """The weights found are too far from the targets."""


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-4,
         max_rounds: int = 50, allowed: float | None = None) -> tuple[dict[str, DataFrame], float]:
    """Factor tables (value, f) per dimension, and the residual: the greatest relative
    correction of a factor in the last round (0.01: a marginal was 1% off its target).
    ``cells``: ``_source, _lang, _topic, tokens``.  Raking ends at ``tolerance`` or after
    ``max_rounds``; a residual over ``allowed``, if given, raises ``RakingError``."""
    moved = 0.0
    factors = {d: staged(targets[d].select("value", F.lit(1.0).alias("f"), "target"), "op7-f") for d in DIMS}
    for _ in range(max_rounds):
        moved = 0.0
        for d in DIMS:
            rows = cells
            for other in DIMS:
                if other != d:
                    f = factors[other].select(F.col("value").alias(f"_{other}"), F.col("f").alias(f"f_{other}"))
                    rows = rows.join(f, f"_{other}", "left")
            weight = F.col("tokens").cast("double")
            for other in DIMS:
                if other != d:
                    weight = weight * F.coalesce(f"f_{other}", F.lit(0.0))
            margin = rows.groupBy(F.col(f"_{d}").alias("value")).agg(F.sum(weight).alias("m"))
            new = factors[d].join(margin, "value", "left").select(
                "value", F.when(F.col("m") > 0, F.col("target") / F.col("m")).otherwise(0.0).alias("f"), "target",
                F.when((F.col("m") > 0) & (F.col("f") > 0), F.abs(F.col("target") / F.col("m") / F.col("f") - 1))
                .otherwise(0.0).alias("step"))
            new = staged(new, "op7-f")
            moved = max(moved, new.agg(F.max("step")).first()[0] or 0.0)
            factors[d] = new.drop("step")
        if moved < tolerance:
            break
    if allowed is not None and moved > allowed:
        raise RakingError(f"targets not met after {max_rounds} rounds: a marginal is still off by {moved:.3g}")
    return {d: f.select("value", "f") for d, f in factors.items()}, moved


def scale(weighed: DataFrame, keep: float) -> float:
    """The least c, 1 / the largest weight at least, for which min(1, c*w) keeps the
    share ``keep`` of the tokens of cells with weight; ``weighed``: tokens, w.

    Kept tokens are piecewise linear and concave in c, so Newton steps from the left
    end on the solution after at most as many steps as there are different weights.
    """
    cells = weighed.where("tokens > 0 and w > 0")
    top, total = cells.agg(F.max("w"), F.sum("tokens")).first()
    if top is None:
        return 1.0
    c = 1.0 / top
    while True:
        whole, rest = cells.agg(F.sum(F.when(F.col("w") * c >= 1, F.col("tokens"))),
                                F.sum(F.when(F.col("w") * c < 1, F.col("tokens") * F.col("w")))).first()
        if not rest:
            return c
        new = (keep * total - (whole or 0)) / rest
        if new <= c * (1 + 1e-12):
            return c
        c = new


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = 0.9, seed: int = 11,
          topic: Column | None = None, keep: float = 0.75, allowed: float | None = None) -> DataFrame:
    """``docs`` with topic, n_tokens, mix_weight, mix_probability, mix_residual, mix_kept and
    mix_repeats (0 where not kept).

    ``keep``: expected share of the tokens to keep at least, 0 to 1 (0: only the hottest cell is sure to stay whole).
    ``targets``: (value, target share) per dimension; by default the corpus' own
    shares raised to ``power`` (1: as they are, 0: all alike).  ``mix_residual``, the same in
    every row: the greatest relative distance of a marginal from its target in the last round;
    more than ``allowed``, if given, raises ``RakingError``.
    """
    rows = with_cells(docs.drop("topic", "mix_weight", "mix_probability", "mix_residual", "mix_kept", "mix_repeats"), topic)
    cells = staged(rows.groupBy(*[f"_{d}" for d in DIMS]).agg(F.sum("n_tokens").alias("tokens")), "op7-cells")
    targets = targets or {d: tempered(cells, d, power) for d in DIMS}
    factors, residual = rake(cells.where("tokens > 0"), targets, allowed=allowed)
    weighed = cells
    for d in DIMS:
        weighed = weighed.join(factors[d].select(F.col("value").alias(f"_{d}"), F.col("f").alias(f"f_{d}")),
                               f"_{d}", "left")
    weight = F.lit(1.0)
    for d in DIMS:
        weight = weight * F.coalesce(f"f_{d}", F.lit(0.0))
    weighed = staged(weighed.select(*[f"_{d}" for d in DIMS], "tokens", weight.alias("w")), "op7-weights")
    copies = F.col("w") * scale(weighed, keep)
    cell = weighed.select(*[f"_{d}" for d in DIMS], F.col("w").alias("mix_weight"),
                          F.least(F.lit(1.0), copies).alias("mix_probability"), copies.alias("_copies"))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") / float(1 << 53)
    rows = rows.join(broadcast_if_small(cell), [f"_{d}" for d in DIMS], "left")
    more = F.floor("_copies") + (draw < F.col("_copies") - F.floor("_copies")).cast("long")
    rows = rows.withColumn("mix_residual", F.lit(residual)).withColumn("mix_kept", draw < F.col("mix_probability")).withColumn("mix_repeats", more)
    return rows.withColumnRenamed("_topic", "topic").drop("_source", "_lang", "_copies")
