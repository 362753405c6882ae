"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (crosstok, decontaminate, fingerprints, language, line_dedup, mixing, near_dedup, ngram_join, quality,
               runs, toxicity, urls, warc)
from .common import load, staged


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair in which the document holds the item."""
    got = decontaminate.contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return got.withColumn("containment", F.round(F.col("shared") / F.col("item_shingles"), 6))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the blocks that an earlier document holds cut out."""
    cut = line_dedup.dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("line_dedup_lines").alias("n_lines"),
                      F.col("line_dedup_removed").alias("removed_lines"),
                      F.col("line_dedup_words").alias("removed_words"),
                      F.array_join("line_dedup_partners", ",").alias("partners"), "text")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes on 4-word shingles at 0.8."""
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"), n=4, percent=80)


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    rows = fingerprints.with_next(load(spark, sf_dir, "documents"))
    rows = rows.withColumn("edited", fingerprints.edited("text", "next_text")).drop("next_text")
    rows = fingerprints.with_fingerprint(rows, "edited", "edited_fp")
    fp, changed, after = (F.col(c) for c in ("fp", "edited_fp", "next_fp"))
    return rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprints.as_text(fp).alias("fingerprint"),
                       fingerprints.as_text(changed).alias("edited_fingerprint"),
                       fingerprints.likeness(fp, changed).alias("near_edited"),
                       fingerprints.likeness(fp, after).alias("near_next"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an ARC archive, the converter and a WARC archive."""
    arc, out = scratch_path(spark, "op5-arc"), scratch_path(spark, "op5-warc")
    warc.write_arc(warc.arc_rows(load(spark, sf_dir, "pages")), arc, version=(1, 2))
    warc.write_warc(warc.read_arc(spark, arc), out, warc.page_order(), warc.read_arc(spark, arc, blocks=False))
    rows = warc.read_warc(spark, out, payloads=False).select(
        "record", F.expr("try_cast(page as long)").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers_to").alias("to"))
    rows = staged(rows, "op5-records")
    first = rows.where("record_type <> 'revisit'").groupBy(F.col("record").alias("to")).agg(
        F.min("page_id").alias("refers_to"))
    return rows.join(first, "to", "left").select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                 "refers_to")


def _remainder(by: int):
    return F.crc32(F.col("doc_id").cast("string")) % by


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from four fifths of the labels."""
    docs = load(spark, sf_dir, "documents")
    got = quality.scored(docs, quality.train(docs, load(spark, sf_dir, "labels").where(_remainder(5) != 0)))
    return got.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, sampling probability and decision of every document."""
    got = mixing.mixed(load(spark, sf_dir, "documents"))
    return got.select("doc_id", "source", "lang", "topic", "n_tokens", "mix_weight", "mix_probability", "mix_kept",
                      "mix_repeats", "mix_residual")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    got = urls.judged(load(spark, sf_dir, "pages").select("page_id", "url"))
    return got.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from two thirds of the labels."""
    docs = load(spark, sf_dir, "documents")
    model = toxicity.train(docs, load(spark, sf_dir, "labels").where(_remainder(3) != 1))
    got = toxicity.scored(docs, model)
    return got.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_hits",
                      F.array_join("terms", ",").alias("terms"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = load(spark, sf_dir, "documents")
    got = language.predict(docs, language.train(docs.where(_remainder(5) != 0)))
    return got.select("doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score",
                      F.array_join("lang_set", ",").alias("lang_set"))


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 4-word shingles at 0.85."""
    return ngram_join.jaccard_components(load(spark, sf_dir, "documents"), n=4, percent=85)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every document, a tenth of them with a planted loop."""
    docs = load(spark, sf_dir, "documents").select("doc_id", runs.looped(F.col("text"), F.col("doc_id")).alias("text"))
    got = runs.periodic_runs(docs)
    top = runs.longest(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return got.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-top["before"]).alias("start"), top["length"].alias("length"),
        (-top["short"]).alias("period"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    ).withColumn("exponent_milli", F.floor(F.col("length") * 1000 / F.col("period"))).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies, for every document."""
    rows = staged(crosstok.alignments(load(spark, sf_dir, "documents"), whole=False), "op13-aligned")
    return crosstok.with_counts(rows).withColumnRenamed("groups", "groups_sha256").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_document_fingerprints, op3_line_dedup, op4_minhash_near_dedup, op5_warc,
    op6_quality_classifier, op7_mixing, op8_url_filters, op9_toxicity, op10_language_id,
    op11_ngram_jaccard_join, op12_periodic_runs, op13_tokenizer_alignment)}

_WORDS5 = """list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')"""

_LINKED = r"""
WITH RECURSIVE
     w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
     s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
              THEN list_transform(range(1, len(w) - 2), lambda k: hash(array_to_string(w[k:k+3], ' ')))
              WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] END) AS s FROM w WHERE len(w) > 0),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
     p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id
           GROUP BY 1, 2),
     e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= PERCENT * (x.n + y.n - k)),
     both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
     reach AS (SELECT DISTINCT a AS id, a AS r FROM both_ways UNION SELECT reach.id, b FROM reach JOIN both_ways ON r = a),
     c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_idKEPT
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.id = d.doc_id WHERE d.doc_id IS NOT NULL"""

ORACLE_SQL = {
    "op1_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS5} AS w FROM documents WHERE doc_id IS NOT NULL),
     i AS (SELECT item_id, {_WORDS5} AS w FROM benchmark WHERE item_id IS NOT NULL),
     ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' '))) AS s
            FROM d WHERE len(w) >= 5
            UNION SELECT doc_id, unnest(list_transform(range(1, len(w) - m + 2), lambda k: array_to_string(w[k:k+m-1], ' ')))
            FROM d JOIN (SELECT DISTINCT len(w) AS m FROM i WHERE len(w) BETWEEN 1 AND 4) ON len(w) >= m),
     s AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
                  THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k+4], ' '))
                  ELSE [array_to_string(w, ' ')] END) AS s FROM i WHERE len(w) >= 1),
     n AS (SELECT item_id, count(*) AS item_shingles FROM s GROUP BY 1),
     h AS (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN s USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, item_shingles, shared, round(shared / item_shingles, 6) AS containment
FROM h JOIN n USING (item_id) WHERE shared * 100 >= item_shingles * 80""",
    "op4_minhash_near_dedup": _LINKED.replace("PERCENT", "80").replace("KEPT", """,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept"""),
    "op11_ngram_jaccard_join": _LINKED.replace("PERCENT", "85").replace("KEPT", ""),
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
     f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)""",
}
