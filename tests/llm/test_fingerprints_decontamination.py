"""Fingerprints against a plain recomputation, and items found in documents, at odd lengths."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cardrisk.llm import decontaminate, fingerprints
from cardrisk.llm import queries as Q
from conftest import SF001


def likeness(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
    return df.select(fingerprints.likeness(F.col("x"), F.col("y"))).first()[0]


def test_strong_lanes_are_sums_of_sha512(spark):
    texts = ["", "one", "a\nb\n\na", None, "x\n" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in fingerprints.with_fingerprint(df, "text", "fp").collect():
        want = [0] * 16
        for p in (r["text"] or "").split("\n"):
            digest = hashlib.sha512(p.encode()).digest()
            want = [(w + int.from_bytes(digest[4 * k:4 * k + 4])) % 2**32 for k, w in enumerate(want)]
        assert list(r["fp"]["strong"]) == want


def sentences(seed, n):
    r = random.Random(seed)
    return " ".join(" ".join(f"w{r.randrange(10**6)}" for _ in range(4)) + "." for _ in range(n))


CHINESE = "".join(chr(0x4E00 + random.Random(4).randrange(20000)) for _ in range(1))


def han(seed, n):
    r = random.Random(seed)
    return "".join(chr(0x4E00 + r.randrange(20000)) for _ in range(n))


@pytest.mark.parametrize("kind", ["sentences", "long", "unpunctuated", "chinese", "hindi"])
def test_likeness_of_halved_and_unrelated_texts(spark, kind):
    make = {"sentences": lambda s: sentences(s, 200), "long": lambda s: sentences(s, 100_000),
            "unpunctuated": lambda s: sentences(s, 200).replace(".", ""), "chinese": lambda s: han(s, 6000),
            "hindi": lambda s: "।".join(" ".join(f"क{random.Random(s * 1000 + i + j).randrange(10**6)}" for j in range(5)) for i in range(200))}[kind]
    a, b = make(1), make(2)
    assert likeness(spark, a, b) < 0.35
    half = a[:len(a) // 2] + b[len(a) // 2:]
    assert 0.25 < likeness(spark, a, half) < 0.8
    assert likeness(spark, a, a) == 1.0


def test_insert_and_delete_undo_each_other(spark):
    df = spark.createDataFrame([("p\nq r s", "x. y z")], "a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
    both = fingerprints.combine(F.col("x"), F.col("y"))
    back = df.select(fingerprints.combine(both, F.col("y"), -1).alias("z"), "x").first()
    assert back["z"] == back["x"]


def test_fingerprint_query_takes_the_next_document(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r[0], r[1] or "") for r in sorted(docs, reverse=True)]
    want = {}
    for i, (doc_id, t) in enumerate(texts):
        other, half = texts[(i + 1) % len(texts)][1], len(t) // 2
        want[doc_id] = hashlib.sha256((t[:len(t) - half] + other[:half]).encode()).hexdigest()
    got = Q.op2_document_fingerprints(spark, SF001).collect()
    assert {r["doc_id"]: r["edited_sha256"] for r in got} == want and len(got) == len(texts)
    by_text = {}
    for r in got:
        by_text.setdefault(dict(texts)[r["doc_id"]], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(x) == 1 for x in by_text.values()) and len({min(x) for x in by_text.values()}) == len(by_text)
    small = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (2, "c")], "doc_id long, text string")
    pairs = {(r["text"], r["next_text"]) for r in fingerprints.with_next(small, per_range=1).collect()}
    assert len(pairs) == 4 and ("c", "") not in pairs and ("", "c") in pairs
    assert fingerprints.with_next(small.limit(0)).collect() == []


DOCS = "doc_id long, text string, t long, _text string, s string"


def test_short_items_null_ids_and_rows_of_one_id(spark):
    item = " ".join(f"q{i}" for i in range(30))
    items = spark.createDataFrame([(1, "Who wrote the Iliad?"), (2, item), (3, None), (4, "  "), (None, "z"), (5, "Zugzwang")],
                                  "item_id long, text string")
    rows = [(1, "so: who wrote the ILIAD, then"), (2, "who wrote the Odyssey"), (3, f"x {item} y"), (None, item),
            (7, " ".join(f"q{i}" for i in range(17))), (7, " ".join(f"q{i}" for i in range(13, 30))), (7, "clean"),
            (8, None), (9, ""), (10, "zugzwang"), (3, "another text"), (3, f"x {item} y")]
    df = spark.createDataFrame([(i, x, 1, "u", "v") for i, x in rows], DOCS)
    got = {(r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in decontaminate.contained_items(df, items).collect()}
    assert got == {(1, 1, 1, 1), (3, 2, 26, 26), (10, 5, 1, 1)}
    kept = decontaminate.drop_contaminated(df, items)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == sorted(
        (i, x or "") for i, x in rows if i not in (1, 10, None) and x != f"x {item} y")
    assert decontaminate.drop_contaminated(df.limit(0), items).count() == 0
    assert decontaminate.drop_contaminated(df, items.limit(0)).count() == len(rows)


def test_common_openings_make_no_candidates(spark, monkeypatch):
    opening = "which of the following is"
    items = spark.createDataFrame([(i, f"{opening} " + " ".join(f"i{i}_{k}" for k in range(25))) for i in range(60)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{opening} " + " ".join(f"d{i}_{k}" for k in range(40))) for i in range(50)],
                                 "doc_id long, text string")
    counts = {}
    real = decontaminate.staged

    def watched(df, name):
        out = real(df, name)
        counts[name] = out.count()
        return out
    monkeypatch.setattr(decontaminate, "staged", watched)
    assert decontaminate.contained_items(docs, items).count() == 0
    assert counts["op1-candidates"] == 0
