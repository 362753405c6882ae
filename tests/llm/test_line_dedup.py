"""Line dedup: distributed alignment against a direct one, hot lines, pass-through of other columns."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cardrisk.llm import line_dedup

WORDS = ["a b c d", "e", "f g", "h i j k l m n o p", "q r s", "t"]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def direct(texts, min_block=8, min_line=4):
    """(doc, owner) -> {position: stands in the owner as it is}, by plain loops."""
    lines = [[x.strip(" ") for x in (t or "").split("\n") if x.strip(" ")] for t in texts]
    first = {}
    for d, x in enumerate(lines):
        for c in x:
            first.setdefault(c, d)
    out = {}
    for d, x in enumerate(lines):
        for owner in {first[c] for c in x} - {d}:
            shared = [([p for p, y in enumerate(x) if y == c], [q for q, y in enumerate(lines[owner]) if y == c])
                      for c in sorted(set(x)) if first[c] == owner]
            sizes = [line_dedup._size(y, len(y.split())) for y in x]
            done = line_dedup.aligned(shared, sizes, min_block)
            short = any(sizes[here[0]] < min_line for here, _ in shared)
            solid = line_dedup.copied(shared, sizes, min_block) if short else set()
            if done:
                out[d, owner] = {p: p in solid for p in done}
    return out


@pytest.mark.parametrize("block", [1, 7, 100_000])
def test_alignment_in_blocks_equals_direct_loops(spark, block):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(WORDS + [f"own {i}"]) for _ in range(rng.randrange(30))) for i in range(25)]
    texts[3] = "\n".join(["e", "f g"] * 40)  # an owner's hot lines are met again by every later document
    texts += [None, "", " \n\t\n "]
    got = line_dedup.shared_lines(table(spark, texts), block=block).collect()
    have = {(r["doc_id"], x["owner"]): {p: bool(m & 1) for p, m in zip(x["pos"], x["mark"])}
            for r in got for x in r["links"]}
    assert have == direct(texts)
    a, b = (sorted(tuple(r) for r in line_dedup.dedup_lines(table(spark, texts), block=n).select(
        "doc_id", "text", "line_dedup_removed").collect()) for n in (block, 100_000))
    assert a == b


def test_positions_shipped_are_linear_in_the_lines(spark):
    hot = "\n".join(["one common line of eight words in it"] * 2000)
    texts = [hot] + [f"one common line of eight words in it\nown {i}" for i in range(200)]
    rows = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(table(spark, texts), block=50).collect()}
    assert rows[0] == hot and all(rows[i + 1] == f"own {i}" for i in range(200))


def test_sizes_agree_with_the_column(spark):
    lines = ["one two", "\t", "a\tb  c", "a  b", "a\rb c", "x\x0b\x0cy", "plain words of a line", "x" * 100, "这是一段没有空格的中文文本", "ação é", "ไทยไทยไทย ok", "\x1f a", "𠀀𠀁𠀂𠀃"]
    rows = spark.createDataFrame([(x,) for x in lines], "x string").select("x", line_dedup._line_size(F.col("x")).alias("n"))
    for x, n in rows.collect():
        assert n == line_dedup._size(x, len(x.encode().split())), x


def test_other_columns_and_ids(spark):
    a = "a passage of eight words that one holds"
    rows = [(0, a, float("nan"), None, 1), (1, f"{a}\nmine", None, 2, 2), (None, a, 1.5, 3, 3), (None, a, 2.5, 4, 4),
            (5, a, 0.0, 5, 5), (5, "this row has another text of many own words", 0.5, 6, 6), (6, a, 0.1, 7, 7), (6, a, 0.2, 8, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, v double, owner int, links int")
    docs = docs.withColumn("line_dedup_words", F.lit("old"))
    got = {r["links"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert len(got) == len(rows) and math.isnan(got[1]["v"]) and got[2]["v"] is None and got[1]["owner"] is None
    assert got[1]["text"] == a and got[2]["text"] == "mine" and got[2]["line_dedup_partners"] == [0]
    assert got[3]["text"] == got[4]["text"] == a  # NULL ids stay as they are
    assert got[5]["text"] == "" and got[6]["text"] == rows[5][1]  # rows with equal ids lose their own lines only
    assert got[7]["text"] == got[8]["text"] == ""
    assert got[2]["line_dedup_words"] == 8 and [f.dataType for f in docs.schema][:5] == [
        f.dataType for f in line_dedup.dedup_lines(docs).schema][:5]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
