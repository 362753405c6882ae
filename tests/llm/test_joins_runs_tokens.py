"""Jaccard join, periodic runs and tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cardrisk.llm import crosstok, ngram_join, runs
from cardrisk.llm import queries as Q
from conftest import SF001

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


# -- Jaccard join ------------------------------------------------------------------

def shingle_set(text, n):
    w = [x.lower() if x.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def brute_components(rows, n, percent):
    """(doc_id, n_shingles, component_id) rows by comparing all sets that share a shingle."""
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    holders = defaultdict(list)
    for at, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(at)
    shared = Counter()
    for at in holders.values():
        for k, x in enumerate(at):
            for y in at[k + 1:]:
                shared[x, y] += 1
    for (x, y), both in shared.items():
        if 100 * both >= percent * (len(sets[x][1]) + len(sets[y][1]) - both):
            a, b = find(sets[x][0]), find(sets[y][0])
            up[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets)


def joined(df, **kw):
    return sorted(tuple(r) for r in ngram_join.jaccard_components(df, **kw).collect())


def test_join_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in Q.op11_ngram_jaccard_join(spark, SF001).collect()) == brute_components(rows, 4, 85)


@pytest.mark.parametrize("percent", [60, 85])
def test_join_equals_brute_force_around_the_threshold(spark, percent):
    rng = random.Random(percent)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(m)) for m in (3, 5, 9, 20, 60, 200, 700)]
    rows = []
    for text in base:
        for _ in range(25):
            w = text.split(" ")
            for _ in range(rng.randrange(0, max(2, len(w) // 14))):
                k = rng.randrange(len(w))
                w[k:k + rng.randrange(0, 2)] = [f"x{rng.randrange(10**6)}"] * rng.randrange(0, 2)
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df, n=3, percent=percent) == brute_components(rows, 3, percent)


def test_join_large_bucket_of_texts_that_do_not_link(spark):
    rng = random.Random(3)
    common = [f"c{k}" for k in range(60)]
    rows = [(i, " ".join(common + [f"own{i}_{k}" for k in range(rng.randrange(8, 14))])) for i in range(300)]
    rows += [(1000 + i, " ".join(common + [f"own{i % 7}_{k}" for k in range(9)] + [f"z{i}"])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df, n=4, percent=85) == brute_components(rows, 4, 85)


def test_join_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one"), (4, "one two"), (None, "one two"),
            (7, "a b c d e f g h"), (7, "one"), (8, "a b c d e f g h"), (9, "éa b c d"), (10, "Éa b c d")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, id int, key int")
    got = joined(df, n=4, percent=85)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 5, 6), (7, 1, 6),
                          (8, 5, 6), (9, 1, 9), (10, 1, 10)])
    assert joined(df.limit(0), n=4, percent=85) == []


def test_signatures_never_miss_a_link():
    import numpy as np
    rng = np.random.default_rng(5)
    for percent in (70, 85):
        for size in (3, 7, 8, 30, 200, 1500):
            a = rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64)
            for _ in range(20):
                drop = int(rng.integers(0, size * (100 - percent) // 100 + 1))
                b = a[rng.permutation(size)[drop:]]
                more = int(rng.integers(0, size * (100 - percent) // 100 + 1))
                b = np.concatenate([b, rng.integers(0, 2**63, more, dtype=np.int64).astype(np.uint64)])
                both = size - drop
                if 100 * both < percent * (size + len(b) - both) or (not drop and not more):
                    continue
                rows = np.repeat([0, 1], [size, len(b)])
                of, sig = ngram_join.signatures(rows, np.concatenate([a, b]), 2, percent)
                assert set(sig[of == 0]) & set(sig[of == 1])


# -- periodic runs -----------------------------------------------------------------

def brute_runs(w, least=6, times=4):
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            e = i
            while e < n and w[e] == w[e - q]:
                e += 1
            s = i - q
            if e - s >= max(least, times * q) and not any(
                    all(w[k] == w[k - d] for k in range(s + d, e)) for d in range(1, q)):
                out.append((s, e - s, q))
            i = e
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (9, 3)])
def test_find_runs_equals_brute_force(least, times):
    rng = random.Random(least)
    for trial in range(300):
        letters = rng.choice([1, 2, 3, 6])
        w = [rng.randrange(letters) for _ in range(rng.randrange(0, 60))]
        if trial % 2 and w:
            a, p = rng.randrange(len(w)), rng.randrange(1, 9)
            w = w[:a] + (w[a:a + p] * 30)[:rng.randrange(10, 60)] + [rng.randrange(letters) for _ in range(10)]
        assert runs.find_runs(w, least, times) == brute_runs(w, least, times), w


def test_long_loops_are_found():
    w = list(range(37)) * 40 + [99] * 5000 + list(range(500)) * 5
    assert runs.find_runs(w) == [(0, 1480, 37), (1480, 5000, 1), (6480, 2500, 500)]


def brute_digest(text):
    w = words(text)
    found = brute_runs(w)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return found, b" ".join(x for k, x in enumerate(w) if k not in gone)


def test_runs_of_texts_with_loops_of_every_length(spark):
    rng = random.Random(8)
    texts = [None, "", "  ", "a", "a a a a a a", "a a a a a", "x\x0b" * 9, "é é é é é é ü", "a b c d " * 4, "a b c d " * 4 + "a"]
    for p in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100):
        for e in (3, 4, 5):
            before = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(40))]
            loop = [f"w{rng.randrange(50)}" for _ in range(p)]
            extra = rng.randrange(p)
            texts.append(" ".join(before + loop * e + loop[:extra] + before[:5]))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows + [(None, "a a a a a a")], "doc_id long, text string")
    got = runs.periodic_runs(df).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        found, rest = brute_digest("a a a a a a" if r["doc_id"] is None else texts[r["doc_id"]])
        assert [tuple(x) for x in r["runs"]] == found
        assert r["collapsed"].encode() == rest
    assert runs.periodic_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        runs.periodic_runs(df.withColumn("runs", F.lit(1)), keep=("doc_id", "runs"))


def test_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r.asDict() for r in Q.op12_periodic_runs(spark, SF001).collect()}
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        w = words(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w) if n < 1500 or h % 10 == 0 else None
        if found is None:
            continue
        some += bool(found)
        gone = {k for s, m, q in found for k in range(s + q, s + m)}
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert got[doc_id] == {
            "doc_id": doc_id, "n_runs": len(found), "start": top[0], "length": top[1], "period": top[2],
            "exponent_milli": top[0] if top[0] is None else 1000 * top[1] // top[2],
            "runs_sha256": hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()}
    assert some >= 3


# -- tokenizer alignment -------------------------------------------------------------

def brute_alignment(a, b, bytes_a, bytes_b):
    """Groups as lists of (A ids, B ids)."""
    def ends(ids, table):
        out, at = [], 0
        for i in ids:
            at += len(table[i])
            out.append(at)
        return out
    ea, eb = ends(a, bytes_a), ends(b, bytes_b)
    cuts = sorted(set(ea) & set(eb))
    lo, groups = 0, []
    for hi in cuts:
        groups.append(([i for i, e in zip(a, ea) if lo < e <= hi], [i for i, e in zip(b, eb) if lo < e <= hi]))
        lo = hi
    return groups


def brute_rows(rows):
    (enc_a, bytes_a), (enc_b, bytes_b) = crosstok.byte_level(crosstok.FOLDER), crosstok.pieces(crosstok.FOLDER)
    groups, counts = [], Counter()
    for _, text in rows:
        a, b = (enc_a(" " + text), enc_b(text)) if text else ([], [])
        raw = b" " + (text or "").encode()
        if b"".join(bytes_a[i] for i in a) != raw or b"".join(bytes_b[i] for i in b) != raw:
            groups.append(None)
            continue
        groups.append(brute_alignment(a, b, bytes_a, bytes_b))
        counts.update({(x, y) for l, r in groups[-1] for x in l for y in r})
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), g in zip(rows, groups):
        if not g:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for l, r in g for x in l for y in r]
        text = ";".join(f"{','.join(map(str, l))}|{','.join(map(str, r))}" for l, r in g)
        out.append((doc_id, sum(len(l) for l, _ in g), sum(len(r) for _, r in g), len(g), len(links),
                    sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def aligned(df):
    from cardrisk.llm.common import staged
    rows = staged(crosstok.alignments(df, whole=False), "test-aligned")
    got = crosstok.with_counts(rows).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_alignment_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in Q.op13_tokenizer_alignment(spark, SF001).collect()), key=str)
    assert got == brute_rows([tuple(r) for r in docs])


def test_alignment_edge_cases(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, " "), (4, "hello  world\n\n\tx"), (5, "日本語のテキスト。これは長い"), (6, "a▁b"), (7, "<|endoftext|> <s> </s> <0x0A>"),
            (8, "😀👍🏽 naïve café ﬁ Ⅷ"), (9, "x" * 3000 + " " * 500), (10, "hello  world\n\n\tx"), (10, "hello  world\n\n\tx"),
            (None, "hello"), (11, "\u0000a\u0000"), (12, "hello " * 400)]
    df = spark.createDataFrame([(i, t, 7, "p") for i, t in rows], "doc_id long, text string, _row int, pairs string")
    assert aligned(df) == brute_rows(rows)
    assert aligned(df.limit(0)) == []
    monkeypatch.setattr(crosstok, "HOT", 20)  # most pairs are joined by the shuffle
    monkeypatch.setattr(crosstok, "LARGE", 3)  # most groups are counted by distinct ids
    monkeypatch.setattr(crosstok, "MEMO", 5)
    assert aligned(df) == brute_rows(rows)


def test_tokens_without_shared_ends():
    table = [b"", b" ", b"ab", b"ba", b" a", b"b"]
    aligner = crosstok.Aligner(table, table)
    a, b = [1] + [2] * 4000, [4] + [3] * 3999 + [5]
    assert aligner.same_bytes(a, b, b" " + b"ab" * 4000)
    texts, groups, links, of, pair, many = aligner.align([a, [1, 2]], [b, [1, 2]])
    assert groups.tolist() == [1, 2] and links.tolist() == [4001 * 4001, 2] and texts[1] == "1|1;2|2"
    assert dict(zip(zip(of.tolist(), (pair >> crosstok.SHIFT).tolist(), (pair % (1 << crosstok.SHIFT)).tolist()), many.tolist())) == {
        (0, 1, 4): 1, (0, 1, 3): 3999, (0, 1, 5): 1, (0, 2, 4): 4000, (0, 2, 3): 4000 * 3999, (0, 2, 5): 4000,
        (1, 1, 1): 1, (1, 2, 2): 1}


def test_byte_level_ranks_equal_the_json_form(spark):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(f"{crosstok.FOLDER}/byte_bpe_50k.json")
    whole.encode_special_tokens = True
    encode, _ = crosstok.byte_level(crosstok.FOLDER)
    texts = [r[0] for r in spark.read.parquet(f"{SF001}/documents.parquet").where("text is not null").select("text").collect()]
    texts += ["<|endoftext|>", "​  　x", " " * 100_000, "y" * 100_000]
    assert [encode(t) for t in texts] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
