"""Line deduplication by pairwise alignment.

Method.  A line's owner is the earliest document (smallest id) that holds it.
Every other document that holds the line is paired with the owner, never with
the other holders, so a line that a third of all documents share gives linearly
many pairs.  The lines that a document shares with one owner are aligned by
patience diff: lines that are unique on both sides are anchors, the longest
increasing chain of anchors fixes the alignment, repeated lines are placed in
the gaps.  What is left is matched with the owner's lines again, however often
they are matched already: every run of ``min_block_words`` words that stands in the
owner as it is is aligned too (a suffix automaton of the owner's lines finds all in
linear time), so moved blocks and surplus copies of a passage go.
Runs of consecutive aligned lines are the common blocks; a run that repeats a part
of a deleted block, whose lines may have several owners, is one as well.
A block is deleted from the
later document if it has ``min_block_words`` words or more and does not recur by
chance: a line has ``min_line_words`` words, or rare lines (of ``RARE_DOCS``
documents at most) of one owner have so many together, or a part stands in an
owner as it is that has ``min_block_words`` words in different lines or ``LONG``
times as many in all, or different lines aligned with one owner have ``LONG`` times
as many.  Sizes are words, but at least a word per two code points of
scripts without spaces and per ``LONG_WORD`` code points of any.

Scale.  Only (line hash, document, positions) rows are shuffled; text is read
again at the end and joined once with the matches of its document, which are
never more than its own lines.  Holders come to their owner in blocks of at least
as many positions as the owner has (``BLOCK`` at least), and each block gets the
owner's positions once: what is shuffled grows with the lines, however often
one repeats in an owner and however many documents hold it.  The owner's automaton
is built once per block.

Lines are split at newlines and compared without leading and trailing blanks;
blank lines are neither matched nor counted and interrupt no block.  Words are
runs of bytes other than space and 0x09-0x0D.  NULL and
empty texts have no lines and stay as they are.  Rows with a NULL id own nothing
and stay as they are.  Rows with equal
ids count as one holder (their lines' positions are pooled); each keeps its row and
loses only lines that it holds itself.  Other columns pass through as they are,
whatever their names; ``line_dedup_*`` columns of the input are replaced.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_if_small, staged

_ADDED = ["line_dedup_lines", "line_dedup_removed", "line_dedup_words", "line_dedup_partners"]

RARE_DOCS = 8
LONG = 4
LONG_WORD = 16
BLOCK = 100_000  # positions of a block of holders, at least
# Thai, Lao, Tibetan, Myanmar, Khmer, kana and bopomofo, Han.
_SCRIPTS = ("\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u312f\u3400-\u9fff\uf900-\ufaff"
            "\U00020000-\U0003ffff")
_NO_SPACES = re.compile(f"[{_SCRIPTS}]")


def _size(line: str, words: int) -> int:
    """Words of a line; text without spaces counts by code points."""
    return max(words, len(line) // LONG_WORD, 0 if line.isascii() else len(_NO_SPACES.findall(line)) // 2)


def _line_size(line: Column) -> Column:
    """``_size`` of a line without leading and trailing blanks, as a column."""
    odd = F.lit(False)  # blanks other than single spaces
    for blank in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains(line, F.lit(blank))
    plain = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    words = F.when(odd, F.size(F.filter(F.split(line, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))).otherwise(plain)
    marks = F.when(F.octet_length(line) > F.char_length(line),
                   F.char_length(F.regexp_replace(line, f"[^{_SCRIPTS}]+", ""))).otherwise(0)
    return F.greatest(words, F.floor(F.char_length(line) / LONG_WORD), F.floor(marks / 2)).cast("int")


def _lines(docs: DataFrame) -> DataFrame:
    """(h, doc_id, pos, size, crc) of every non-blank line; pos counts non-blank lines from 0."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    found = F.transform(lines, lambda x: F.struct(F.xxhash64(x, F.lit(1)).alias("h"), _line_size(x).alias("size"),
                                                  F.crc32(x.cast("binary")).alias("crc")))
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), found.alias("lines"))
    return rows.select("doc_id", F.posexplode("lines").alias("pos", "line")).select("doc_id", "pos", "line.*")


def shared_lines(docs: DataFrame, min_block: int = 8, min_line: int = 4, rare_docs: int = RARE_DOCS,
                 block: int = BLOCK) -> DataFrame:
    """(doc_id, links) per later document with aligned lines; a link is an owner and, per line
    aligned with it, the position and a mark: the line's crc32, whether the line is rare and
    whether it stands in the owner in a run of ``min_block`` words (told of short lines only)."""
    held = _lines(docs).groupBy("h", "doc_id").agg(F.array_sort(F.collect_set("pos")).alias("at"),
                                                   F.max("size").alias("size"), F.max("crc").alias("crc"))
    held = staged(held, "op3-held")
    owner = held.groupBy("h").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"),
                                  F.count("*").alias("held")).where("owner < last")
    owner = owner.select("h", "owner", (F.col("held") <= rare_docs).alias("rare"))
    links = staged(held.join(owner, "h"), "op3-links")
    own = F.col("doc_id") == F.col("owner")
    load = links.groupBy("owner").agg(F.sum(F.when(own, F.size("at"))).alias("p"),
                                      F.sum(F.when(~own, F.size("at"))).alias("n"))
    load = load.select("owner", F.ceil(F.col("n") / F.greatest(F.lit(block), "p")).cast("int").alias("blocks"))
    many = broadcast_if_small(staged(load.where("blocks > 1"), "op3-blocks"))
    rows = links.join(many, "owner", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("doc_id"), "blocks").cast("int")
    rows = rows.select("*", F.explode(F.when(own, F.sequence(F.lit(0), F.col("blocks") - 1))
                                      .otherwise(F.array(mine))).alias("block"))
    rows = rows.select("owner", "block", "doc_id", "h", "at", "size", "crc", "rare").repartition("owner", "block")
    rows = rows.sortWithinPartitions("owner", "block", ~own, "doc_id")
    got = rows.mapInArrow(_pairs(min_block, min_line),
                          "doc_id long, owner long, pos array<int>, mark array<long>")
    return got.groupBy("doc_id").agg(F.collect_list(F.struct("owner", "pos", "mark")).alias("links"))


def _longest_chain(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    piles: list[int] = []
    tops: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect.bisect_left(tops, v)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    chain, i = [], piles[-1] if piles else -1
    while i >= 0:
        chain.append(i)
        i = back[i]
    return chain[::-1]


def _automaton(line: list[int]) -> tuple[list[dict[int, int]], list[int], list[int]]:
    """Suffix automaton (transitions, suffix links, longest lengths) of a sequence."""
    steps, link, size = [{}], [-1], [0]
    last = 0
    for c in line:
        new = len(steps)
        steps.append({})
        link.append(0)
        size.append(size[last] + 1)
        v, last = last, new
        while v >= 0 and c not in steps[v]:
            steps[v][c] = new
            v = link[v]
        if v < 0:
            continue
        to = steps[v][c]
        if size[to] > size[v] + 1:
            copy = len(steps)
            steps.append(dict(steps[to]))
            link.append(link[to])
            size.append(size[v] + 1)
            while v >= 0 and steps[v].get(c) == to:
                steps[v][c] = copy
                v = link[v]
            link[to] = copy
            to = copy
        link[new] = to
    return steps, link, size


class Owner:
    """The lines of an owner: sorted positions by line."""

    def __init__(self, at: dict[int, list[int]]):
        self.at = at

    @cached_property
    def places(self) -> list[tuple[int, int]]:
        return sorted((q, c) for c, x in self.at.items() for q in x)

    @cached_property
    def pooled(self) -> bool:
        """Rows with equal ids: several lines at a position."""
        return len(dict(self.places)) < len(self.places)

    @cached_property
    def automaton(self) -> tuple[list[dict[int, int]], list[int], list[int]]:
        line, was, gap = [], None, 0
        for q, c in self.places:
            if was is not None and q != was + 1:
                gap += 1
                line.append(("gap", gap))  # matches nothing
            line.append(c)
            was = q
        return _automaton(line)

    def longest_runs(self, here: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """(position, lines) of the longest run ending at each position of ``here``, a
        sorted list of (position, line), that stands in the owner too."""
        if self.pooled or len(dict(here)) < len(here):
            lines: dict[int, list[int]] = {}
            for p, c in here:
                lines.setdefault(p, []).append(c)
            before, was = {}, -2
            for p, cs in lines.items():
                before = {q: 1 + (before.get(q - 1, 0) if was == p - 1 else 0) for c in cs for q in self.at.get(c, ())}
                was = p
                yield p, max(before.values(), default=0)
            return
        steps, link, size = self.automaton
        v, n, was = 0, 0, None
        for p, c in here:
            if was != p - 1:
                v, n = 0, 0
            was = p
            while v and c not in steps[v]:
                v = link[v]
                n = size[v]
            v, n = (steps[v][c], n + 1) if c in steps[v] else (0, 0)
            yield p, n

    def copied(self, shared: dict[int, list[int]], words, min_block: int) -> set[int]:
        """Positions of ``shared`` (positions by line) in runs of ``min_block`` words that stand here as they are."""
        here = sorted((p, c) for c, x in shared.items() for p in x)
        total, index = [0], {}
        for p, _ in here:
            if p not in index:
                index[p] = len(total)
                total.append(total[-1] + words[p])
        if total[-1] < min_block:
            return set()
        out: set[int] = set()
        upto = -1  # a run never starts before the run that ends earlier
        for p, n in self.longest_runs(here):
            if n and total[index[p]] - total[index[p] - n] >= min_block:
                out.update(range(max(p - n, upto) + 1, p + 1))
                upto = p
        return out

    def aligned(self, shared: dict[int, list[int]], words, min_block: int) -> set[int]:
        """Positions of ``shared`` (positions by line) that are aligned with the owner's lines."""
        anchors = sorted((here[0], self.at[c][0]) for c, here in shared.items() if len(here) == len(self.at[c]) == 1)
        chain = [anchors[i] for i in _longest_chain([q for _, q in anchors])]
        # Repeated lines: within each gap between anchors, i-th occurrence with i-th.
        cuts_b, cuts_a = [p for p, _ in chain], [q for _, q in chain]
        fill = []
        for c, here in shared.items():
            at = self.at[c]
            if len(here) == len(at) == 1:
                continue
            last, k = -1, 0
            for p in here:
                gap = bisect.bisect(cuts_b, p)
                if gap != last:
                    last, k = gap, bisect.bisect_left(at, cuts_a[gap - 1]) if gap else 0
                if k < len(at) and (gap == len(cuts_a) or at[k] < cuts_a[gap]):
                    fill.append((p, at[k]))
                    k += 1
        fill.sort()
        done = set(cuts_b) | {fill[i][0] for i in _longest_chain([q for _, q in fill])}
        # Moved blocks and surplus copies: whatever of the rest stands in the owner as it is.
        if any(p not in done for here in shared.values() for p in here):
            done |= self.copied(shared, words, min_block)
        return done


def copied(shared: list[tuple[list[int], list[int]]], words, min_block: int) -> set[int]:
    """``Owner.copied`` of lines given as (positions here, positions in the owner)."""
    return Owner({i: at for i, (_, at) in enumerate(shared)}).copied(
        {i: here for i, (here, _) in enumerate(shared)}, words, min_block)


def aligned(shared: list[tuple[list[int], list[int]]], words, min_block: int) -> set[int]:
    """``Owner.aligned`` of lines given as (positions here, positions in the owner)."""
    return Owner({i: at for i, (_, at) in enumerate(shared)}).aligned(
        {i: here for i, (here, _) in enumerate(shared)}, words, min_block)


def _pairs(min_block: int, min_line: int):
    """Aligned lines of each (owner, holder); rows come by owner and block, the owner's first."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            at = batch.column(4)
            offs, flat = at.offsets.to_pylist(), at.values.to_pylist()
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 3, 5, 6, 7)))):
                yield *row, flat[offs[i]:offs[i + 1]]

    def link(owner: Owner, lines: list[tuple]) -> tuple[list[int], list[int]]:
        shared = {h: at for h, _, _, _, at in lines}
        words = {p: size for _, size, _, _, at in lines for p in at}
        done = owner.aligned(shared, words, min_block)
        solid = owner.copied(shared, words, min_block) if any(x[1] < min_line for x in lines) else ()
        pos, mark = [], []
        for _, _, crc, rare, at in lines:
            for p in at:
                if p in done:
                    pos.append(p)
                    mark.append(crc << 2 | bool(rare) << 1 | (p in solid))
        return pos, mark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        schema = pa.schema([("doc_id", pa.int64()), ("owner", pa.int64()), ("pos", pa.list_(pa.int32())),
                            ("mark", pa.list_(pa.int64()))])
        key, owner, lines, n = None, None, [], 0

        def close() -> None:
            nonlocal owner, n
            if key is None:
                return
            if key[0] == key[2]:
                owner = Owner({h: at for h, _, _, _, at in lines})
            else:
                pos, mark = link(owner, lines)
                if pos:
                    out.append((key[2], key[0], pos, mark))
                    n += len(pos)

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)],
                                              schema=schema)
        for *new, h, size, crc, rare, at in rows(batches):
            if new != key:
                close()
                key, lines = new, []
                if n >= BLOCK:
                    yield ready()
                    out, n = [], 0
            lines.append((h, size, crc, rare, at))
        close()
        if out:
            yield ready()
    return run


def _texts(links, text: str | None, min_block: int, min_line: int) -> tuple[str | None, int, int, int, list[int]]:
    """Text without the common blocks, lines, removed lines, removed words, owners used."""
    raw = (text or "").split("\n")
    at = [i for i, x in enumerate(raw) if x.strip(" ")]
    if links is None or not len(links):
        return text, len(at), 0, 0, []
    owner_of: dict[int, int] = {}
    lines = [raw[i].strip(" ") for i in at]
    counts = [len(raw[i].encode("utf-8", "surrogatepass").split()) for i in at]
    sizes = [_size(x, n) for x, n in zip(lines, counts)]
    rare_at: set[int] = set()
    solid: dict[int, int] = {}  # owner of the positions that stand in it as they are
    for x in links:
        for p, mark in zip(x["pos"], x["mark"]):
            if p < len(at) and mark >> 2 == zlib.crc32(lines[p].encode("utf-8", "surrogatepass")):
                owner_of[p] = x["owner"]
                if mark & 2:
                    rare_at.add(p)
                if mark & 1:
                    solid[p] = x["owner"]

    def by_chance(run: list[int]) -> bool:
        if max(sizes[p] for p in run) >= min_line:
            return False
        rare: dict[int, int] = {}
        ordered: dict[int, dict[str, int]] = {}
        for p in run:
            if p in rare_at:
                rare[owner_of[p]] = rare.get(owner_of[p], 0) + sizes[p]
            ordered.setdefault(owner_of[p], {})[lines[p]] = sizes[p]
        if max(rare.values(), default=0) >= min_line or any(sum(x.values()) >= LONG * min_block
                                                            for x in ordered.values()):
            return False
        parts: dict[int, list[int]] = {}
        for p in run:
            if p in solid:
                parts.setdefault(solid[p], []).append(p)
        return not any(sum({lines[p]: sizes[p] for p in x}.values()) >= min_block
                       or sum(sizes[p] for p in x) >= LONG * min_block for x in parts.values())

    gone: list[int] = []
    words = 0
    run: list[int] = []
    for p in range(len(at) + 1):
        if p in owner_of:
            run.append(p)
            continue
        if run and sum(sizes[q] for q in run) >= min_block and not by_chance(run):
            gone += run
            words += sum(counts[q] for q in run)
        run = []
    if not gone:
        return text, len(at), 0, 0, []
    # Further copies of deleted blocks whose lines have several owners.
    places: dict[str, tuple[list[int], list[int]]] = {lines[p]: ([], []) for p in gone}
    deleted = set(gone)
    for p in range(len(at)):
        if (x := lines[p]) in places:
            places[x][0].append(p)
            if p in deleted:
                places[x][1].append(p)
    if any(len(here) > len(kept) for here, kept in places.values()):
        holder = {lines[p]: owner_of[p] for p in gone}
        for p in sorted(copied(list(places.values()), sizes, min_block) - deleted):
            gone.append(p)
            words += counts[p]
            owner_of[p] = holder[lines[p]]
    drop = {at[p] for p in gone}
    kept = "\n".join(x for i, x in enumerate(raw) if i not in drop)
    return kept, len(at), len(gone), words, sorted({owner_of[p] for p in gone})


def dedup_lines(docs: DataFrame, min_block_words: int = 8, min_line_words: int = 4, rare_docs: int = RARE_DOCS,
                block: int = BLOCK) -> DataFrame:
    """``docs`` with the text cut, and lines, removed lines, removed words and the
    owners of removed blocks in ``line_dedup_*`` columns."""
    base = docs.drop(*_ADDED)
    shared = shared_lines(docs, min_block_words, min_line_words, rare_docs, block)
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in base.schema.fields],
                           *[T.StructField(c, T.LongType()) for c in _ADDED[:3]],
                           T.StructField(_ADDED[3], T.ArrayType(T.LongType()))])
    doc_at, text_at = base.columns.index("doc_id"), base.columns.index("text")
    rows = base.toDF(*[f"in{i}" for i in range(len(base.columns))])  # no clashes
    key = F.col(f"in{doc_at}").cast("long")
    rows = rows.withColumn("spread", F.when(key.isNull(), F.xxhash64(f"in{text_at}")).otherwise(0))
    shared = shared.withColumn("zero", F.lit(0).cast("long"))
    rows = rows.join(shared, (key == F.col("doc_id")) & (F.col("spread") == F.col("zero")), "left").drop(
        "doc_id", "spread", "zero")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            texts, links = columns[text_at], columns.pop()
            got = [_texts(k.as_py(), t.as_py(), min_block_words, min_line_words) for k, t in zip(links, texts)]
            columns[text_at] = pa.array([g[0] for g in got], texts.type)
            added = [pa.array([g[k] for g in got], pa.int64()) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([*columns, *added, pa.array([g[4] for g in got], pa.list_(pa.int64()))],
                                             names=schema.names)

    return rows.mapInArrow(cut, schema)


def drop_repeated_lines(docs: DataFrame, min_block_words: int = 8, min_line_words: int = 4) -> DataFrame:
    """Documents with repeated blocks cut and n_chars brought up to date; a
    document that held nothing else goes, since earlier documents have all of it."""
    cut = dedup_lines(docs, min_block_words, min_line_words)
    left = cut.where("line_dedup_removed = 0 or trim(translate(text, '\n\t\r', '   ')) <> ''")
    changed = F.col("line_dedup_removed") > 0
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(changed, F.char_length("text")).otherwise(F.col("n_chars")).cast(kind))
    return left.select(*docs.columns)
