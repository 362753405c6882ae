"""Alignment of two tokenisations of the same texts.

Method.  A text is encoded whole by both tokenizers.  Where a token of A and a token
of B that both begin with a space start at the same byte (both cumulated lengths are
compared, so the shared end before them is verified), the text is cut: the windows
between such anchors are pairs of token-id tuples.  Within a window the byte offsets
at which tokens of both end cut the tokens into groups; tokens of A and B link if they
share a group.  All that depends on the id tuples alone, since an id fixes its bytes,
so a window is aligned once per task and looked up after that (up to ``MEMO`` windows, then
the table starts anew).  Windows cannot change the groups: an anchor is a group end.

Scale.  Encoding and aligning is one narrow pass that writes, per text, its figures and
its distinct linked id pairs with their numbers of occurrences.  The corpus-wide count
of a pair (texts that hold it) is a partially aggregated sum.  The counts return to the
texts by a join: pairs that more than one in ``HOT`` of all (text, pair) rows holds
are at most ``HOT`` by that definition and are broadcast; the others, none of which is
hot, are joined by a shuffle.

Nulls: a NULL or empty text, and a text that either tokenizer does not return byte for
byte (normalisation, unknown characters), has no tokens: zeros and no groups.  Rows are
counted one by one: repeated rows are texts of their own, rows with NULL ids are kept.
Columns besides doc_id and text are not read.

The vocabulary files are read from ``folder`` on every executor.  The byte-level
vocabulary is used in its rank form, which splits and merges as the JSON form does for every code
point; a text too long for its pattern matcher is encoded by the JSON form itself.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import listed, mix64, slices, staged

FOLDER = "/opt/tokenizers"
MEMO = 400_000
LARGE = 10_000  # links of a group from which on its ids are counted first
HOT = 100_000
SHIFT = 20  # a pair of ids as one long: a << SHIFT | b


def byte_level(folder: str, name: str = "byte_bpe_50k") -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder of ``name``.tiktoken / ``name``.json and the bytes of each id."""
    import tiktoken
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    # fixed value: the pattern that splits text before byte-level merging
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    slow = []

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except BaseException as e:  # the matcher's stack has a limit, reported as a PanicException
            if type(e).__name__ != "PanicException" and not isinstance(e, (ValueError, RuntimeError)):
                raise
        if not slow:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            whole = Tokenizer.from_file(os.path.join(folder, f"{name}.json"))
            whole.encode_special_tokens = True
            slow.append(whole)
        return slow[0].encode(text, add_special_tokens=False).ids
    return encode, table


def pieces(folder: str, name: str = "piece_bpe_32k") -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder of ``name``.model, which puts a space before the text, and the bytes of each id."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, f"{name}.model"))
    table = []
    for i in range(model.piece_size()):
        piece = model.id_to_piece(i)
        table.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return (lambda text: model.encode(text, num_threads=1)), table


class Aligner:
    """Groups and links of id sequences; windows are memoised by their id tuples."""

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]):
        self.table = (bytes_a, bytes_b)
        self.size = tuple(np.array([len(t) for t in table], np.int64) for table in self.table)
        self.spaced = tuple(np.array([t[:1] == b" " for t in table]) for table in self.table)
        self.forget()

    def forget(self) -> None:
        """An empty memo: the number of each window's id tuples, and by number the text and figures
        (groups, links, first place and number of its pairs), with the pairs one after the other."""
        self.memo: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.figures = np.zeros((4, 0), np.int64)
        self.pairs = np.zeros((2, 0), np.int64)

    def same_bytes(self, a: list[int], b: list[int], raw: bytes) -> bool:
        return all(b"".join(map(table.__getitem__, ids)) == raw for table, ids in zip(self.table, (a, b), strict=True))

    def windows(self, a: np.ndarray, b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray) -> tuple:
        """Texts of the groups, figures and pairs, as in the memo, of windows with the ids ``a`` and ``b``
        one after the other, which begin where stated and spell the same bytes."""
        end_a, end_b = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        ends = np.zeros((2, end_a[-1] + 1), bool)
        ends[0, end_a] = ends[1, end_b] = True
        shared = ends.all(axis=0)
        last_a, last_b = np.flatnonzero(shared[end_a]), np.flatnonzero(shared[end_b])
        first_a, first_b = np.concatenate([[0], last_a[:-1] + 1]), np.concatenate([[0], last_b[:-1] + 1])
        many_a, many_b = last_a + 1 - first_a, last_b + 1 - first_b
        head = np.searchsorted(first_a, begin_a)  # first group of each window
        n_groups = np.diff(np.append(head, len(first_a)))
        size = many_a * many_b
        links = np.add.reduceat(size, head)
        group_window = np.repeat(np.arange(len(head)), n_groups)
        small = np.where(size <= LARGE, size, 0)
        of = np.repeat(np.arange(len(size)), small)
        at = np.arange(len(of)) - np.repeat(np.cumsum(small) - small, small)
        pair = a[first_a[of] + at // many_b[of]] << SHIFT | b[first_b[of] + at % many_b[of]]
        window, occurs = group_window[of], np.ones(len(of), np.int64)
        for g in np.flatnonzero(size > LARGE).tolist():
            # a group without shared ends over many tokens: its distinct ids, with their numbers
            (x, nx), (y, ny) = (np.unique(ids[i:j + 1], return_counts=True) for ids, i, j in (
                (a, first_a[g], last_a[g]), (b, first_b[g], last_b[g])))
            pair = np.concatenate([pair, (x[:, None] << SHIFT | y).ravel()])
            occurs = np.concatenate([occurs, (nx[:, None] * ny).ravel()])
            window = np.concatenate([window, np.full(len(x) * len(y), group_window[g])])
        window, pair, occurs = _added(window, pair, occurs)
        bounds = np.searchsorted(window, np.arange(len(head) + 1))
        str_a, str_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        spelled = [f"{str_a[i]}|{str_b[k]}" if j - i == 1 and m - k == 1 else
                   f"{','.join(str_a[i:j])}|{','.join(str_b[k:m])}" for i, j, k, m in zip(
                       first_a.tolist(), (last_a + 1).tolist(), first_b.tolist(), (last_b + 1).tolist(), strict=True)]
        texts = [";".join(spelled[i:j]) for i, j in pairwise([*head.tolist(), len(spelled)])]
        return texts, np.stack([n_groups, links, bounds[:-1], np.diff(bounds)]), np.stack([pair, occurs])

    def looked_up(self, ids: tuple, bounds: tuple) -> np.ndarray:
        """Numbers in the memo of the windows with the given bounds (begin, end of A; begin, end of B);
        those whose id tuples are new are aligned and added."""
        begin_a, end_a, begin_b, end_b = bounds
        n_a, n_b = end_a - begin_a, end_b - begin_b
        # each window's ids of A, -1 and ids of B as one run of bytes: its key
        packed = np.full((n_a + n_b + 1).sum(), -1, np.int32)
        at = np.cumsum(n_a + n_b + 1)
        start = at - (n_a + n_b + 1)
        packed[_ranges(start, n_a)] = ids[0][_ranges(begin_a, n_a)]
        packed[_ranges(start + n_a + 1, n_b)] = ids[1][_ranges(begin_b, n_b)]
        raw = packed.tobytes()
        keys = [raw[i:j] for i, j in zip((start * 4).tolist(), (at * 4).tolist(), strict=True)]
        if len(self.memo) + len(keys) > MEMO:
            self.forget()
        number = np.array([self.memo.get(key, -1) for key in keys], np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            a, b = n_a[new], n_b[new]
            texts, figures, pairs = self.windows(ids[0][_ranges(begin_a[new], a)], ids[1][_ranges(begin_b[new], b)],
                                                 np.cumsum(a) - a, np.cumsum(b) - b)
            number[new] = np.arange(len(new)) + len(self.texts)
            self.memo.update((keys[x], y) for x, y in zip(new.tolist(), number[new].tolist(), strict=True))
            figures[2] += self.pairs.shape[1]
            self.texts += texts
            self.figures = np.concatenate([self.figures, figures], axis=1)
            self.pairs = np.concatenate([self.pairs, pairs], axis=1)
        return number

    def align(self, a: list[list[int]], b: list[list[int]]) -> tuple:
        """For texts with the ids ``a`` and ``b`` (none empty): the groups' texts, arrays of the numbers of
        groups and links, and the distinct (text, pair, occurrences) as arrays ordered by text, then pair."""
        side = []
        for ids, size, spaced in zip((a, b), self.size, self.spaced, strict=True):
            flat = list(chain.from_iterable(ids))
            i = np.array(flat, np.int64)
            first = np.concatenate([[0], np.cumsum([len(x) for x in ids])])[:-1]
            end = np.cumsum(size[i])
            side.append((flat, i, first, end - size[i], spaced[i]))
        cuts = []
        for (_, i, first, start, spaced), (_, _, _, other, also) in (side, side[::-1]):
            begins = np.zeros(max(start[-1], other[-1]) + 1, bool)
            begins[other[also]] = True
            cut = spaced & begins[start]
            cut[first] = True  # a text begins a window
            begin = np.flatnonzero(cut)
            cuts.append((begin, np.append(begin[1:], len(i)), np.cumsum(cut) - 1))
        (begin_a, end_a, in_a), (begin_b, end_b, _) = cuts
        alike, head = self._alike(side, cuts)
        window = self.looked_up((side[0][1], side[1][1]), (begin_a[head], end_a[head], begin_b[head], end_b[head]))[alike]
        first = in_a[side[0][2]]  # first window of each text
        groups, links = (np.add.reduceat(self.figures[k][window], first) for k in (0, 1))
        spelled = list(map(self.texts.__getitem__, window.tolist()))
        texts = [";".join(spelled[i:j]) for i, j in pairwise([*first.tolist(), len(spelled)])]
        # occurrences of each window in a text, then of each pair
        of = np.repeat(np.arange(len(a)), np.diff(np.append(first, len(window))))
        used, times = np.unique(of * len(self.texts) + window, return_counts=True)
        text, window = used // len(self.texts), used % len(self.texts)
        base, width = self.figures[2:, window]
        pair, many = self.pairs[:, _ranges(base, width)]
        return texts, groups, links, *_added(np.repeat(text, width), pair, many * np.repeat(times, width))

    def _alike(self, side: list, cuts: list) -> tuple[np.ndarray, np.ndarray]:
        """A number for each window, equal for equal id tuples, and a window of each number."""
        key = np.zeros(len(cuts[0][0]), np.uint64)
        place = [np.arange(len(i)) - begin[of] for (_, i, *_), (begin, _, of) in zip(side, cuts, strict=True)]
        for (_, i, *_), (begin, _, _), at in zip(side, cuts, place, strict=True):
            mixed = mix64((i.astype(np.uint64) << np.uint64(32)) + at.astype(np.uint64) + np.uint64(1))
            key = mix64(key + np.add.reduceat(mixed, begin))
        _, head, number = np.unique(key, return_index=True, return_inverse=True)
        for (_, i, *_), (begin, end, of), at in zip(side, cuts, place, strict=True):
            same = (end - begin == (end - begin)[head[number]]).all()
            if not same or not (i == i[begin[head[number[of]]] + at]).all():
                break
        else:
            return number, head
        # two windows share a hash: number them by their ids
        numbers: dict = {}
        (a, *_), (b, *_) = side
        number = np.array([numbers.setdefault((tuple(a[i:j]), tuple(b[k:m])), len(numbers)) for i, j, k, m in zip(
            *(x.tolist() for begin, end, _ in cuts for x in (begin, end)), strict=True)])
        return number, np.unique(number, return_index=True)[1]


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... (``n`` of each), one range after the other."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _added(row: np.ndarray, pair: np.ndarray, occurs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, pair), ordered, with the sum of ``occurs``."""
    key = (row << 2 * SHIFT) + pair  # rows of a batch slice: far fewer than 2^(63 - 2 SHIFT)
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[new] >> 2 * SHIFT, key[new] & ((1 << 2 * SHIFT) - 1), np.add.reduceat(occurs[order], new)


_FIELDS = ("n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, occurs array<long>")


def _aligned(batches: Iterator[pa.RecordBatch], encoders: Callable, whole: bool) -> Iterator[pa.RecordBatch]:
    (encode_a, bytes_a), (encode_b, bytes_b) = encoders()
    aligner = Aligner(bytes_a, bytes_b)
    for batch in batches:
        for row0, data, offs in slices(batch.column(1)):
            raw, k = data.tobytes(), len(offs) - 1
            rows, ids_a, ids_b = [], [], []
            for r, (lo, hi) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
                if hi > lo:
                    text = raw[lo:hi].decode("utf-8", "replace")
                    a, b = encode_a(" " + text), encode_b(text)
                    if a and b and aligner.same_bytes(a, b, b" " + raw[lo:hi]):
                        rows.append(r)
                        ids_a.append(a)
                        ids_b.append(b)
            counts, groups = np.zeros((4, k), np.int64), [""] * k
            of, pair, many = (np.zeros(0, np.int64) for _ in range(3))
            if rows:
                texts, n_groups, n_links, of, pair, many = aligner.align(ids_a, ids_b)
                counts[:, rows] = [len(x) for x in ids_a], [len(x) for x in ids_b], n_groups, n_links
                of = np.array(rows)[of]
                for r, text in zip(rows, texts, strict=True):
                    groups[r] = text if whole else hashlib.sha256(text.encode()).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row0, k).cast(pa.int64()), *[pa.array(c) for c in counts],
                 pa.array(groups, pa.string()), listed(pair, of, k, pa.int64()), listed(many, of, k, pa.int64())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "occurs"])


def alignments(docs: DataFrame, folder: str = FOLDER, whole: bool = True,
               encoders: Callable | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2``, ids in order), pairs and occurs
    (the distinct linked pairs ``a << SHIFT | b`` and how often each is linked) of every row.

    ``whole`` False gives the groups' lower-case hex SHA-256 ('' without tokens) in place of their text.
    ``encoders`` returns two (encode, bytes of each id) pairs; the first gets a space before the text,
    the second adds it.  Default: the byte-level and the piece vocabulary of ``folder``.
    """
    made = encoders or (lambda: (byte_level(folder), pieces(folder)))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda it: _aligned(it, made, whole), f"doc_id long, {_FIELDS}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): texts that hold each linked pair, and whether its id of A has no pair with more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    counts = staged(counts, "op13-counts")
    most = counts.groupBy(_id_a().alias("a")).agg(F.max("count").alias("most"))
    return counts.join(most, _id_a() == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _id_a() -> Column:
    return F.shiftright("pair", SHIFT)


def with_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` (staged) without its pairs, with n_best (links whose pair is the most frequent of its
    id of A, ties included) and count_sum (counts summed over the links)."""
    keep = [c for c in aligned.columns if c not in ("pairs", "occurs")]
    counts = staged(pair_counts(aligned), "op13-pairs")
    rows = staged(aligned.withColumn("_row", F.monotonically_increasing_id()), "op13-rows")
    floor = (counts.agg(F.sum("count")).first()[0] or 0) // HOT
    hot = F.col("count") > floor  # at most HOT pairs have more
    flat = rows.select("_row", F.explode(F.arrays_zip("pairs", "occurs")).alias("x")).select(
        "_row", F.col("x.pairs").alias("pair"), F.col("x.occurs").alias("occurs"))
    mine = F.col("occurs") * F.when(F.col("best"), 1).otherwise(0)

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("_row").agg(F.sum(mine).alias("n_best"), F.sum(F.col("occurs") * F.col("count")).alias("count_sum"))
    often = F.broadcast(counts.where(hot).withColumnRenamed("pair", "hot_pair"))
    marked = flat.join(often, F.col("pair") == F.col("hot_pair"), "left")
    near = summed(marked.where("hot_pair is not null"))
    rare = summed(marked.where("hot_pair is null").select("_row", "pair", "occurs")
                  .join(counts.where(~hot), "pair"))
    sums = near.unionByName(rare).groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.join(sums, "_row", "left").select(
        *keep, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"))
