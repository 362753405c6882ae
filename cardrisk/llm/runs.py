"""Periodic runs of words by a suffix automaton with link-cut access.

Method.  Words are appended to a suffix automaton one by one.  Its suffix links are
kept as a link-cut tree in which every preferred path has one colour: the last end
position of the words spelled by its nodes.  Appending word ``i`` opens the path of
the new prefix to the root: each segment of it, with colour ``j`` and longest length
``L``, says that the last ``L`` words stood last at ``j``.  With ``p = i - j <= L`` that
is a square of period ``p``, and ``i - p - L`` is where the run that it belongs to
begins; the last ``i`` that sees the same (begin, p) is where it ends.  ``p`` is the
smallest period of the run, since the last ``p`` words stood nowhere later than at
``i - p``.  Then the path is recoloured to ``i``; the number of segments opened is
logarithmic on average over a text.

The automaton runs on ``stretches`` only: a run of period ``q`` and ``times * q`` words
leaves a trail of words (for longer periods: of ``GRAM`` words) each of which stood at
most ``q`` words before.  Stretches without a long enough trail hold no run, and the
others are widened by the period, so every run lies whole inside its stretch.

Memory: a batch slice plus the automaton of one stretch, some 600 bytes a word of the
longest one.  No shuffle: every text is one row of one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IS_SEP, mix64, slices, span_hashes, spans

GRAM = 8
_U = np.uint64
_FAR = np.int64(1 << 62)


class _Paths:
    """Preferred paths of the suffix-link tree, each a splay tree by depth whose root holds the colour."""

    def __init__(self):
        # node 0 is nothing, node 1 the root of the suffix-link tree
        self.up, self.left, self.right, self.colour = [0, 0], [0, 0], [0, 0], [0, 0]

    def add(self, parent: int) -> int:
        self.up.append(parent)
        self.left.append(0)
        self.right.append(0)
        self.colour.append(0)
        return len(self.up) - 1

    def rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        if left[y] == x:
            b = right[x]
            left[y], right[x] = b, y
        else:
            b = left[x]
            right[y], left[x] = b, y
        if b:
            up[b] = y
        up[y], up[x] = x, z

    def splay(self, x: int) -> None:
        """Make ``x`` the root of its path's tree; the colour moves with the root."""
        up, left, right = self.up, self.left, self.right
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                self.colour[x] = self.colour[z]
                self.rotate(y if (left[z] == y) == (left[y] == x) else x)
            else:
                self.colour[x] = self.colour[y]
            self.rotate(x)
            y = up[x]

    def above(self, x: int) -> int:
        """A new node between ``x`` and its tree parent, on the path of ``x``."""
        new = self.add(x)
        self.splay(x)
        below = self.left[x]
        self.left[new], self.left[x] = below, new
        if below:
            self.up[below] = new
        return new

    def access(self, x: int, colour: int) -> Iterator[tuple[int, int]]:
        """(deepest node, colour) of each segment from ``x`` to the root; then all get ``colour``."""
        up, right = self.up, self.right
        last = 0
        while x:
            self.splay(x)
            if last:
                yield x, self.colour[x]
            cut = right[x]
            if cut:
                self.colour[cut] = self.colour[x]
            right[x] = last
            last, x = x, up[x]
        self.colour[last] = colour


def find_runs(words: list, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of at least ``least`` words and ``times`` (2 or
    more) periods, ordered by start, then period."""
    paths = _Paths()
    length, link, step = [0, 0], [0, 0], [{}, {}]
    last, ends = 1, {}
    for i, word in enumerate(words, 1):
        node, p = paths.add(0), last
        length.append(length[last] + 1)
        link.append(0)
        step.append({})
        while p and word not in step[p]:
            step[p][word] = node
            p = link[p]
        if not p:
            link[node] = 1
        else:
            q = step[p][word]
            if length[p] + 1 != length[q]:
                copy = paths.above(q)
                length.append(length[p] + 1)
                link.append(link[q])
                step.append(dict(step[q]))
                while p and step[p].get(word) == q:
                    step[p][word] = copy
                    p = link[p]
                link[q] = q = copy
            link[node] = q
        paths.up[node] = link[node]
        for x, j in paths.access(node, i):
            period = i - j
            if j and length[x] >= (times - 1) * period:
                ends[i - period - length[x], period] = i
        last = node
    return sorted((s, e - s, p) for (s, p), e in ends.items() if e - s >= least)


def _gaps(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Distance from each position back to the same hash in the same row; far where there is none."""
    gap = np.full(len(hashes), _FAR)
    if len(hashes) > 1:
        key = mix64(hashes + mix64(row.astype(np.uint64) + _U(11)))
        order = np.argsort(key, kind="stable")
        same = (key[order[1:]] == key[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        gap[order[1:][same]] = (order[1:] - order[:-1])[same]
    return gap


def stretches(hashes: np.ndarray, row: np.ndarray, least: int = 6, times: int = 4) -> list[tuple[int, int]]:
    """Disjoint position intervals of the word hashes outside of which no run of at least
    ``least`` words and ``times`` periods has a word."""
    m = len(hashes)
    if m < least:
        return []
    begin = np.searchsorted(row, row, "left")
    longest = int((np.arange(m) - begin).max()) + 1
    found, gap, width = [], _gaps(hashes, row), 1
    scale = 1
    while times * (scale // 2 + 1) <= longest:
        if scale >= 2 * GRAM and width == 1:
            width = GRAM
            grams = np.full(m - GRAM + 1, GRAM, np.uint64)
            for j in range(GRAM):
                grams = grams * _U(0xD6E8FEB86659FD93) + hashes[j:m - GRAM + 1 + j]
            gap = _gaps(grams, row[:m - GRAM + 1])
            gap[row[:m - GRAM + 1] != row[GRAM - 1:]] = _FAR
        low = scale // 2 + 1 if scale > 1 else 1
        # the shortest trail that a run with a period in low..scale leaves
        turn = min(max(least // times, low), scale)
        need = min(max(least, times * q) - q for q in {low, turn, min(turn + 1, scale)}) - (width - 1)
        near = np.concatenate([[False], gap <= scale, [False]])
        edge = np.flatnonzero(near[1:] != near[:-1])
        s, e = edge[::2], edge[1::2]
        long = e - s >= max(1, need)
        s, e = s[long], e[long]
        found += zip(np.maximum(begin[s], s - scale).tolist(), (e + width - 1).tolist(), strict=True) if len(s) else []
        scale *= 2
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _rows(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("_text"))
        others = batch.drop_columns(["_text"])
        for row0, data, offs in slices(texts):
            k = len(offs) - 1
            start, end, row = spans(data, offs, IS_SEP[data])
            first = np.searchsorted(row, np.arange(k + 1))
            runs: list[list] = [[] for _ in range(k)]
            raw = data.tobytes()
            for s, e in stretches(span_hashes(data, start, end), row, least, times):
                r = int(row[s])
                part = [raw[a:b] for a, b in zip(start[s:e].tolist(), end[s:e].tolist(), strict=True)]
                at = int(s - first[r])
                runs[r] += [(at + b, n, p) for b, n, p in find_runs(part, least, times)]
            kept = []
            for r in range(k):
                parts = raw[offs[r]:offs[r + 1]].split()
                if runs[r]:
                    keep = np.ones(len(parts), bool)
                    for b, n, p in runs[r]:
                        keep[b + p:b + n] = False
                    parts = [w for w, stays in zip(parts, keep.tolist(), strict=True) if stays]
                    runs[r].sort(key=lambda run: (run[0], run[2]))
                kept.append(b" ".join(parts))
            yield pa.RecordBatch.from_arrays([
                *others.slice(row0, k).columns,
                pa.array([[{"start": b, "length": n, "period": p} for b, n, p in x] for x in runs], pa.list_(triple)),
                pa.array(kept, pa.binary()).cast(pa.string(), safe=False)],
                names=[*others.schema.names, "runs", "collapsed"])


def periodic_runs(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: int = 6,
                  times: int = 4) -> DataFrame:
    """The ``keep`` columns of every row with ``runs`` (start, length, period of each run of the words
    of ``text``, by start, then period) and ``collapsed``: the words joined by one space, without those
    that any run holds after its first period.

    Words are maximal runs of characters other than space and 0x09-0x0D, compared byte by byte.
    NULL and empty texts have no words and no runs; repeated rows give equal rows, rows with a NULL
    id are kept.  Columns not in ``keep`` are not read; ``keep`` may not hold ``_text`` or an output's name.
    """
    clash = {"_text", "runs", "collapsed"} & set(keep)
    if clash:
        raise ValueError(f"keep columns clash with the output: {sorted(clash)}")
    rows = df.select(*keep, F.col(text).cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    return rows.mapInArrow(
        lambda it: _rows(it, least, times),
        f"{fields}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length; of several the one that starts first, then the shorter period."""
    return F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("short"))))


def looped(text: Column, doc_id: Column) -> Column:
    """The words of ``text``, for a tenth of the ids with a loop from some word on.

    With h = crc32 of the decimal id, g = h div 10 and n words: if h mod 10 is 0, each word
    from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    Other texts, texts without words and rows without an id are returned as they are.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    w = F.filter(F.split(text, "[ \\t-\\r]+"), lambda x: x != "")
    n = F.size(w)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    words = F.slice(F.concat(F.slice(w, F.lit(1), a), loop), F.lit(1), n)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(words, " ")).otherwise(text)
