"""Periodic run detection on suffix trees.

A run is a stretch of words that repeats with a smallest period and cannot be
extended without breaking it.  Per text:

1. Ukkonen's suffix trees of the words and of their reversal, in linear time.
2. Longest common extensions in constant time: the lowest common ancestor of
   two leaves is the least depth of the Euler tour between them; the tour's
   minima are kept per block, with a sparse table over the blocks.
3. Candidates.  The leaves' order, for the words' order and for its reverse,
   gives the longest Lyndon word at every place (it ends where the next
   smaller suffix starts).  Every run has one of them as its root, so there
   are at most two candidates a place.
4. Each candidate is extended to both sides by a common extension of the two
   places where its root starts and ends; long enough ones are the runs.

Before the trees a text is cut where no run can lie: the stretches of
``gram`` words that a run of the asked length and exponent contains each occur
twice in it.  The cut is repeated until nothing more goes and loses no run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import fresh, with_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLOCK = 32
HELD_WORDS = 500_000  # words that a task gathers before it works on them (a longer text is taken alone)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SuffixTree:
    """Suffix tree of ``s``, whose last letter is 0 and occurs nowhere else.

    Letters are integers from 0 to ``letters`` - 1.
    """

    def __init__(self, s: list[int], letters: int):
        n = len(s)
        start, end, link, go = [0], [0], [0], {}
        node = edge = length = rest = 0
        for i, c in enumerate(s):
            rest += 1
            last = 0
            while rest:
                if not length:
                    edge = i
                key = node * letters + s[edge]
                child = go.get(key)
                if child is None:
                    go[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    width = min(end[child], i + 1) - start[child]
                    if length >= width:
                        node, edge, length = child, edge + width, length - width
                        continue
                    at = start[child] + length
                    if s[at] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    inner = len(start)
                    start += [start[child], i]
                    end += [at, n]
                    link += [0, 0]
                    go[key] = inner
                    go[inner * letters + c] = inner + 1
                    go[inner * letters + s[at]] = child
                    start[child] = at
                    if last:
                        link[last] = inner
                    last = inner
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self.n = n
        keys = np.fromiter(go.keys(), np.int64, len(go))
        order = np.argsort(keys)
        keys = keys[order]
        nodes = np.arange(len(start) + 1)
        self.first = np.searchsorted(keys, nodes * letters).tolist()  # place of a node's first child
        self.child = np.fromiter(go.values(), np.int64, len(go))[order].tolist()
        self.zero = (keys % letters == 0).tolist()  # children by the closing letter
        self.width = [e - b for b, e in zip(start, end)]
        self._tour()

    def _tour(self) -> None:
        first, child, width, n = self.first, self.child, self.width, self.n
        depth, following = [0] * len(width), first[:]
        tour: list[int] = []
        at, rank = [0] * n, [0] * n
        leaves, stack = 0, [0]
        while stack:
            v = stack[-1]
            tour.append(depth[v])
            k = following[v]
            if k == first[v + 1]:
                stack.pop()
                continue
            following[v] = k + 1
            u = child[k]
            depth[u] = d = depth[v] + width[u]
            if first[u] == first[u + 1]:
                at[n - d], rank[n - d] = len(tour), leaves
                leaves += 1
                tour.append(d)
            else:
                stack.append(u)
        self.depth, self.rank = depth, rank
        self.at = np.array(at)
        self.minima = RangeMin(np.array(tour, np.int32))

    def reversed_rank(self) -> list[int]:
        """The suffixes' ranks when the letters' order is turned round (the closing letter stays the least)."""
        first, child, n = self.first, self.child, self.n
        rank, leaves, stack = [0] * n, 0, [0]
        while stack:
            v = stack.pop()
            a, b = first[v], first[v + 1]
            if a == b:
                rank[n - self.depth[v]] = leaves
                leaves += 1
            elif self.zero[a]:
                stack += [*child[a + 1:b], child[a]]
            else:
                stack += child[a:b]
        return rank

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``i`` and ``j`` (different places)."""
        a, b = self.at[i], self.at[j]
        return self.minima(np.minimum(a, b), np.maximum(a, b))


class RangeMin:
    """Least value between two places, in constant time and linear space."""

    def __init__(self, a: np.ndarray):
        blocks = -(-len(a) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(a.dtype).max, a.dtype)
        padded[:len(a)] = a
        self.a = padded
        rows = padded.reshape(blocks, BLOCK)
        self.before = np.minimum.accumulate(rows, 1).ravel()
        self.after = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [rows.min(1)]
        while 2 << (len(self.table) - 1) <= blocks:
            t, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(t[:-half], t[half:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        first, last = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.after[lo], self.before[hi])
        one = np.flatnonzero(first == last)
        if len(one):
            best = self.a[lo[one]].copy()
            for step in range(1, BLOCK):
                best = np.minimum(best, self.a[np.minimum(lo[one] + step, hi[one])])
            out[one] = best
        level = np.log2(np.maximum(last - first - 1, 1)).astype(int)
        for k in np.unique(level[last - first > 1]):
            w = np.flatnonzero((level == k) & (last - first > 1))
            t = self.table[k]
            out[w] = np.minimum(out[w], np.minimum(t[first[w] + 1], t[last[w] - (1 << k)]))
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """For every place the next one with a smaller rank (the end if there is none)."""
    n = len(rank)
    out = [n] * n
    for i in range(n - 1, -1, -1):
        j, r = i + 1, rank[i]
        while j < n and rank[j] > r:
            j = out[j]
        out[i] = j
    return out


def runs(words: Sequence[int], min_exponent: int = 4, min_length: int = 6) -> np.ndarray:
    """(start, length, period) of the runs of a sequence of integers, by start, then period."""
    n = len(words)
    if n < 2:
        return np.empty((0, 3), np.int64)
    values, s = np.unique(np.asarray(words), return_inverse=True)
    s = s + 1
    forward = SuffixTree([*s.tolist(), 0], len(values) + 1)
    backward = SuffixTree([*s[::-1].tolist(), 0], len(values) + 1)
    i = np.arange(n)
    found = []
    for rank in (forward.rank, forward.reversed_rank()):
        j = np.array(next_smaller(rank))[:n]  # the closing letter's suffix is the smallest
        right = forward.lce(i, j)
        left = backward.lce(n - i, n - j)
        length, period = left + (j - i) + right, j - i
        ok = length >= np.maximum(min_length, min_exponent * period)
        found.append(np.stack([(i - left)[ok], length[ok], period[ok]], 1))
    found = np.unique(np.concatenate(found), axis=0)  # (sorted by start, length, period)
    return found[np.lexsort((found[:, 2], found[:, 0]))].astype(np.int64)


def stretches(ids: np.ndarray, text: np.ndarray, min_exponent: int, min_length: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches of ``ids`` in which runs can lie; ``text`` numbers the texts they come from.

    A run of length L >= ``min_length`` and period q <= L / ``min_exponent`` has
    at least 2 q starts of ``gram`` words, so each stretch of that many words in
    it occurs twice in it, and every two neighbouring words of the run lie in
    such a stretch.
    """
    gram = max(1, min_length - -(-2 * min_length // min_exponent) + 1)
    seg = np.cumsum(np.r_[0, np.diff(text) != 0]) if len(text) else text
    where = np.arange(len(ids))
    ids = ids.astype(np.uint64)
    while len(where) >= max(gram, min_length):
        starts = np.flatnonzero(seg[gram - 1:] == seg[:len(seg) - gram + 1])
        key = np.zeros(len(starts), np.uint64)
        for k in range(gram):
            key = (key ^ ids[where[starts + k]]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        key = (key ^ seg[starts].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        good = starts[count[back] > 1]
        edge = np.zeros(len(where) + 1, np.int64)  # neighbours joined by a stretch that repeats
        np.add.at(edge, good, 1)
        np.add.at(edge, good + gram - 1, -1)
        joined = np.cumsum(edge)[:len(where)] > 0  # place and the next one
        inside = joined | np.r_[False, joined[:-1]] if gram > 1 else np.isin(np.arange(len(where)), good)
        if gram == 1:
            joined = inside[:-1] & inside[1:] & (seg[:-1] == seg[1:]) if len(inside) > 1 else joined[:-1]
            joined = np.r_[joined, False]
        new = np.cumsum(np.r_[True, ~joined[:-1]])
        size = np.bincount(new)
        inside &= size[new] >= min_length
        if inside.all() and new[-1] == seg[-1] - seg[0] + 1:
            break
        where, seg = where[inside], new[inside]
        seg = np.cumsum(np.r_[0, np.diff(seg) != 0]) if len(seg) else seg
    else:
        return []
    ends = np.flatnonzero(np.diff(seg)) + 1
    return [(int(where[a]), int(where[b - 1]) + 1) for a, b in zip(np.r_[0, ends], np.r_[ends, len(seg)])]


def collapsed(words: list[str], found: np.ndarray) -> str:
    """The words, without those that lie in a run after its first period, joined by blanks."""
    if not len(found):
        return " ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return " ".join([words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)])


def periodic_runs(df: DataFrame, text: str = "text", out: str = "runs", kept: str = "collapsed", min_exponent: int = 4, min_length: int = 6,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the runs of the words of ``text``
    added: ``out``, an array of (start, length, period) by start, then period,
    with words numbered from 0, and ``kept``, the words joined by one blank
    without those that a run repeats.  Columns of those names are replaced.

    Words are what stands between blanks and the control characters from tab
    to carriage return.  ``min_exponent`` (at least 2) times the period and
    ``min_length`` words are the least a run has.  A null text has no runs and
    a null ``kept``; an empty one has no runs and an empty one.  Every row is
    judged on its own, equal rows alike.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("min_exponent and min_length must be at least 2")
    src, names, place = with_text(df, text, (out, kept), keep)
    schema = T.StructType([*[src.schema[c] for c in names], T.StructField(out, T.ArrayType(T.StructType(
        [T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))), T.StructField(kept, T.StringType())])

    def work(texts: list[str | None]) -> tuple[list, list]:
        words = [WORD.findall(t) if t else [] for t in texts]
        known: dict[str, int] = {}
        number = known.setdefault
        ids = np.array([number(w, len(known)) for ws in words for w in ws], np.int64)
        sizes = np.array([len(ws) for ws in words])
        first = np.r_[0, np.cumsum(sizes)]
        found: dict[int, list[np.ndarray]] = {}
        for a, b in stretches(ids, np.repeat(np.arange(len(words)), sizes), min_exponent, min_length):
            d = int(np.searchsorted(first, a, "right")) - 1
            r = runs(ids[a:b], min_exponent, min_length)
            if len(r):
                found.setdefault(d, []).append(r + [[a - first[d], 0, 0]])
        none = np.empty((0, 3), np.int64)
        rows = [np.concatenate(found[d]) if d in found else none for d in range(len(words))]
        texts_out = [None if t is None else collapsed(ws, r) for t, ws, r in zip(texts, words, rows)]
        return [[dict(zip(("start", "length", "period"), x)) for x in r.tolist()] for r in rows], texts_out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, held = 0, 0
            column = b.column(place)
            for end in range(1, b.num_rows + 1):
                held += (len(column[end - 1].as_py() or "")) // 6 + 1  # about its words
                if held >= HELD_WORDS or end == b.num_rows:
                    part = b.slice(start, end - start)
                    found, texts = work(part.column(place).to_pylist())
                    yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(names))], pa.array(found, pa.list_(RUN)), pa.array(texts, pa.string())],
                                                     names=[*names, out, kept])
                    start, held = end, 0

    return src.mapInArrow(run, schema)
