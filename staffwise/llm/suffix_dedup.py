"""Suffix-array dedup with run-length indexes.

A byte goes if it lies in a string of ``length`` bytes (a window) that also
starts anywhere else in the corpus.

1. Anchors.  Of the ``gram``-byte strings in a window the one with the
   smallest hash is its anchor, so equal windows have equal anchors at the
   same place.  The windows of a text that share an anchor form a piece, and
   every window lies in exactly one piece.  Pieces meet by their anchor's hash.
   Equal pieces are merged and counted, and what stands at several places is
   repeated as a whole; an anchor with one piece is done.  Only digests are
   shuffled up to here.
2. Index.  The different pieces of some anchors, set one after the other, form a block;
   its Burrows-Wheeler transform is kept run by run, with the suffix-array
   entries at the runs' ends.  Where the letters before two neighbouring
   suffixes agree, the common prefix is one longer there, so only the entries
   at run ends need a comparison.
3. Matching statistics are streamed over the block in text order: from one
   sampled place to the next the match moves along and loses one byte a step.
   A window starts where the longest match with the neighbours in suffix
   order, above or below, has at least ``length`` bytes.
4. The windows found are carried back to all places of their piece and joined
   to spans.

An anchor whose pieces are many and different (a passage in very many texts,
with different neighbours) would grow without bound: its pieces are halved by
the anchor's place in the window, which gives longer common strings to meet
by, until every group is small; at the end a piece is a single window and all
pieces that meet are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import col, fresh, let

GRAM = 128  # bytes of an anchor; a third of a window or so
GROUP_PIECES = 2_000  # different pieces of one anchor that a block takes whole
BLOCK_BYTES = 1 << 18  # pieces of a block
CHUNK = 1 << 20  # windows of a text that are taken at a time
HELD_PIECES = 50_000  # pieces that a task holds before it passes them on
_ODD = 0x9E3779B97F4A7C15


def _byte_values() -> np.ndarray:
    """A fixed 64-bit value per byte."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


BYTE = _byte_values()


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes in a row, by the doubling of lengths."""
    n = len(data) - gram + 1
    if n < 1:
        return np.empty(0, np.uint64)
    # hash of 2^k bytes from two of 2^(k-1); a gram from two that overlap
    h, size = BYTE[data], 1
    while 2 * size <= gram:
        h = h[:-size] * np.uint64(_ODD) + h[size:]
        h ^= h >> np.uint64(32)
        size *= 2
    rest = gram - size
    out = h[:n] if not rest else h[:n] * np.uint64(_ODD) + h[rest:rest + n]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def pieces(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor's place in the first window, anchor's hash) of the pieces of a text:
    neighbouring windows with one anchor."""
    n = len(data) - length + 1
    if n < 1:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    h = gram_hashes(data, gram)
    bits = np.uint64(len(h).bit_length())
    ranked = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the first
    w = length - gram + 1  # grams of a window
    rows = -(-len(h) // w)
    padded = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(h)] = ranked
    grid = padded.reshape(rows, w)
    before = np.minimum.accumulate(grid, 1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(after[:n], before[w - 1:w - 1 + n])
    start = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    at = (least[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return start, np.diff(np.r_[start, n]), at - start, h[at].view(np.int64)


class SuffixArray:
    """The suffixes of a text of integers below 511 in order, by doubling.

    ``levels`` keeps (letters, ranks by that many letters) of every round;
    suffixes that are settled are not sorted again.
    """

    def __init__(self, text: np.ndarray):
        self.text, n = text, len(text)
        key = np.zeros(n, np.int64)
        for k in range(7):  # the first ranks are by seven letters
            key <<= 9
            key[:max(n - k, 0)] |= text[k:].astype(np.int64) + 1
        sa = np.argsort(key)
        ordered = key[sa]
        new = np.ones(n, bool)  # whether a rank starts a group of suffixes that agree so far
        new[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.int32)
        rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
        self.levels, size = [(7, rank.copy())], 7
        while True:
            alone = new.copy()
            alone[:-1] &= new[1:]
            open_ = np.flatnonzero(~alone)
            if not len(open_):
                break
            s = sa[open_]
            after = np.where(s + size < n, rank[np.minimum(s + size, n - 1)] + 1, 0)
            key = rank[s] * np.int64(n + 1) + after
            order = np.argsort(key)
            s, key = s[order], key[order]
            first = np.ones(len(s), bool)
            first[1:] = key[1:] != key[:-1]
            sa[open_], new[open_] = s, first
            rank[s] = open_[np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))]
            size *= 2
            self.levels.append((size, rank.copy()))
        self.order = sa

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``i`` and ``j`` (different places)."""
        n, out = len(self.text), np.zeros(len(i), np.int64)
        for size, rank in reversed(self.levels):
            a, b = i + out, j + out
            out += size * (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)]) * (np.maximum(a, b) < n)
        live = np.arange(len(i))
        for _ in range(7):
            a, b = i[live] + out[live], j[live] + out[live]
            same = (np.maximum(a, b) < n) & (self.text[np.minimum(a, n - 1)] == self.text[np.minimum(b, n - 1)])
            live = live[same]
            out[live] += 1
        return out


class RunIndex:
    """Run-length Burrows-Wheeler index of a text of integers below 511 whose last letter occurs nowhere else.

    ``heads`` and ``starts`` are the letters and first ranks of the runs,
    ``top`` and ``bottom`` the suffix-array entries at each run's first and
    last rank, and ``common`` the lengths of the common prefixes where two
    runs meet.
    """

    def __init__(self, text: np.ndarray):
        suffixes = SuffixArray(text)
        sa, self.size = suffixes.order, len(text)
        bwt = text[sa - 1]  # (the letter before the first one is the last one)
        self.starts = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        self.heads = bwt[self.starts]
        self.top, self.bottom = sa[self.starts], sa[np.r_[self.starts[1:], self.size] - 1]
        self.common = suffixes.common(self.bottom[:-1], self.top[1:])

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every place of the text the length of its match with the suffix above
        and with the one below it in suffix order."""
        place, out = np.arange(self.size), []
        for at, match in ((self.top, np.r_[0, self.common]), (self.bottom, np.r_[self.common, 0])):
            sampled = np.full(self.size, -1)
            sampled[at] = match
            last = np.maximum.accumulate(np.where(sampled >= 0, place, 0))  # the sampled place before; the first one is sampled
            out.append(np.maximum(sampled[last] - (place - last), 0))
        return out[0], out[1]


def repeated_windows(held: list[tuple[bytes, int]], length: int) -> list[np.ndarray]:
    """Per piece (bytes, number of windows) the starts of its windows that stand
    elsewhere in the pieces too, as (first, end) ranges."""
    texts, at, size = [], [], 0
    for data, _ in held:
        at.append(size)
        texts += [np.frombuffer(data, np.uint8).astype(np.int16) + 2, np.ones(1, np.int16)]
        size += len(data) + 1
    above, below = RunIndex(np.concatenate([*texts, np.zeros(1, np.int16)])).matching_statistics()
    begins = np.zeros(size + 1, np.int8)  # windows start at a piece's first places; matches of later ones cross its end
    begins[at] = 1
    begins[np.add(at, [w for _, w in held])] = -1
    again = np.zeros(size + 3, np.int8)
    again[1:-1] = (np.maximum(above, below) >= length) & (np.cumsum(begins) > 0)
    edge = np.diff(again)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cut = np.searchsorted(starts, [*at, size])
    return [np.stack([starts[a:b], ends[a:b]], 1) - x for a, b, x in zip(cut, cut[1:], at)]


def _places(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The pieces of each text (``id``, ``tid``, ``bytes``): place, anchor's hash and digest."""
    schema = T.StructType([texts.schema["id"], *[T.StructField(c, t()) for c, t in (
        ("tid", T.BinaryType), ("start", T.LongType), ("windows", T.IntegerType), ("anchor", T.IntegerType), ("key", T.LongType), ("piece", T.BinaryType))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[np.ndarray] = []
            digests: list[bytes] = []

            def made() -> pa.RecordBatch:
                row, s, w, p, k = np.concatenate(held, 1)
                at = pa.array(row)
                return pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(s), pa.array(w.astype(np.int32)),
                                                   pa.array(p.astype(np.int32)), pa.array(k), pa.array(digests, pa.binary())], names=schema.names)

            for i, t in enumerate(b.column(2)):
                raw = memoryview(t.as_py())
                for c in range(0, len(raw) - length + 1, CHUNK):  # a piece that two chunks share is cut; its windows still lie in one piece each
                    part = raw[c:c + CHUNK + length - 1]
                    start, windows, place, key = pieces(np.frombuffer(part, np.uint8), length, gram)
                    held.append(np.stack([np.full(len(start), i), start + c, windows, place, key]))
                    digests += [hashlib.blake2b(part[s:s + w + length - 1], digest_size=16).digest() for s, w in zip(start.tolist(), windows.tolist())]
                    if len(digests) >= HELD_PIECES:
                        yield made()
                        held, digests = [], []
            if held:
                yield made()

    return texts.filter(F.length("bytes") >= length).mapInArrow(run, schema)


def _indexed(content: DataFrame, length: int) -> DataFrame:
    """``(piece, first, end)``: ranges of repeated windows of the pieces of ``content``
    (key, piece, windows, n, bytes) that stand at one place; a key's pieces are taken by one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[bytes] = []
        held: list[tuple[bytes, int]] = []
        counts: list[int] = []
        size, last = 0, None

        def made() -> pa.RecordBatch:
            ranges = [r if n == 1 else r[:0] for r, n in zip(repeated_windows(held, length), counts)]
            row = np.repeat(np.arange(len(held)), [len(r) for r in ranges])
            all_ = np.concatenate(ranges)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()).take(pa.array(row)), pa.array(all_[:, 0].astype(np.int32)),
                                               pa.array(all_[:, 1].astype(np.int32))], names=["piece", "first", "end"])

        for b in batches:
            for key, piece, windows, n, data in zip(*[c.to_pylist() for c in b.columns]):
                if names and piece == names[-1]:  # a rep that stands in equal rows
                    continue
                if key != last and size >= BLOCK_BYTES:
                    yield made()
                    names, held, counts, size = [], [], [], 0
                names.append(piece)
                held.append((data, windows))
                counts.append(n)
                size += len(data)
                last = key
        if held:
            yield made()

    rows = content.select("key", "piece", "windows", "n", "bytes").repartition("key").sortWithinPartitions("key", "piece")
    return rows.mapInArrow(run, "piece binary, first int, end int")


def _with_groups(content: DataFrame, group_pieces: int) -> DataFrame:
    """``content`` (key, piece, n, lo, hi, ...) of the keys that have several pieces; ``hot`` if they are many."""
    groups = content.groupBy("key").agg(F.count(F.lit(1)).alias("pieces"), F.max(F.col("hi") > F.col("lo")).alias("wide"))
    return content.join(groups.filter("pieces > 1").select("key", ((F.col("pieces") > group_pieces) & F.col("wide")).alias("hot")), "key")


def _marked(content: DataFrame, length: int, group_pieces: int) -> DataFrame:
    """``(piece, first, end)`` for the pieces at one place of ``content`` (key, piece, windows,
    anchor, n, bytes, lo, hi, hot), different ones; the anchors stand at ``lo`` to ``hi`` of a piece's windows."""
    done = _indexed(content.filter("NOT hot"), length)
    hot = content.filter("hot")
    if not hot.limit(1).count():
        return done
    hot = hot.dropDuplicates(["key", "piece"])
    # the windows with the anchor above the middle, and the others; what a half's windows have in common is longer
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    split = F.greatest(F.lit(0), F.least(F.col("windows"), F.col("anchor") - middle))
    halves = F.array(*[F.struct(a.alias("skip"), c.alias("windows"), lo.alias("lo"), hi.alias("hi"))
                       for a, c, lo, hi in ((F.lit(0), split, middle + 1, F.col("hi")), (split, F.col("windows") - split, F.col("lo"), middle))])
    part = (hot.select(F.col("piece").alias("parent"), "anchor", "n", "bytes", F.explode(halves).alias("h")).filter("h.windows > 0")
            .select("parent", "h.skip", "h.windows", (F.col("anchor") - F.col("h.skip")).alias("anchor"), "n", "h.lo", "h.hi",
                    F.substring("bytes", F.col("h.skip") + 1, F.col("h.windows") + (length - 1)).alias("bytes"))
            .withColumn("key", F.xxhash64("lo", "hi", F.substring("bytes", F.col("anchor") - F.col("lo") + 1, F.lit(length) - F.col("hi") + F.col("lo"))))
            .withColumn("piece", F.unhex(F.md5("bytes"))))
    part = cut_lineage(part, "halved-pieces")
    same = cut_lineage(part.groupBy("key", "piece").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("windows", "anchor", "lo", "hi", "bytes")]), "pieces")
    found = _marked(cut_lineage(_with_groups(same, group_pieces), "pieces"), length, group_pieces).unionByName(_whole(same))
    back = part.filter("n = 1").select("parent", "skip", "piece").join(cut_lineage(found, "found"), "piece").select(
        F.col("parent").alias("piece"), (F.col("first") + F.col("skip")).alias("first"), (F.col("end") + F.col("skip")).alias("end"))
    return done.unionByName(back)


def _whole(content: DataFrame) -> DataFrame:
    """A piece that stands at several places is repeated from its first window to its last."""
    return content.filter("n > 1").select("piece", F.lit(0).alias("first"), F.col("windows").alias("end"))


def repeated_bytes(texts: DataFrame, length: int = 400, gram: int = GRAM, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``(tid, spans)``: of the texts (id, tid, bytes; ``tid`` is the text's digest)
    that hold repeated bytes, these as sorted, separate spans (start, end) of byte offsets."""
    place = cut_lineage(_places(texts, length, gram), "places")
    rep = (place.groupBy("key", "piece").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("tid", "id", "start", "windows", "anchor")).alias("r"))
           .select("key", "piece", "n", "r.*", F.lit(0).alias("lo"), F.lit(length - gram).alias("hi")))
    rep = cut_lineage(rep, "pieces")
    wanted = (_with_groups(rep, group_pieces).groupBy(F.col("tid").alias("r_tid"), F.col("id").alias("r_id"))
              .agg(F.collect_list(F.struct("key", "piece", "n", "start", "windows", "anchor", "lo", "hi", "hot")).alias("r")))
    content = (texts.join(wanted, (F.col("tid") == F.col("r_tid")) & F.col("id").eqNullSafe(F.col("r_id")))
               .select("bytes", F.explode("r").alias("r"))
               .select("r.key", "r.piece", "r.n", "r.windows", "r.anchor", "r.lo", "r.hi", "r.hot",
                       F.substring("bytes", (F.col("r.start") + 1).cast("int"), F.col("r.windows") + (length - 1)).alias("bytes")))
    found = cut_lineage(_marked(cut_lineage(content, "piece-bytes"), length, group_pieces).unionByName(_whole(rep)), "found")
    # (grouped first: the copies of a text have the same spans)
    span = (place.select("tid", "start", "piece").join(found, "piece")
            .groupBy("tid", (F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("end") + (length - 1)).alias("b")).agg(F.lit(1).alias("one")))
    text = Window.partitionBy("tid").orderBy("a", "b")
    gap = F.col("a") > F.coalesce(F.max("b").over(text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    run = span.select("tid", "a", "b", gap.cast("int").alias("gap")).withColumn("run", F.sum("gap").over(text))
    return (run.groupBy("tid", "run").agg(F.min("a").alias("start"), F.max("b").alias("end"))
            .groupBy("tid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")))


def remove_repeated_bytes(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 400, spans: str = "removed_spans", kept: str = "kept",
                          gram: int = GRAM, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``df`` with the repeated bytes of ``text`` (as UTF-8) found: ``spans``, an
    array of (start, end) byte offsets of what goes, and ``kept``, the other
    bytes (a string could be cut inside a letter).  Columns of those names are
    replaced.

    A byte goes if a string of ``length`` bytes that holds it starts at two
    places or more of the corpus, in one text or in several, overlaps
    included; texts are judged as given, not after the removal.  No occurrence
    is kept: every copy of a long text goes whole.  Rows equal in everything
    count as often as they stand there.  A null text has no spans and a null
    ``kept``, shorter texts than ``length`` keep everything.  ``id_col`` may
    repeat or be null; it only helps to fetch a text once.  ``gram`` is the
    length of the anchors, at most ``length``.
    """
    if not 1 <= gram <= length:
        raise ValueError("gram must lie between 1 and length")
    names = [c for c in df.columns if c.lower() not in (spans.lower(), kept.lower())]
    tid, found = fresh(df, "text_digest", "text_spans")
    raw = col(text).cast("string").cast("binary")
    texts = df.filter(col(text).isNotNull()).select(col(id_col).alias("id"), F.unhex(F.md5(raw)).alias("tid"), raw.alias("bytes"))
    cut = repeated_bytes(texts, length, gram, group_pieces).toDF(tid, found)
    joined = df.join(cut, F.unhex(F.md5(raw)) == F.col(tid), "left")
    gone = F.col(found)

    def others(data: Column) -> Column:  # the bytes between two spans
        begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(gone, lambda s: s["end"]))
        ends = F.concat(F.transform(gone, lambda s: s["start"]), F.array(F.octet_length(data).cast("long")))
        return F.unhex(F.array_join(F.zip_with(begins, ends, lambda x, y: F.hex(F.substring(data, (x + 1).cast("int"), (y - x).cast("int")))), ""))
    left = let(raw, others)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return joined.select(*[col(n) for n in names], F.coalesce(gone, none).alias(spans), F.when(gone.isNull(), raw).otherwise(left).alias(kept))
