"""Best-fit packing of tokenised documents into sequences.

Only lengths decide a packing, and there are at most ``capacity`` of them, so
it is planned on the global histogram of piece lengths: the driver sees one
count per length.  Pieces above a third of the capacity go first, at most two
to a sequence, each longest one with the longest partner that still fits;
shorter pieces then go, longest first, into the smallest gap that takes them.
The plan is a short list of sequence patterns with multiplicities.  A piece
finds its place in it by its rank among the pieces of its length, which comes
from a count per task written with the piece and a running sum over tasks, so
nothing is gathered and no token is shuffled.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import cut_lineage
from .common import col, per_process, quoted

FLUSH = 1 << 20  # tokens that a task holds before it passes pieces on

#: Fixed value: how byte-level BPE of this kind cuts a text into words.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of a text by a tokenizer file, special tokens not added.

    A plain byte-level BPE (no normaliser, merges in the order of their ids)
    gives the same ids through a faster engine fed with the file's own
    vocabulary.  A text with an added token's string, or with letters beyond
    U+2FFF (where the engines may know other Unicode versions), and any other
    kind of tokenizer goes through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        self.path, self.fast, self.exact = path, None, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                and not spec["normalizer"] and not any(model.get(k) for k in (
                    "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))):
            shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
            byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
            added = {t["content"] for t in spec["added_tokens"]}
            vocab = model["vocab"]
            made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
            if all(a < b for a, b in zip(made, made[1:])):
                ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in added}
                self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
                self.exact = re.compile("|".join(["[　-\U0010ffff]", *map(re.escape, sorted(added))]))

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not self.exact.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)

    @cached_property
    def plain(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)


def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return per_process(("encoder", path), lambda: Encoder(path))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def tokenised_pieces(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = 1024,
                     end_id: int = 2) -> DataFrame:
    """``(<id>, piece, start, length, ids, ids_crc32, task, nth)``.

    A null text counts as empty; every document ends with ``end_id``, so an
    empty one is a piece of one token.  ``nth`` counts the task's earlier
    pieces of the same length; ``task`` and ``nth`` hold for one written copy
    of the result, so write it before use.  ``ids_crc32`` is the checksum of
    the ids as little-endian unsigned 32-bit numbers.
    """
    src = df.select(col(id_col), F.coalesce(col(text).cast("string"), F.lit("")).alias("text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        for b in batches:
            ids: list[np.ndarray] = []
            rows: list[tuple[int, int, int, int, int, int]] = []
            held = 0
            for i, t in enumerate(b.column(1)):
                tokens = np.append(encode(t.as_py()), np.uint32(end_id)).astype("<u4")
                ids.append(tokens)
                for k, (s, n) in enumerate(cut(len(tokens), capacity)):
                    rows.append((i, k, s, n, zlib.crc32(tokens[s : s + n]), met[n]))
                    met[n] += 1
                held += len(tokens)
                if held >= FLUSH:
                    yield packed(b, rows, ids, task)
                    rows, ids, held = [], [], 0
            if rows:
                yield packed(b, rows, ids, task)

    def packed(b: pa.RecordBatch, rows: list, ids: list, task: int) -> pa.RecordBatch:
        i, k, s, n, crc, nth = np.array(rows, np.int64).T
        offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(i)), pa.array(k.astype(np.int32)), pa.array(s), pa.array(n),
             pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).astype(np.int32))), pa.array(crc),
             pa.array(np.full(len(i), task, np.int32)), pa.array(nth)],
            names=[id_col, "piece", "start", "length", "ids", "ids_crc32", "task", "nth"])

    return src.mapInArrow(run, f"{quoted(id_col)} {src.schema[0].dataType.simpleString()}, piece int, start long, length long, "
                               "ids array<int>, ids_crc32 long, task int, nth long")


@dataclass
class Bins:
    """``n`` sequences that all hold the same (length, copies), in this order."""

    n: int
    held: tuple[tuple[int, int], ...]


def plan(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Sequences for ``counts`` pieces of each length (1 to ``capacity``)."""
    left = {n: c for n, c in counts.items() if c > 0}
    by_gap: dict[int, list[Bins]] = {}
    gaps: list[int] = []
    done: list[Bins] = []

    def put(n: int, held: tuple, gap: int) -> None:
        if not n:
            return
        if not gap:
            done.append(Bins(n, held))
            return
        if not by_gap.get(gap):
            insort(gaps, gap)
            by_gap[gap] = []
        by_gap[gap].append(Bins(n, held))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large.pop()
        c = left.pop(n)
        while c:
            k = bisect_left(large, capacity - n + 1) - 1  # the longest other partner that fits
            if 2 * n <= capacity and c > 1:  # all others are shorter
                put(c // 2, ((n, 2),), capacity - 2 * n)
                c %= 2
            elif k >= 0:
                p = large[k]
                m = min(c, left[p])
                put(m, ((n, 1), (p, 1)), capacity - n - p)
                c -= m
                left[p] -= m
                if not left[p]:
                    del left[p]
                    large.pop(k)
            else:
                put(c, ((n, 1),), capacity - n)
                c = 0
    for n in sorted(left, reverse=True):
        c = left[n]
        while c:
            k = bisect_left(gaps, n)
            if k < len(gaps):
                gap = gaps[k]
                old = by_gap[gap].pop()
                if not by_gap[gap]:
                    gaps.pop(k)
            else:
                gap, old = capacity, Bins(-(-c // (capacity // n)), ())
            most = gap // n
            full = min(old.n, c // most)
            put(full, (*old.held, (n, most)), gap - most * n)
            c -= full * most
            rest = old.n - full
            if rest and c:  # fewer than ``most`` remain: one sequence takes them
                put(1, (*old.held, (n, c)), gap - c * n)
                c, rest = 0, rest - 1
            put(rest, old.held, gap)
    return done + [b for g in gaps for b in by_gap[g]]


def places(bins: list[Bins]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, lo, hi, first sequence, offset, copies)``: the pieces of a
    length ranked ``lo`` up to ``hi`` fill so many copies a sequence, from an
    offset on."""
    met: dict[int, int] = {}
    out, base = [], 0
    for b in bins:
        at = 0
        for n, copies in b.held:
            lo = met.get(n, 0)
            met[n] = lo + b.n * copies
            out.append((n, lo, met[n], base, at, copies))
            at += n * copies
        base += b.n
    return out


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2,
         broadcast_rows: int = 1_000_000) -> DataFrame:
    """``(<id>, piece, start, length, ids, ids_crc32, sequence_id, offset)``:
    every piece of every row of ``df`` with its place.

    Each row is a document of its own, also where ids repeat or are null.
    An empty table packs into nothing.  If ``id_col`` is named like one of the
    other columns, whatever the case, that column's name ends in ``_``.  The running counts per task and length
    are broadcast while they are at most ``broadcast_rows``; above, they are
    joined by a shuffle.
    """
    docs = df.select(col(id_col).alias("__id"), col(text).alias("text"))
    pieces = cut_lineage(tokenised_pieces(docs, tokenizer, "__id", "text", capacity, end_id), "pieces")
    per_task = cut_lineage(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = per_task.groupBy("length").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()  # one row a length
    placed = places(plan({r["length"]: r["n"] for r in counts}, capacity))
    table = F.broadcast(df.sparkSession.createDataFrame(
        placed, "length long, lo long, hi long, first long, at long, copies long"))  # bounded by the number of lengths
    before = per_task.select("task", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    if sum(r["rows"] for r in counts) <= broadcast_rows:
        before = F.broadcast(before)
    ranked = pieces.join(before, ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    found = ranked.join(table, "length").filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    step = F.col("rank") - F.col("lo")
    out = {**{c: F.col(c) for c in ("piece", "start", "length", "ids", "ids_crc32")},
           "sequence_id": F.col("first") + F.expr("(rank - lo) div copies"), "offset": F.col("at") + step % F.col("copies") * F.col("length")}
    return found.select(F.col("__id").alias(id_col), *[v.alias(f"{c}_" if c == id_col.lower() else c) for c, v in out.items()])
