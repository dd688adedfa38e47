"""SimHash near-dedup with bit-sliced comparison.

A text's 64-bit fingerprint comes from the XXH64 hashes of its word shingles.
Equal fingerprints are merged first; the distinct ones are compared within
buckets that share some of their bits.  For a radius ``r`` the 64 bits are cut
into ``r + e`` pieces; two fingerprints that differ in at most ``r`` bits agree
on at least ``e`` pieces, so a bucket for every choice of ``e`` pieces misses
no link.  ``e`` only sets how finely the fingerprints are spread (more of them
take a larger ``e``); the links found are the same for any.

A bucket that still holds many fingerprints is cut into segments, and every
pair of segments is a group of its own, so no group outgrows a task.

Within a group the fingerprints lie vertically, one bit plane per bit, and one
lane per row.  The planes are xor-ed with themselves shifted by ``s`` rows; the
64 difference planes go through carry-save counters, which hold all lanes'
distances to the row ``s`` further on, and blocks of 64 lanes are abandoned
once all of them exceed the radius.  Of a part that they connect, only one link
per row leaves a task, so a large group of near copies gives no more rows than
it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import col, connected_components, fresh

SEGMENT = 2048  # fingerprints of a bucket that are compared as one group
CHUNK = 1 << 16  # rows whose planes are built at once; whole groups
HASHED = 1 << 16  # shingles hashed at once


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the text's word shingles.

    A-Z are lower-cased, words are runs of anything but space and the control
    characters 9-13, a shingle is its words joined by one space; a text with
    fewer words has one shingle of all of them, a text without words (or null)
    the fingerprint 0.  A bit is 1 if it is set in over half the hashes.
    """
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    k = min(words, len(parts))
    starts, ends = (ends - sizes)[: len(parts) - k + 1], ends[k - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), HASHED):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[i : i + HASHED].tolist(), ends[i : i + HASHED].tolist(), strict=True)],
                     np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """``(id, text_hash, fp)`` per row of ``df``; ``fp`` is a signed 64-bit
    number, ``text_hash`` tells rows of a repeated id apart."""
    src = df.select(col(id_col).alias("id"), F.xxhash64(col(text)).alias("text_hash"), col(text).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t.as_py(), words, seed) for t in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fp], names=["id", "text_hash", "fp"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text_hash long, fp long")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 planes of the rows' bits, 64 rows a word, with two empty words more."""
    n = len(fps)
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    out = np.zeros((64, (n + 63) // 64 + 2), np.uint64)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out.view(np.uint8)[:, : packed.shape[1]] = packed
    return out


def _more_than(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count (bits in ``counters``, lowest first) exceeds the radius."""
    more, equal = over.copy(), ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def near_pairs(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows ``(i, j)``, ``i < j``, of one group that differ in at most
    ``radius`` bits; ``group`` is sorted.  One step per distance in rows."""
    n, planes = len(fps), bit_planes(fps)
    words = (n + 63) // 64
    last = np.searchsorted(group, group, side="right") - 1
    room = np.full(words * 64, 0)
    room[:n] = last - np.arange(n)
    room = room.reshape(words, 64)
    most = room.max(1)
    block, s, size = np.arange(words), 0, radius.bit_length()
    while True:
        s += 1
        block = block[most[block] >= s]
        if not len(block):
            return
        alive = np.packbits(room[block] >= s, axis=1, bitorder="little").view(np.uint64)[:, 0]
        at, skip, shift = block, s // 64, np.uint64(s % 64)
        counters = [np.zeros(len(at), np.uint64) for _ in range(size)]
        over = np.zeros(len(at), np.uint64)
        for p in range(0, 64, 8):
            for plane in planes[p : p + 8]:
                other = plane[at + skip]
                if s % 64:
                    other = (other >> shift) | (plane[at + skip + 1] << np.uint64(64 - s % 64))
                carry = plane[at] ^ other
                for k in range(size):
                    counters[k], carry = counters[k] ^ carry, counters[k] & carry
                over |= carry
            alive = alive & ~_more_than(counters, over, radius)
            live = alive != 0
            if not live.all():
                at, alive, over = at[live], alive[live], over[live]
                counters = [c[live] for c in counters]
                if not len(at):
                    break
        if len(at):
            lanes = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(len(at), 64)
            b, lane = np.nonzero(lanes)
            i = at[b] * 64 + lane
            yield i, i + s


def spanning_links(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each part that the groups' links connect, links of its rows to one
    of them, as two arrays of fingerprints."""
    root = np.arange(len(fps))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in near_pairs(fps, group, radius):
        new = root[i] != root[j]
        if not new.any():
            continue
        for x, y in zip(i[new].tolist(), j[new].tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
        while not np.array_equal(root, up := root[root]):
            root[:] = up
    rest = np.flatnonzero(root != np.arange(len(fps)))
    return fps[rest], fps[root[rest]]


def pieces_for(n: int, radius: int, most: int = 256) -> int:
    """The ``e`` that spreads ``n`` fingerprints to about ``most`` a bucket."""
    e = 1
    while e < 4 and n / 2 ** (64 * e / (radius + e)) > most:
        e += 1
    return e


def link_forest(distinct: DataFrame, n: int, radius: int = 4, fp: str = "fp") -> DataFrame:
    """``(a, b)``: links between distinct fingerprints (column ``fp``, ``n`` of
    them) within the radius, enough to connect whatever is connected."""
    e = pieces_for(n, radius)
    edge = [64 * k // (radius + e) for k in range(radius + e + 1)]
    piece = [((1 << edge[k + 1]) - (1 << edge[k])) for k in range(radius + e)]
    masks = [sum(piece[k] for k in choice) for choice in combinations(range(radius + e), e)]
    assert len(masks) == comb(radius + e, e)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = distinct.select(F.col(fp).alias("fp"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(fp).bitwiseAND(F.lit(signed(m)).cast("long")).alias("v")) for i, m in enumerate(masks)])).alias("k")
    ).select("fp", "k.c", "k.v")
    full = (keys.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SEGMENT)
            .select("c", "v", F.ceil(F.col("n") / SEGMENT).cast("int").alias("parts")))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    own = F.pmod(F.xxhash64("fp", "c"), parts).cast("int")
    grouped = keys.join(full, ["c", "v"], "left").select(
        "fp", "c", "v", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")
    ).select("fp", "c", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    dealt = grouped.repartition("c", "v", "i", "j").sortWithinPartitions("c", "v", "i", "j", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(rows: list[np.ndarray]) -> pa.RecordBatch:
            a, b = spanning_links(rows[0], rows[1], radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        key, number = None, 0
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            if not len(cols[0]):
                continue
            k = np.stack([c.astype(np.int64) for c in cols[1:]])
            new = np.ones(k.shape[1], bool)
            new[1:] = (k[:, 1:] != k[:, :-1]).any(0)
            new[0] = key is None or (k[:, 0] != key).any()
            ids = number + np.cumsum(new)
            key, number = k[:, -1], int(ids[-1])
            held = [np.concatenate([held[0], cols[0]]), np.concatenate([held[1], ids])]
            if len(held[0]) >= CHUNK:
                cut = int(np.searchsorted(held[1], held[1][-1]))  # the last group may go on
                if cut:
                    yield linked([held[0][:cut], held[1][:cut]])
                    held = [held[0][cut:], held[1][cut:]]
        if len(held[0]):
            yield linked(held)

    return dealt.mapInArrow(run, "a long, b long")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4,
                   seed: int = 42) -> DataFrame:
    """``(id, text_hash, fp, root, component)`` per row of ``df``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked.
    ``component`` is the smallest id reachable by links, the row's own id
    included; ``root``, a fingerprint, names the group even where ids repeat.
    Repeated rows each get a row; a null id names a group only if all its ids
    are null.  An empty table gives an empty result.
    """
    rows = cut_lineage(fingerprints(df, id_col, text, words, seed), "simhash")
    distinct, seen = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct", {"n": F.count(F.lit(1))})
    parts = connected_components(link_forest(distinct, seen["n"], radius))
    parts = cut_lineage(parts.select(F.col("node").alias("fp"), "component"), "simhash-parts")
    named = distinct.join(parts, "fp", "left")
    # only linked fingerprints need their group's smallest id
    linked = named.filter(F.col("component").isNotNull())
    names = linked.groupBy("component").agg(F.min("first").alias("name"))
    by_fp = (linked.join(names, "component").select("fp", F.col("component").alias("root"), "name")
             .unionByName(named.filter(F.col("component").isNull())
                          .select("fp", F.col("fp").alias("root"), F.col("first").alias("name"))))
    return rows.join(by_fp, "fp").select("id", "text_hash", "fp", "root", F.col("name").alias("component"))


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4,
                  seed: int = 42) -> DataFrame:
    """``df`` with one row of each group of near copies: one that has the
    group's smallest id (of several such rows the smallest text hash; of rows
    equal in id and text, any one)."""
    groups = simhash_groups(df, id_col, text, words, radius, seed)
    best = groups.filter(F.col("id").eqNullSafe(F.col("component"))).groupBy("root", "id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    keep, seen = cut_lineage(best.groupBy("root").agg(F.min(F.struct("text_hash", "id", "n")).alias("b"))
                             .select(F.col("b.id").alias("k_id"), F.col("b.text_hash").alias("k_hash"), F.col("b.n").alias("k_n")),
                             "simhash-keep", {"most": F.max("k_n")})

    def rows_of(kept: DataFrame) -> DataFrame:
        k_id, k_hash, k_n = fresh(df, "k_id", "k_hash", "k_n")
        kept = kept.toDF(k_id, k_hash, k_n).hint("shuffle_hash")
        out = df.join(kept, col(id_col).eqNullSafe(F.col(k_id)) & (F.xxhash64(col(text)) == F.col(k_hash)))
        return out.select(*[col(c) for c in df.columns])

    if (seen["most"] or 0) <= 1:
        return rows_of(keep)
    # rows equal in id and text: one of them stays
    (again,) = fresh(df, "text_hash")
    several = rows_of(keep.filter("k_n > 1")).withColumn(again, F.xxhash64(col(text))).dropDuplicates([id_col, again])
    return rows_of(keep.filter("k_n = 1")).unionByName(several.select(*[col(c) for c in df.columns]))
