"""Embedding near-dedup with a forest of random-projection trees.

Each tree splits the unit vectors by random projections, level by level, at
the median of the node; vectors close to a split go to both sides (spill
overlap).  Vectors are compared within leaves only, in double precision, and
linked when their cosine reaches the threshold; links of all trees are united.

The forest is fitted on a bounded sample: ``sample`` vectors at most give the
medians, node by node down to ``NODE_LEVELS`` levels and one per level below.
A tree has one direction per level, from the seed.  Every vector is indexed.

Equal vectors are compared once.  A leaf with more than ``SEGMENT`` vectors is
cut into segments, and every pair of segments is a group of its own.  A pair
that meets in several leaves is counted in the first one they share, which
the rows tell from the lists of leaves they carry; so a task passes on a
count per vector and one edge per vector to its part's first one, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import col, connected_components, sorted_groups

SEGMENT = 1024
NODE_LEVELS = 14


def usable(vec: Column) -> Column:
    """Neither null nor empty nor zero, every component finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vec) > 0) & F.forall(vec, finite) & F.exists(vec, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column whose lists have one length and no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


class Forest:
    """Trees for vectors of one dimension, fitted on sampled unit vectors."""

    def __init__(self, sample: np.ndarray, dim: int, trees: int, depth: int, margin: float, seed: int):
        self.dim, self.trees, self.depth, self.margin, self.seed = dim, trees, depth, margin, seed
        self.nodes: list[list[np.ndarray]] = []  # by tree and level: the splits of its nodes, or one for all
        for t in range(trees):
            p, at, levels = sample @ self.directions(t), np.zeros(len(sample), np.int64), []
            for k in range(depth):
                general = float(np.median(p[:, k])) if len(p) else 0.0
                split = np.full(1 << k if k < NODE_LEVELS else 1, general)
                if len(split) > 1 or k == 0:
                    order = np.argsort(at, kind="stable")
                    ids, start = np.unique(at[order], return_index=True)
                    for i, rows in zip(ids, np.split(order, start[1:]) if len(ids) else [], strict=True):
                        split[i] = np.median(p[rows, k])
                levels.append(split)
                at = at * 2 + (p[:, k] >= split[at if len(split) > 1 else np.zeros_like(at)])
            self.nodes.append(levels)

    def directions(self, tree: int) -> np.ndarray:
        return np.random.default_rng([self.seed, self.dim, tree]).standard_normal((self.dim, self.depth)) / np.sqrt(self.dim)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf of every tree that a row falls into;
        leaves of all trees are numbered apart, rows in order."""
        rows, codes = [], []
        for t in range(self.trees):
            p = x @ self.directions(t)
            row, at = np.arange(len(x)), np.zeros(len(x), np.int64)
            for k, split in enumerate(self.nodes[t]):
                off = p[row, k] - split[at if len(split) > 1 else np.zeros_like(at)]
                low, high = off < self.margin, off >= -self.margin
                row, at = np.concatenate([row[low], row[high]]), np.concatenate([at[low] * 2, at[high] * 2 + 1])
            rows.append(row)
            codes.append(at + (t << self.depth))
        row, code = np.concatenate(rows), np.concatenate(codes)
        order = np.lexsort((code, row))
        return row[order], code[order]


def _shared_before(lists: list[np.ndarray], leaf: int) -> np.ndarray:
    """Whether two rows share a leaf numbered before ``leaf``: a matrix over
    all pairs of rows, from products of their 0/1 membership in such leaves."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    code = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    early = code < leaf
    row, code = row[early], code[early]
    codes, at, n = np.unique(code, return_inverse=True, return_counts=True)
    both = n[at] > 1  # a leaf that only one of the rows has is shared with none
    column = np.cumsum(n > 1) - 1
    row, at = row[both], column[at[both]]
    out = np.zeros((len(lists), len(lists)), bool)
    for s in range(0, int((n > 1).sum()), 1024):
        here = (at >= s) & (at < s + 1024)
        member = np.zeros((len(lists), 1024), np.float32)
        member[row[here], at[here] - s] = 1
        out |= (member @ member.T) > 0
    return out


def _stars(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a symmetric 0/1 matrix of links: every row but the first of each
    connected part, and that first row."""
    some = np.flatnonzero(linked.any(1))
    linked = linked[np.ix_(some, some)]
    label = np.arange(len(some))
    while True:
        low = np.minimum(label, np.where(linked, label, len(some)).min(1, initial=len(some)))
        low = low[low]
        if np.array_equal(low, label):
            break
        label = low
    rest = np.flatnonzero(label != np.arange(len(some)))
    return some[rest], some[label[rest]]


def embedding_groups(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", threshold: float = 0.95, trees: int = 6,
                     leaf: int = 128, spill: float = 0.5, sample: int = 16384, seed: int = 29) -> DataFrame:
    """``(<id>, n_links, component_id, kept)`` per row of ``df``.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id reachable by links (the own id included), ``kept`` marks rows
    that bear it.  Unusable vectors (see :func:`usable`) link with nothing;
    vectors of different dimension never link; rows that repeat link like any
    other.  A null id names a group only if all its ids are null.

    ``leaf`` is the mean leaf size aimed at, ``spill`` the width of the
    overlap on either side of a split in standard deviations of the projected
    difference of two vectors at the threshold.
    """
    ok = usable(col(vec))
    key = F.struct(F.xxhash64(col(vec)).alias("x"), F.xxhash64(F.lit(1), col(vec)).alias("y"))
    rows = df.select(col(id_col).alias("id"), F.when(ok, key).alias("key"))
    distinct, seen = cut_lineage(
        df.filter(ok).select(key.alias("key"), col(id_col).alias("id"), col(vec).alias("v")).groupBy("key")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")).withColumn("dim", F.size("v")),
        "vectors", {"n": F.count(F.lit(1)), "dims": F.collect_set("dim")})
    forests = {}
    for dim in sorted(seen["dims"] or []):
        take = max(256, min(sample, (1 << 22) // dim))  # a bound on the sample in components too
        part = distinct.filter(F.col("dim") == dim)
        picked = part.orderBy(F.xxhash64("key"), "key").limit(take).select("v").toArrow()["v"]
        n = part.count() if len(seen["dims"]) > 1 else seen["n"]
        depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
        margin = spill * np.sqrt(max(0.0, 2 - 2 * threshold)) / np.sqrt(dim)
        forests[dim] = Forest(unit(matrix(picked)), dim, trees, depth, margin, seed)

    small = all(f.trees << f.depth < 1 << 31 for f in forests.values())  # leaves' numbers fit four bytes
    number = np.int32 if small else np.int64

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(4).to_numpy()
            for dim in np.unique(dims):
                of = b.filter(pa.array(dims == dim))
                for s in range(0, of.num_rows, 2048):  # so that the copies of few rows are held at once
                    some = of.slice(s, 2048)
                    row, code = forests[int(dim)].leaves(unit(matrix(some.column(3))))
                    # a copy carries the leaves of its row that are numbered before its own
                    start = np.searchsorted(row, row)
                    before = np.arange(len(row)) - start
                    offsets = np.r_[0, np.cumsum(before)]
                    values = code[np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, before)].astype(number)
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), dim, np.int32)), pa.array(code), *[some.column(i).take(at) for i in range(4)],
                         pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))],
                        names=["dim", "leaf", "kx", "ky", "copies", "v", "leaves"])

    kind = distinct.schema["v"].dataType.simpleString()
    routed = cut_lineage(distinct.select("key.x", "key.y", "copies", "v", "dim").mapInArrow(
        route, f"dim int, leaf long, kx long, ky long, copies long, v {kind}, leaves array<{'int' if small else 'long'}>"), "leaves")
    full = (routed.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SEGMENT)
            .select("dim", "leaf", F.ceil(F.col("n") / SEGMENT).cast("int").alias("parts")))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    own = F.pmod(F.xxhash64("kx", "leaf"), parts).cast("int")
    dealt = (routed.join(full, ["dim", "leaf"], "left").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("dim", "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "kx", "ky", "copies", "v", "leaves")
             .repartition("dim", "leaf", "i", "j").sortWithinPartitions("dim", "leaf", "i", "j"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, 4):
            if g.num_rows < 2:
                continue
            x = unit(matrix(g["v"]))
            linked = x @ x.T >= threshold
            np.fill_diagonal(linked, False)
            if g["i"][0].as_py() != g["j"][0].as_py():  # two segments: only pairs across
                own = g["own"].to_numpy()
                linked &= own[:, None] != own[None, :]
            if not linked.any():
                continue
            lists = np.split(g["leaves"].combine_chunks().flatten().to_numpy(), np.cumsum(pc.list_value_length(g["leaves"]).to_numpy())[:-1])
            mine = linked & ~_shared_before(lists, g["leaf"][0].as_py())
            links = (mine @ g["copies"].to_numpy().astype(float)).astype(np.int64)
            kx, ky = g["kx"].to_numpy(), g["ky"].to_numpy()
            some = np.flatnonzero(links)
            none = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(kx[some]), pa.array(ky[some]), none, none, pa.array(links[some])],
                                             names=["ax", "ay", "bx", "by", "links"])
            a, b = _stars(linked)
            yield pa.RecordBatch.from_arrays([pa.array(kx[a]), pa.array(ky[a]), pa.array(kx[b]), pa.array(ky[b]), pa.array(np.zeros(len(a), np.int64))],
                                             names=["ax", "ay", "bx", "by", "links"])

    found = cut_lineage(dealt.mapInArrow(compare, "ax long, ay long, bx long, by long, links long"), "embedding-links")
    a = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))
    b = F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    links = found.filter("links > 0").groupBy(a.alias("key")).agg(F.sum("links").alias("links"))
    comps = connected_components(found.filter(F.col("bx").isNotNull()).select(a.alias("a"), b.alias("b")))
    comps = cut_lineage(comps.select(F.col("node").alias("key"), "component"), "embedding-parts")
    named = distinct.select("key", "first", "copies").join(comps, "key", "left").withColumn("root", F.coalesce("component", "key"))
    names = named.filter(F.col("component").isNotNull()).groupBy("root").agg(F.min("first").alias("name"))
    by_key = (named.join(names, "root", "left").join(links, "key", "left")
              .select("key", F.coalesce("name", "first").alias("name"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    out = rows.join(by_key, "key", "left")
    name = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("name"))
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), name.alias("component_id"),
                      F.col("id").eqNullSafe(name).alias("kept"))
