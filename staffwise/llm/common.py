"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, drop_cut


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(quoted(name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once, also where ``body`` uses
    it in a function over array elements (a plain expression would be worked
    out again for every element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_text(df: DataFrame, text: str, replaced: tuple[str, ...], keep: Sequence[str] | None) -> tuple[DataFrame, list[str], int]:
    """The columns of ``df`` to pass on (``keep``, or all, but not those
    ``replaced``), and the place of ``text`` as a string: its own column where
    that is passed on as one, else an extra last column, so that no text is
    sent twice."""
    gone = {r.lower() for r in replaced}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in gone]
    if text in kept and isinstance(df.schema[text].dataType, T.StringType):
        return df.select(*[col(c) for c in kept]), kept, kept.index(text)
    (inner,) = fresh(df, "__text")
    return df.select(*[col(c) for c in kept], col(text).cast("string").alias(inner)), kept, len(kept)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(folds)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (two columns of one
    ordered type); ``component`` is the smallest node reachable.

    Alternating large-star and small-star steps, until the links are stars
    around their smallest nodes.  Every step is one partial ``min`` per node
    and a join back, so a node with very many links is combined on the map
    side and its join partition can be split.  Each round is written to the
    shared checkpoint folder and replaces the last one; only whether it was
    the last reaches the driver.  Null ends and self-links are ignored.
    """
    u, v = F.col("u"), F.col("v")
    e = (edges.select(F.greatest(col(a), col(b)).alias("u"), F.least(col(a), col(b)).alias("v"))
         .filter(col(a).isNotNull() & col(b).isNotNull() & (col(a) != col(b))).distinct())
    state = cut_lineage(e, "links")
    for _ in range(max_rounds):
        if _are_stars(state):
            break
        # large star: every neighbour above a node is linked to the node's smallest neighbour
        both = state.unionByName(state.select(v.alias("u"), u.alias("v")))
        # (written, so that the join partition of a node with very many links can be split)
        low = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), u).alias("m")), "lowest")
        large = both.filter(v > u).join(low, "u").select(v.alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node's smaller neighbours are linked to the smallest of them
        pairs = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = pairs.select(F.when(v == F.col("m"), u).otherwise(v).alias("u"), F.col("m").alias("v")).distinct()
        new = cut_lineage(small, "links")
        drop_cut(state)
        drop_cut(low)
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # every node but the roots has one link, to its root
    return (state.select(u.alias("node"), v.alias("component"))
            .unionByName(state.select(v.alias("node"), v.alias("component")).distinct()))


def _are_stars(links: DataFrame) -> bool:
    """Whether every upper end ``u`` has one link and is no one's lower end."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    other = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR (up = 1 AND down = 1)")
    return other.limit(1).count() == 0


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """One object per Python process and key, made on first use.

    Kept outside this package's modules, so that it also lasts from task to
    task in workers that get the package's functions sent along instead of
    importing them."""
    home = sys.modules.setdefault("_staffwise_worker_objects", ModuleType("_staffwise_worker_objects"))
    objects = home.__dict__.setdefault("objects", {})
    if key not in objects:
        objects[key] = make()
    return objects[key]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows sorted by the first ``keys`` (integer) columns, each
    as one table; holds one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(keys)])
        ends = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1
        if held and (k[:, 0] != last).any():
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for end in ends:
            yield pa.Table.from_batches([*held, b.slice(start, end - start)])
            held, start = [], end
        held.append(b.slice(start))
        last = k[:, -1]
    if held:
        yield pa.Table.from_batches(held)
