"""Reporting-line depth (H1) by pointer doubling.

Every node keeps a pointer to an ancestor and the hop count to it.  Each
round replaces the pointer with the ancestor's pointer (one equi-join of
the unresolved rows against the state), so a chain of length L resolves in
``ceil(log2 L)`` rounds.  Nodes that reach the root get their depth; nodes
whose chain breaks (missing or null manager) get null; nodes on or behind a
cycle never resolve and are null.

Each round writes the rows it advanced, and only those, to the shared
checkpoint folder: settled rows are written once and then only read, as the
look-up of later rounds.  This cuts the self-join lineage (which would
otherwise double per round) and lets a lost executor be recovered without
recomputing earlier rounds.  Only a count per round reaches the driver.

Early stop: while acyclic chains remain unresolved, every round settles at
least one node (the deepest chain has a node at each depth, and a broken
chain ends the round it reaches its gap).  So a round that settles nothing
leaves only nodes on or behind cycles, and the loop ends there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def layer_depth(df: DataFrame, person: str, manager: str, root, by: Sequence[str] = (), out: str = "layer",
                max_rounds: int | None = None) -> DataFrame:
    """Hops from each person up to ``root`` (root = 0), per ``by`` group
    (e.g. snapshot).  Raises if rows remain active after ``max_rounds`` (None: no limit
    is needed, see above).  ``df`` must hold one edge per (by, person); use
    :func:`staffwise.operators.windows.dedupe` first to make the last edge win.
    Returns ``df`` with ``out`` added."""
    by = list(by)
    # one edge per (by, person): a repeated person would fan the joins out round after
    # round; the smallest manager is kept (dedupe beforehand for last-edge-wins)
    edges = (df.select(*by, F.col(person).alias("__node"), F.col(manager).alias("__mgr"))
             .filter(F.col("__node").isNotNull())
             .groupBy(*by, "__node").agg(F.min("__mgr").alias("__mgr")))
    is_root = F.col("__node") == F.lit(root)
    state = edges.select(
        *by, "__node",
        F.when(is_root, F.lit(None)).otherwise(F.col("__mgr")).alias("__anc"),
        F.when(is_root, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("__dist"),
        (is_root | F.coalesce(F.col("__mgr") == F.lit(root), F.lit(False))).alias("__done"),
    )
    # the number of unresolved rows is counted on each written table (two columns scanned)
    is_active = ~F.col("__done") & F.col("__anc").isNotNull()
    count_active = {"n_active": F.sum(is_active.cast("long"))}
    written, seen = cut_lineage(state, "layers", count_active)
    settled, active = written.filter(~is_active), written.filter(is_active)
    prev_active, n_active, rounds = None, seen["n_active"] or 0, 0
    while n_active and n_active != prev_active:
        if max_rounds is not None and rounds == max_rounds:
            raise RuntimeError(f"{n_active} rows have no layer yet after {max_rounds} rounds")
        rounds, prev_active = rounds + 1, n_active
        known = settled.unionByName(active)
        look = known.select(*[F.col(b).alias(f"__t_{b}") for b in by], F.col("__node").alias("__t_node"),
                            F.col("__anc").alias("__t_anc"), F.col("__dist").alias("__t_dist"),
                            F.col("__done").alias("__t_done"))
        cond = active["__anc"] == look["__t_node"]
        for b in by:
            cond = cond & active[b].eqNullSafe(look[f"__t_{b}"])
        found = F.col("__t_node").isNotNull()
        stepped = active.join(look, cond, "left").select(
            *by, "__node",
            F.when(found & ~F.col("__t_done"), F.col("__t_anc")).when(found, F.col("__anc")).alias("__anc"),
            F.when(found, F.col("__dist") + F.col("__t_dist")).otherwise(F.col("__dist")).alias("__dist"),
            F.coalesce(F.col("__t_done"), F.lit(False)).alias("__done"),
        )
        # only the rows that were active are written; what has settled is never written again
        written, seen = cut_lineage(stepped, "layers", count_active)
        settled, active, n_active = settled.unionByName(written.filter(~is_active)), written.filter(is_active), seen["n_active"] or 0
    state = settled.unionByName(active)
    depth = state.select(*[F.col(b).alias(f"__d_{b}") for b in by], F.col("__node").alias("__d_node"),
                         F.when(F.col("__done"), F.col("__dist")).alias(out))
    cond = df[person] == depth["__d_node"]
    for b in by:
        cond = cond & df[b].eqNullSafe(depth[f"__d_{b}"])
    return df.join(depth, cond, "left").select(*[df[c] for c in df.columns], depth[out])
