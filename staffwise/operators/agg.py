"""Aggregates (A1-A12).  All are ``groupBy().agg()`` with partial
(map-side) aggregation; nothing is collected except where noted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def headcount(df: DataFrame, person: str, by: Sequence[str], approx: bool = False, out: str = "headcount") -> DataFrame:
    """Distinct persons per group (A1).  Null group keys are dropped (pandas
    ``groupby`` parity); ``approx=True`` uses HyperLogLog++."""
    keep = df
    for b in by:
        keep = keep.filter(F.col(b).isNotNull())
    cnt = F.approx_count_distinct(person) if approx else F.count_distinct(F.col(person))
    return keep.groupBy(*by).agg(cnt.alias(out))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (),
                    prefix: str = "n_", approx: bool = False) -> DataFrame:
    """Distinct count of every (or each listed) column, per group or overall (A2, A3).

    Exact counts of many columns shuffle every row once per column;
    ``approx=True`` keeps one HyperLogLog++ sketch per group and column
    instead (about 2 % relative error) and shuffles only those.
    """
    cols = [c for c in (columns or df.columns) if c not in by]
    count = (lambda c: F.approx_count_distinct(c, 0.02)) if approx else F.count_distinct
    return df.groupBy(*by).agg(*[count(F.col(c)).alias(prefix + c) for c in cols])


def sample_n(df: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """``n`` random rows (all of them if there are fewer) (L3): the rows with
    the smallest random numbers.  Each task keeps its ``n`` smallest only."""
    out = df.withColumn("__rand", F.rand(seed)).orderBy("__rand").limit(n)
    return out.drop("__rand")


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Counts per value, nulls dropped, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.col(out).desc(), F.col(col).asc()))


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: non-null count, null count, any-null flag, type (A10).

    One aggregate pass; the result is reshaped to one row per column.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(F.col(f"`{c}`")).alias(f"__c{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                 F.col(f"__c{i}").alias("non_null"))
        for i, c in enumerate(df.columns)
    ])
    return (wide.select("__rows", F.inline(rows))
            .select("column", "dtype", "non_null",
                    (F.col("__rows") - F.col("non_null")).alias("nulls"),
                    (F.col("__rows") > F.col("non_null")).alias("any_null")))


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str], bits: int = 14) -> DataFrame:
    """One row per ``by`` group with ``rows`` and, for each column, a mergeable
    sketch of its distinct values (``<column>_sketch``), to be stored as a table (A1, A3).

    :func:`sketch_rollup` merges the rows for any coarser grouping, so distinct
    counts by month, region or both never scan the detail again.  A sketch
    takes at most about ``2 ** bits`` bytes; its standard error is 1.04 /
    sqrt(2 ** bits), 0.8 % at 14 bits.  Nulls don't count as values; a column
    is taken as text.
    """
    aggs = [F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), bits).alias(f"{c}_sketch") for c in columns]
    return df.groupBy(*[F.col(f"`{b}`") for b in by]).agg(F.count(F.lit(1)).alias("rows"), *aggs)


def sketch_rollup(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``rows`` and ``n_<column>``, the estimated distinct values, from stored sketches."""
    names = [c for c in sketches.columns if c.endswith("_sketch")]
    aggs = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.col(f"`{c}`"))), F.lit(0)).alias("n_" + c[: -len("_sketch")]) for c in names]
    return sketches.groupBy(*[F.col(f"`{b}`") for b in by]).agg(F.sum("rows").alias("rows"), *aggs)


def prefix_counts(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str, name: str = "prefix",
                  partitions: int | None = None) -> DataFrame:
    """Running totals inside groups without ordering a group in one task.

    Adds ``__start`` (total ``weight`` of the rows before the row in its ``by``
    group, ascending on ``order`` with nulls first) and ``__n`` (the group's
    total).  Rows should be unique on ``by + order``.

    1. the rows are range-partitioned on (group, order) and written once to the
       shared checkpoint folder, which pins each row's partition id: a group's
       rows now lie in consecutive, balanced segments (one per partition);
    2. per-segment totals (at most groups + partitions rows) give each segment
       its offset inside its group;
    3. a running total inside each (group, segment) plus the offset gives
       every row its position, so a group holding most rows is spread over
       many balanced tasks.
    """
    from ..session import cut_lineage

    by, order = list(by), list(order)
    q = lambda c: F.col(f"`{c}`")  # noqa: E731  (names, not paths)
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n_parts, *[q(c) for c in by + order])
                         .withColumn("__pid", F.spark_partition_id()), name)
    seg_keys = [f"__s_{i}" for i in range(len(by))]
    seg = ranged.groupBy(*[q(b).alias(s) for b, s in zip(by, seg_keys)], F.col("__pid").alias("__s_pid")).agg(
        F.sum(weight).alias("__seg"))
    seg_order = Window.partitionBy(*seg_keys).orderBy("__s_pid")
    seg = (seg.withColumn("__off", F.coalesce(F.sum("__seg").over(seg_order.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)))
           .withColumn("__n", F.sum("__seg").over(Window.partitionBy(*seg_keys))))
    cond = F.col("__pid") == F.col("__s_pid")
    for b, s in zip(by, seg_keys):
        cond = cond & q(b).eqNullSafe(F.col(s))
    within = Window.partitionBy(*[q(b) for b in by], "__pid").orderBy(*[q(c) for c in order])
    end = F.col("__off") + F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (ranged.join(seg, cond, "inner")
            .withColumn("__start", end - F.col(weight))
            .drop("__pid", "__s_pid", "__seg", "__off", *seg_keys))


def exact_quantiles(df: DataFrame, measure: str, probs: Sequence[float], by: Sequence[str] = (),
                    partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (the ``percentile`` /
    ``quantile_cont`` definition), distributed even when one group holds most rows.

    1. rows are counted per (group, value) -- a partial aggregate;
    2. :func:`prefix_counts` gives every value its rank range inside its group
       (range-partitioned segments, so no task ever sorts a whole group);
    3. the two ranks around ``p * (n - 1)`` are picked with a conditional
       ``max`` and interpolated.

    Output: ``by..., n, q0, q1, ...`` (one ``q`` per probability).
    """
    counts = (df.filter(F.col(measure).isNotNull())
              .groupBy(*by, F.col(measure).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__c")))
    ranked = prefix_counts(counts, by, ["__v"], "__c", "quantiles", partitions)
    ranked = ranked.withColumn("__end", F.col("__start") + F.col("__c"))
    aggs = [F.max("__n").alias("n")]
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("__n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when((F.col("__start") <= lo) & (lo < F.col("__end")), F.col("__v"))).alias(f"__lo{i}"),
                 F.max(F.when((F.col("__start") <= hi) & (hi < F.col("__end")), F.col("__v"))).alias(f"__hi{i}"),
                 F.max(pos).alias(f"__pos{i}")]
    picked = ranked.groupBy(*by).agg(*aggs)
    outs = []
    for i in range(len(probs)):
        lo_v, hi_v, pos = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__pos{i}")
        lo, hi = F.floor(pos), F.ceil(pos)
        outs.append(F.when(lo == hi, lo_v).otherwise((hi - pos) * lo_v + (pos - lo) * hi_v).alias(f"q{i}"))
    return picked.select(*by, "n", *outs)


def five_number_summary(df: DataFrame, measure: str, by: Sequence[str] = (), exact: bool = True,
                        accuracy: int = 10000) -> DataFrame:
    """n, min, q1, median, q3, max per group (A12; the box-plot figures as a table).

    ``exact=True``: :func:`exact_quantiles` (range-partitioned prefix counts; a hot
    group is spread over many tasks).
    ``exact=False``: ``percentile_approx`` (one pass, bounded memory per group).
    """
    if exact:
        q = exact_quantiles(df, measure, [0.0, 0.25, 0.5, 0.75, 1.0], by)
        return q.select(*by, "n", F.col("q0").alias("min"), F.col("q1").alias("q1"), F.col("q2").alias("median"),
                        F.col("q3").alias("q3"), F.col("q4").alias("max"))
    probs = F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])
    agg = df.groupBy(*by).agg(F.count(F.col(measure)).alias("n"), F.min(measure).alias("min"),
                              F.percentile_approx(F.col(measure), probs, accuracy).alias("__q"),
                              F.max(measure).alias("max"))
    return agg.select(*by, "n", "min", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
                      F.col("__q")[2].alias("q3"), "max")


def span_of_control(df: DataFrame, person: str, manager: str, by: Sequence[str] = (), out: str = "span") -> DataFrame:
    """Distinct direct reports per manager put on the manager's own rows (A9, J5);
    null (not 0) for persons with no reports."""
    reports = (df.filter(F.col(manager).isNotNull())
               .groupBy(*[F.col(b).alias(f"__g_{b}") for b in by], F.col(manager).alias("__mgr"))
               .agg(F.count_distinct(F.col(person)).alias("__span")))
    cond = F.col(person) == F.col("__mgr")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"__g_{b}"))
    j = df.join(reports, cond, "left")
    return j.select(*[F.col(f"`{c}`") for c in df.columns], F.col("__span").alias(out))
