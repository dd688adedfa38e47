"""Snapshot selection, dedupe, backfill and gap/streak operators.

Per-key logic is written as partial aggregates joined back on the key where
the semantics allow (W2, W4, W5, W6, J7): the aggregate combines map-side, and
the join back is a sort-merge join that adaptive execution can split when one
key is hot.  Only the sequential day logic (W7, W8) uses ordered windows, and
those run over per-day pre-aggregated rows whose count per key is bounded by
the calendar, not by the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .agg import prefix_counts
from .ordering import By, _sort_key, as_by, mixed_sort_key, pick


def month_end_snapshot(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """All rows dated on the latest date present in their month (ties kept),
    optionally per ``by`` group (W1).  Null dates form their own month and are kept.

    Plan: partial ``max(date)`` per month (map-side combined) joined back with a
    broadcast left-semi join.  The broadcast side has one row per (group, month);
    without ``by`` that is at most 12 x 9999 rows, the whole calendar domain.
    """
    month = F.date_trunc("month", F.col(date_col))
    latest = df.groupBy(*[F.col(b).alias(f"__g_{b}") for b in by], month.alias("__m")).agg(F.max(date_col).alias("__d"))
    if not by:
        latest = F.broadcast(latest)
    cond = month.eqNullSafe(F.col("__m")) & F.col(date_col).eqNullSafe(F.col("__d"))
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"__g_{b}"))
    return df.join(latest, cond, "left_semi")


def current_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows at the global latest date (F6: ``= (SELECT MAX(d))``)."""
    return df.filter(F.col(date_col) == df.select(F.max(date_col)).scalar())


def latest_attribute(df: DataFrame, key: str, value: str, order: Sequence, out: str | None = None) -> DataFrame:
    """Put each key's last non-null ``value`` (under ``order``) on all its rows."""
    out = out or value
    last = pick(df.filter(F.col(value).isNotNull() & F.col(key).isNotNull()).select(key, value, *[as_by(o).col for o in order if as_by(o).col not in (key, value)]),
                [key], order, keep="last").select(key, F.col(value).alias("__v"))
    joined = df.join(last, on=key, how="left")
    cols = [F.col("__v").alias(out) if c == out else F.col(c) for c in df.columns]
    if out not in df.columns:
        cols.append(F.col("__v").alias(out))
    return joined.select(cols)


def dedupe(df: DataFrame, subset: Sequence[str], order: Sequence, keep: str = "first") -> DataFrame:
    """Drop duplicates on ``subset`` keeping the first / last row under ``order``.
    Null keys group together, as in pandas."""
    return pick(df, subset, order, keep)


def latest_per_key(df: DataFrame, key: Sequence[str] | str, date_col: str, null_date_wins: bool = False,
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest record per key by date.

    ``null_date_wins=False``: sort descending with nulls last, keep first.
    ``null_date_wins=True``: sort ascending (nulls last), keep last, so a null
    date is chosen over any dated row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if null_date_wins:
        order = [By(date_col, True, True)] + [By(t, True, True) for t in tie_break]
        return pick(df, keys, order, keep="last")
    order = [By(date_col, False, True)] + [By(t, False, True) for t in tie_break]
    return pick(df, keys, order, keep="first")


def first_occurrence_flag(df: DataFrame, subset: Sequence[str], order: Sequence, out: str = "first_mark",
                          method: str = "aggregate", unique_order: bool = False) -> DataFrame:
    """True on exactly one row of each ``subset`` group: the first under
    ``order`` (W5).  Of rows that tie for first, any one is marked.

    ``method="aggregate"`` (default): partial ``min`` of the sort key per group
    joined back -- skew-safe.  Unless ``unique_order`` says that no two rows of
    a group tie, the rows are first written to the shared checkpoint folder
    with a row number that breaks ties.
    ``method="window"``: one pass with ``row_number``; use it when a group is
    bounded by the data model (e.g. one row per person per snapshot).
    """
    order = [as_by(o) for o in order]
    if len({o.ascending for o in order}) == 1:
        key = _sort_key(order)
        pick_first = F.max if not order[0].ascending else F.min
    else:
        key = mixed_sort_key(df, order)
        pick_first = F.min if key is not None else None
    if method == "aggregate" and pick_first is not None:
        src = df
        if not unique_order:
            src = cut_lineage(df.withColumn("__row_id", F.monotonically_increasing_id()), "marks")
            key = F.struct(key.alias("k"), F.col("__row_id").alias("r"))
        firsts = src.groupBy(*[F.col(s).alias(f"__g_{s}") for s in subset]).agg(pick_first(key).alias("__k"))
        cond = None
        for s in subset:
            c = F.col(s).eqNullSafe(F.col(f"__g_{s}"))
            cond = c if cond is None else cond & c
        joined = src.join(firsts, cond, "left")
        mark = key.eqNullSafe(F.col("__k"))
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], mark.alias(out))
    from .ordering import window_order

    w = Window.partitionBy(*subset).orderBy(*window_order(order))
    return df.withColumn(out, F.row_number().over(w) == 1)


def equals_group_max(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """True where ``col`` equals its group max; ties all true; null -> false."""
    mx = df.groupBy(F.col(key).alias("__g_key")).agg(F.max(col).alias("__mx"))
    joined = df.join(mx, F.col(key).eqNullSafe(F.col("__g_key")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         F.coalesce(F.col(col) == F.col("__mx"), F.lit(False)).alias(out))


def duplicates_only(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """All rows whose ``subset`` occurs more than once (F8, ``keep=False``)."""
    counts = (df.groupBy(*[F.col(s).alias(f"__g_{s}") for s in subset])
              .agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1"))
    cond = None
    for s in subset:
        c = F.col(s).eqNullSafe(F.col(f"__g_{s}"))
        cond = c if cond is None else cond & c
    return df.join(counts, cond, "left_semi")


# Rows of one (key, day) that may be ordered in one task; a (key, day) above it
# takes the range-partitioned prefix counts instead.
MAX_WINDOW_ROWS = 100_000


def _day_table(per_day: DataFrame, key: str) -> DataFrame:
    """One row per (key, day) with ``__n`` rows: gap to the previous day, run
    number and the rows before it in its run.  The window over a key holds at
    most one row per calendar day."""
    w = Window.partitionBy(key).orderBy("__day")
    days = (
        per_day.withColumn("__gap", F.datediff("__day", F.lag("__day").over(w)))
        .withColumn("__brk", F.when(F.col("__gap").isNull() | (F.col("__gap") > 1), 1).otherwise(0))
        .withColumn("run_id", F.sum("__brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("__before", F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    run_w = Window.partitionBy(key, "run_id")
    return days.withColumn("__base", F.col("__before") - F.min("__before").over(run_w)).select(
        F.col(key).alias("__k"), F.col("__day").alias("__d"), "__gap", "run_id", "__base")


def day_runs(df: DataFrame, key: str, day_col: str, max_window_rows: int = MAX_WINDOW_ROWS) -> DataFrame:
    """Gap and streak columns per key over days.

    Adds ``gap_days`` (days since the previous row of the key, null on the first),
    ``gap`` (``gap_days > 1``), ``run_id`` (island number per key) and ``streak``
    (0 at a run start, +1 for each following row at most one day after the
    previous; rows on the same day count as consecutive).

    No unbounded group is ever handled by one task:

    * rows are first combined to one row per (key, day) with their count, so
      the ordered window over a key has at most one row per calendar day;
    * identical rows (copies) are combined into one row with a copy count, and
      regenerated with ``posexplode`` from their count, each with its own
      streak position;
    * the distinct rows of a (key, day) are ordered by a window when no
      (key, day) holds more than ``max_window_rows`` rows (one small check
      job); otherwise they get their positions from range-partitioned prefix
      counts (:func:`staffwise.operators.agg.prefix_counts`), which spread a
      (key, day) holding most rows over many tasks.
    """
    d = F.to_date(F.col(day_col))
    cols = [F.col(f"`{c}`") for c in df.columns]
    # written once: the check, the per-day table and the positions all read it
    copies = cut_lineage(df.groupBy(*cols, d.alias("__day")).agg(F.count(F.lit(1)).alias("__copies")), "day-rows")
    per_day = copies.groupBy(key, "__day").agg(F.sum("__copies").alias("__n"))
    days = _day_table(per_day, key)
    if per_day.filter(F.col("__n") > max_window_rows).limit(1).count():
        copies = (prefix_counts(copies, [key, "__day"], list(df.columns), "__copies", "day-runs")
                  .withColumnRenamed("__start", "__prior").drop("__n"))
    else:
        within = Window.partitionBy(key, "__day").orderBy(*cols)
        copies = copies.withColumn("__prior", F.coalesce(
            F.sum("__copies").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = copies.join(days, (F.col(key).eqNullSafe(F.col("__k"))) & (F.col("__day") == F.col("__d")), "left")
    j = j.select("*", F.posexplode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("__pos", "__unused"))
    rank_in_day = F.col("__prior") + F.col("__pos")
    # the first row of a day carries the gap to the previous day; repeats have gap 0
    gap_days = F.when(rank_in_day == 0, F.col("__gap")).otherwise(F.lit(0))
    return j.select(
        *cols,
        gap_days.alias("gap_days"),
        F.coalesce(gap_days > 1, F.lit(False)).alias("gap"),
        F.col("run_id"),
        (F.col("__base") + rank_in_day).cast("int").alias("streak"),
    )


def distinct_day_runs(df: DataFrame, key: str, day_col: str) -> DataFrame:
    """``day_runs`` on the distinct (key, day) pairs only: one row per (key, day),
    so the per-day table is the whole answer (no positions inside a day)."""
    per_day = (df.select(key, F.to_date(F.col(day_col)).alias("__day")).distinct()
               .withColumn("__n", F.lit(1).cast("long")))
    days = _day_table(per_day, key)
    return days.select(
        F.col("__k").alias(key), F.col("__d").alias(day_col),
        F.col("__gap").alias("gap_days"),
        F.coalesce(F.col("__gap") > 1, F.lit(False)).alias("gap"),
        F.col("run_id"),
        F.col("__base").cast("int").alias("streak"),
    )
