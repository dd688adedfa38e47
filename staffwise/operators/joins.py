"""Look-ups and merges.

Broadcast policy.  By default the join strategy is left to Spark, which
broadcasts a side only when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and, with adaptive execution,
re-checks against the real shuffle size
(``spark.sql.adaptive.autoBroadcastJoinThreshold``); anything larger is a
sort-merge join whose skewed partitions adaptive execution splits.  An explicit
hint is used only for sides whose size is bounded by construction, or behind
the row-count and byte checks of :func:`bounded_broadcast` when asked for.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest reference table broadcast by the checked hint: rows, and estimated bytes.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def _row_bytes(ref: DataFrame) -> Column:
    """Estimated in-memory size of a row: 8 bytes per field plus the bytes of its
    text, binary and nested values."""
    size = F.lit(8 * (len(ref.columns) + 1))
    for f in ref.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return size


def bounded_broadcast(ref: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint when ``ref`` has at most ``max_rows`` rows and at most
    ``max_bytes`` estimated bytes, else ``ref`` as is (left to the planner).

    One aggregate pass over ``ref`` (partial per split; only two numbers reach
    the driver).
    """
    n, size = ref.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(ref)), F.lit(0))).first()
    return F.broadcast(ref) if n <= max_rows and size <= max_bytes else ref


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def lookup(df: DataFrame, ref: DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str] | None = None,
           how: str = "left", null_safe: bool = True, suffix: str = "_ref", on_duplicate: str = "expand",
           broadcast: bool | str | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Equi look-up of ``ref`` onto ``df``.

    * same key names: one key column kept (the left one); different names: both kept (J2)
    * other clashing ref columns get ``suffix`` (J3)
    * ``null_safe=True`` makes null keys match each other (pandas merge parity)
    * ``on_duplicate``: ``"expand"`` keeps the fan-out (pandas), ``"error"``
      raises if a ref key repeats, ``"first"`` keeps one ref row per key
    * ``broadcast``: ``None`` = the planner decides by size (see module notes);
      ``True`` = hint (for a side small by construction); ``"checked"`` = hint
      only if the ref has at most ``max_rows`` rows and ``BROADCAST_MAX_BYTES``
      estimated bytes
    """
    lk = _keys(left_on)
    rk = _keys(right_on) if right_on is not None else lk
    if on_duplicate == "first":
        ref = ref.dropDuplicates(rk)
    elif on_duplicate == "error":
        dup = ref.groupBy(*rk).count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"reference keys {rk} are not unique")
    same = [l for l, r in zip(lk, rk) if l == r]
    renames = {}
    for c in ref.columns:
        if c in same:
            renames[c] = f"__k_{c}"
        elif c in df.columns:
            renames[c] = c + suffix
    r = ref.withColumnsRenamed(renames) if renames else ref
    rk2 = [renames.get(c, c) for c in rk]
    if broadcast == "checked":
        r = bounded_broadcast(r, max_rows)
    elif broadcast is True:
        r = F.broadcast(r)
    cond = None
    for a, b in zip(lk, rk2):
        c = df[a].eqNullSafe(r[b]) if null_safe else (df[a] == r[b])
        cond = c if cond is None else cond & c
    out = df.join(r, cond, how)
    drop = [renames[c] for c in same]
    if how in ("left", "left_outer", "inner"):
        return out.drop(*drop)
    # outer/right: coalesce the shared key
    return out.select(*[F.coalesce(df[c], r[renames[c]]).alias(c) if c in same else df[c] for c in df.columns],
                      *[r[c] for c in r.columns if c not in drop])


def outer_merge(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Full outer join with the key coalesced."""
    return a.join(b, on=_keys(on), how="full")


def map_by_key(df: DataFrame, per_key: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Series-lookup: attach a per-key table's columns, null when absent."""
    r = per_key.withColumnRenamed(right_key or key, "__mk")
    return df.join(r, F.col(key) == F.col("__mk"), "left").drop("__mk")


def first_snapshot_rows(df: DataFrame, key: str, date_col: str) -> DataFrame:
    """Rows on each key's first snapshot date (J7); the group-min self-join as
    a partial aggregate + semi join."""
    first = df.groupBy(F.col(key).alias("__k")).agg(F.min(date_col).alias("__d"))
    return df.join(first, (F.col(key) == F.col("__k")) & (F.col(date_col) == F.col("__d")), "left_semi")


def overlay_update(base: DataFrame, updates: DataFrame, key: str | Sequence[str], on_duplicate: str = "error") -> DataFrame:
    """Right non-null values replace left values for the same key.

    Unmatched update rows and extra update columns are ignored.
    ``on_duplicate``: ``"error"`` raises if an update key repeats (one value
    per cell must win); ``"expand"`` gives a base row once per update of its key.
    """
    if on_duplicate not in ("error", "expand"):
        raise ValueError(f"on_duplicate: {on_duplicate}")
    keys = _keys(key)
    shared = [c for c in updates.columns if c in base.columns and c not in keys]
    if on_duplicate == "error" and updates.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise ValueError("update keys repeat")
    u = updates.select(*[F.col(k).alias(f"__u_{k}") for k in keys], *[F.col(c).alias(f"__u_{c}") for c in shared])
    cond = None
    for k in keys:
        c = base[k] == u[f"__u_{k}"]
        cond = c if cond is None else cond & c
    j = base.join(u, cond, "left")
    return j.select(*[F.coalesce(u[f"__u_{c}"], base[c]).alias(c) if c in shared else base[c] for c in base.columns])


def enrich_distinct(df: DataFrame, key: str, resolver: Callable, schema: T.StructType | str,
                    drop_unresolved: bool = True) -> DataFrame:
    """Resolve each distinct key once and join the result back.

    ``resolver(pdf) -> pdf`` receives a pandas frame with column ``key`` and
    returns ``key`` plus resolved columns; it runs on executors over Arrow
    batches (``mapInPandas``), so the distinct keys are spread across tasks.
    Unresolved keys (no row, or all resolved columns null) are dropped when
    ``drop_unresolved``.
    """

    def run(batches):
        for pdf in batches:
            yield resolver(pdf)

    resolved = df.select(key).filter(F.col(key).isNotNull()).distinct().mapInPandas(run, schema)
    extra = [c for c in resolved.columns if c != key]
    if drop_unresolved and extra:
        resolved = resolved.filter(" OR ".join(f"`{c}` IS NOT NULL" for c in extra))
    return df.join(resolved, on=key, how="inner" if drop_unresolved else "left")


def resolve_keys(keys: DataFrame, key: str, resolver: Callable, schema: T.StructType, store: str, tries: int = 3, pause: float = 1.0,
                 calls: int = 10, again: Sequence[str] = ()) -> DataFrame:
    """Answers for the distinct ``keys``, kept in the parquet folder ``store``.

    Keys that the store has an answer for are not asked again; the others are
    split over ``calls`` tasks, so no more than that many calls run at a time
    in the whole cluster.  ``resolver(value)`` returns a dict of the fields of
    ``schema`` (None: there is no answer) and may raise; a raise is tried again after
    ``pause`` seconds, ``tries`` times in all.  The store gets one row per new
    key: ``key``, the fields, ``status`` (``found``, ``none`` or ``failed``),
    ``tries``, ``error`` and ``at``.  ``again`` names statuses to ask anew,
    for instance ``["failed"]``; the latest row of a key counts.

    Returns the store's latest rows for ``keys``.  Null keys are left out.  A
    task that is lost asks its keys again; what was written before stays.
    """
    spark = keys.sparkSession
    wanted = keys.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct()
    full = T.StructType([T.StructField("key", wanted.schema["key"].dataType), *schema.fields,
                         *[T.StructField(n, t) for n, t in (("status", T.StringType()), ("tries", T.IntegerType()), ("error", T.StringType()), ("at", T.TimestampType()))]])
    fields = schema.names

    def ask(value):
        error = None
        for n in range(1, tries + 1):
            try:
                got = resolver(value)
                return [*[(got or {}).get(f) for f in fields], "none" if got is None else "found", n, None]
            except Exception as exc:  # noqa: BLE001  (a failing key is reported, not the end of the run)
                error = f"{type(exc).__name__}: {exc}"
                if n < tries:
                    time.sleep(pause)
        return [*[None] * len(fields), "failed", tries, error]

    def run(batches):
        for pdf in batches:
            rows = [[v, *ask(v), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)] for v in pdf["key"].tolist()]
            yield pd.DataFrame(rows, columns=full.names)

    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    new = wanted
    if exists:
        known = _latest_answers(spark.read.schema(full).parquet(store)).filter(~F.col("status").isin(list(again)))
        new = wanted.join(known, "key", "left_anti")
    answers = new.repartition(calls).mapInPandas(run, full)
    answers.write.mode("append").parquet(store)
    return _latest_answers(spark.read.schema(full).parquet(store)).join(wanted, "key", "left_semi")


def _latest_answers(store: DataFrame) -> DataFrame:
    rest = [c for c in store.columns if c != "key"]
    last = store.groupBy("key").agg(F.max_by(F.struct(*rest), F.struct("at", "tries")).alias("a"))
    return last.select("key", *[F.col(f"a.`{c}`").alias(c) for c in rest])
