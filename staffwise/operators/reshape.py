"""Unions and reshapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union by column name; missing columns become null; duplicates kept."""
    frames = [d for d in dfs if d is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL ``UNION``."""
    return union_by_name(*dfs).distinct()


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "variable",
         value: str = "value", value_type: str | None = None) -> DataFrame:
    """Wide to long keeping null values (R1).  Value columns are cast to a common
    type (``value_type`` or double when numeric)."""
    vt = value_type or _common_type(df, values)
    casted = df.select(*ids, *[F.col(c).cast(vt).alias(c) for c in values])
    return casted.unpivot(list(ids), list(values), var, value)


def melt_groups(df: DataFrame, ids: Sequence[str], groups: Mapping[str, Sequence[str]], var: str = "variable",
                value: str = "value", label: str = "group", value_type: str | None = None) -> DataFrame:
    """Several column groups melted in one pass, each row tagged with its group
    label (R2).  One ``unpivot`` over all columns + a literal map for the label,
    instead of one scan per group."""
    cols = [c for g in groups.values() for c in g]
    long = melt(df, ids, cols, var, value, value_type)
    label_map = F.create_map(*[x for g, cs in groups.items() for c in cs for x in (F.lit(c), F.lit(g))])
    return long.withColumn(label, F.element_at(label_map, F.col(var)))


def explode_days(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per day of ``[start, end]``.

    A reversed interval or a null bound gives one row with a null day (the
    row is kept, like pandas ``explode`` of an empty list).
    """
    s, e = F.to_date(F.col(start)), F.to_date(F.col(end))
    days = F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY")))
    return df.withColumn(out, F.explode_outer(days))


def _common_type(df: DataFrame, cols: Sequence[str]) -> str:
    types = {df.schema[c].dataType.typeName() for c in cols}
    numeric = {"integer", "long", "short", "byte", "double", "float", "decimal"}
    if types <= numeric:
        return "double"
    return "string"
