"""Sort specifications turned into sort-key structs.

:func:`pick` chooses the first or last row per key with a partial
aggregate (``min_by`` / ``max_by`` over a struct key) instead of a window:
the map side combines before the shuffle, so a key holding a large share of
the rows costs one small record per map task rather than one huge sorted
window partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class By:
    """One sort key: column, direction and where nulls go (pandas default: last)."""

    col: str
    ascending: bool = True
    nulls_last: bool = True


def as_by(o) -> By:
    return o if isinstance(o, By) else By(o)


def _sort_key(order: Sequence[By]) -> Column:
    """Struct key for a one-direction order.  Ascending orders pick their first
    row with ``min`` over the key, descending orders with ``max``; the flag
    placed before each value decides where nulls fall."""
    parts = []
    for i, o in enumerate(order):
        c = F.col(o.col)
        if o.ascending:
            null_rank = c.isNull() if o.nulls_last else c.isNotNull()
        else:
            null_rank = c.isNotNull() if o.nulls_last else c.isNull()
        parts += [null_rank.alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*parts)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _ascending_form(df: DataFrame, o: By) -> tuple[Column, bool] | None:
    """A column whose ascending order equals ``o``'s order (nulls handled
    separately), or None when the type has no order-reversing map (e.g. text
    under a non-binary collation, arrays, structs)."""
    c = F.col(o.col)
    if o.ascending:
        return c, o.nulls_last
    t = df.schema[o.col].dataType
    if isinstance(t, _INTEGRAL):  # ~x = -x - 1 reverses the order without overflow
        return F.bitwise_not(c), o.nulls_last
    if isinstance(t, _FRACTIONAL):
        return -c, o.nulls_last
    if isinstance(t, T.DateType):
        return -F.unix_date(c), o.nulls_last
    if isinstance(t, T.TimestampType):
        return -F.unix_micros(c), o.nulls_last
    if isinstance(t, T.TimestampNTZType):  # zone-free micros since the epoch
        return -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c), o.nulls_last
    if isinstance(t, T.BooleanType):
        return ~c, o.nulls_last
    if _byte_ordered(t):
        # bytes reversed: hex digits complemented, then a terminator above every
        # digit, so that a text sorts after the longer texts it is a prefix of
        return F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("Z")), o.nulls_last
    return None


def _byte_ordered(t: T.DataType) -> bool:
    """Binary, or text compared by its UTF-8 bytes (the default collation)."""
    if isinstance(t, T.BinaryType):
        return True
    return isinstance(t, T.StringType) and getattr(t, "collation", "UTF8_BINARY") == "UTF8_BINARY"


def mixed_sort_key(df: DataFrame, order: Sequence[By]) -> Column | None:
    """Ascending struct key for an order with mixed directions, or None."""
    parts = []
    for i, o in enumerate(order):
        form = _ascending_form(df, o)
        if form is None:
            return None
        val, nulls_last = form
        null_rank = F.col(o.col).isNull() if nulls_last else F.col(o.col).isNotNull()
        parts += [null_rank.alias(f"n{i}"), val.alias(f"v{i}")]
    return F.struct(*parts)


def reverse(order: Sequence[By]) -> list[By]:
    return [By(o.col, not o.ascending, not o.nulls_last) for o in order]


def window_order(order: Sequence[By]) -> list[Column]:
    out = []
    for o in order:
        c = F.col(o.col)
        if o.ascending:
            out.append(c.asc_nulls_last() if o.nulls_last else c.asc_nulls_first())
        else:
            out.append(c.desc_nulls_last() if o.nulls_last else c.desc_nulls_first())
    return out


def pick(df: DataFrame, keys: Sequence[str], order: Sequence, keep: str = "first") -> DataFrame:
    """One row per ``keys``: the first (or last) under ``order``.

    This is a partial aggregate for one-direction orders, and for mixed
    directions whose descending keys are numbers, dates, timestamps, booleans
    (negated into ascending keys) or text and binary (bytes reversed); only a
    descending key of another type (or text under a non-binary collation) in a
    mixed order falls back to ``row_number`` over a window.  Include a unique
    tie-break column in ``order`` for a deterministic result.
    """
    order = [as_by(o) for o in order]
    if keep == "last":
        order = reverse(order)
    elif keep != "first":
        raise ValueError(keep)
    cols = df.columns
    if set(cols) <= set(keys):
        return df.dropDuplicates(list(keys))  # rows of a group are identical: any one will do
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    if len({o.ascending for o in order}) == 1:
        use_max = not order[0].ascending
        agg = (F.max_by if use_max else F.min_by)(row, _sort_key(order)).alias("__row")
        return df.groupBy(*keys).agg(agg).select("__row.*")
    mixed = mixed_sort_key(df, order)
    if mixed is not None:
        return df.groupBy(*keys).agg(F.min_by(row, mixed).alias("__row")).select("__row.*")
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*window_order(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
