"""Flags, coercions and value maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(c: Column | str, sentinel) -> Column:
    """``nullif(c, sentinel)``."""
    return F.nullif(_c(c), F.lit(sentinel))


def override_when_contains(base: Column | str, override: Column | str, marker: str,
                           unusable: Iterable[str] = ()) -> Column:
    """Take ``override`` where ``base`` contains ``marker`` and ``override`` is usable,
    i.e. not null and containing none of ``unusable`` (P22)."""
    b, o = _c(base), _c(override)
    usable = o.isNotNull()
    for bad in unusable:
        usable = usable & ~o.contains(bad)
    return F.when(b.contains(marker) & usable, o).otherwise(b)


def present_and_not(c: Column | str, value) -> Column:
    """True when not null and different from ``value``; null -> false."""
    col = _c(c)
    return F.coalesce(col.isNotNull() & (col != F.lit(value)), F.lit(False))


def in_list(c: Column | str, values: Iterable) -> Column:
    """Membership flag, null -> false."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


def is_present(c: Column | str) -> Column:
    """Flag from null-ness."""
    return _c(c).isNotNull()


def equal_flag(a: Column | str, b: Column | str) -> Column:
    """``a == b``; null when either is null."""
    return _c(a) == _c(b)


def to_number(c: Column | str, dtype: str = "double") -> Column:
    """Text to number, bad text -> null."""
    return F.trim(_c(c)).try_cast(dtype)


def scale(c: Column | str, factor: float) -> Column:
    """Multiply by a constant, e.g. ``0.01`` for percent to fraction."""
    return _c(c) * F.lit(factor)


def bool_to_int(c: Column | str) -> Column:
    """Boolean to 0/1."""
    return _c(c).cast("int")


def map_values(c: Column | str, mapping: Mapping, key_transform=None) -> Column:
    """Look a value up in a literal map; unknown -> null."""
    lit_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    key = _c(c) if key_transform is None else key_transform(_c(c))
    return F.try_element_at(lit_map, key)


# Month names (first three letters, lower case) to month numbers.
MONTH_NUMBERS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}


def month_number(c: Column | str) -> Column:
    """``'March'``/``'mar'`` -> 3; unknown -> null."""
    return map_values(c, MONTH_NUMBERS, key_transform=lambda x: F.lower(F.substring(F.trim(x), 1, 3)))
