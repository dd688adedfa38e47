"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_only(c: Column | str) -> Column:
    """Drop every character outside 7-bit ASCII (P10)."""
    return F.regexp_replace(_c(c), r"[^\x00-\x7F]", "")


def strip_punctuation(c: Column | str) -> Column:
    """Remove characters that are neither word characters nor whitespace.

    Uses the ASCII classes: word = ``[A-Za-z0-9_]``, space = ``[ \\t\\n\\x0B\\f\\r]``.
    """
    return F.regexp_replace(_c(c), r"[^A-Za-z0-9_ \t\n\x0B\f\r]", "")


def clean_upper(c: Column | str) -> Column:
    """``upper(trim(c))``."""
    return F.upper(F.trim(_c(c)))


def split_first(c: Column | str, sep: str) -> tuple[Column, Column]:
    """Split on the first ``sep`` into (head, rest); rest null when no separator.

    ``sep`` is literal text, not a pattern.
    """
    parts = F.split(_c(c), _quote(sep), 2)
    return F.get(parts, 0), F.get(parts, 1)


def last_part(c: Column | str, sep: str) -> Column:
    """Text after the last ``sep``; the whole text when absent."""
    return F.element_at(F.split(_c(c), _quote(sep)), -1)


def first_part(c: Column | str, sep: str) -> Column:
    return F.get(F.split(_c(c), _quote(sep)), 0)


def first_parts_joined(c: Column | str, sep: str, n: int = 2) -> Column:
    """First ``n`` parts re-joined with ``sep`` (T4)."""
    return F.array_join(F.slice(F.split(_c(c), _quote(sep)), 1, n), sep)


def split_to_columns(c: Column | str, sep: str, names: list[str]) -> list[Column]:
    """One column per part, missing parts null (T5)."""
    parts = F.split(_c(c), _quote(sep))
    return [F.get(parts, i).alias(name) for i, name in enumerate(names)]


def append_text(current: Column, addition: Column) -> Column:
    """``current + addition`` where null counts as empty."""
    return F.concat(F.coalesce(current, F.lit("")), F.coalesce(addition, F.lit("")))


def _quote(sep: str) -> str:
    out = []
    for ch in sep:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch)
    return "".join(out)
