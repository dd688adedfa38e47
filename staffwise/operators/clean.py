"""Projection and cleaning operators (P1-P19).  Every function is
``DataFrame -> DataFrame`` and only adds narrow (non-shuffling) work, except
the opt-in null-column profile (P4/P5) which runs one aggregate pass."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import canonical_id
from ..functions.names import dedupe_names, normalise_name
from ..functions.text import ascii_only


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalise_columns(df: DataFrame, dedupe: bool = True) -> DataFrame:
    """Clean every column name (P1); repeated names get ``_1``, ``_2``."""
    names = [normalise_name(c) for c in df.columns]
    if dedupe:
        names = dedupe_names(names)
    return df.toDF(*names)


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = ("",), columns: Iterable[str] | None = None) -> DataFrame:
    """Turn NA tokens (after trimming) into null in string columns."""
    cols = set(columns) if columns is not None else set(string_columns(df))
    toks = list(tokens)
    return df.select([
        F.when(F.trim(F.col(c)).isin(toks), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every value is null."""
    return df.dropna(how="all")


def drop_rows_with_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in ``subset`` (or any column)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def null_counts(df: DataFrame) -> dict[str, tuple[int, int]]:
    """One aggregate pass: ``{column: (non_null, rows)}``.  Only counts reach the driver."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return {c: (row[f"c{i}"], row["__rows"]) for i, c in enumerate(df.columns)}


def drop_null_columns(df: DataFrame, how: str = "all") -> DataFrame:
    """Drop columns that are entirely null (``how='all'``, P4) or have any null
    (``how='any'``, P5).  The schema depends on the data, so this runs a job."""
    counts = null_counts(df)
    if how == "all":
        keep = [c for c, (nn, _) in counts.items() if nn > 0]
    elif how == "any":
        keep = [c for c, (nn, rows) in counts.items() if nn == rows]
    else:
        raise ValueError(how)
    return df.select([F.col(f"`{c}`") for c in keep])


# Characters trimmed from both ends of text (Python's whitespace set, ASCII part).
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c) -> "F.Column":
    """Remove leading/trailing whitespace (space, tab, newline, CR, VT, FF)."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(WHITESPACE))


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip whitespace from both ends of every string column."""
    s = set(string_columns(df))
    return df.select([strip_ws(c).alias(c) if c in s else F.col(c) for c in df.columns])


def upper_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``upper(trim(c))`` on chosen / all string columns."""
    s = set(columns) if columns is not None else set(string_columns(df))
    return df.select([F.upper(strip_ws(c)).alias(c) if c in s else F.col(c) for c in df.columns])


def ascii_strings(df: DataFrame) -> DataFrame:
    """Strip non-ASCII characters from every string column (P10)."""
    s = set(string_columns(df))
    return df.select([ascii_only(c).alias(c) if c in s else F.col(c) for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names not present are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select the listed columns that exist, in list order."""
    have = set(df.columns)
    return df.select([c for c in columns if c in have])


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop columns whose name matches ``pattern``."""
    rx = re.compile(pattern)
    return df.select([c for c in df.columns if not rx.search(c)])


def tag(df: DataFrame, **constants) -> DataFrame:
    """Constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls per column with constants."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if c in df.columns})


def fill_from(df: DataFrame, target: str, source: str) -> DataFrame:
    """Fill nulls in ``target`` from ``source``, cast to the target's type."""
    t = df.schema[target].dataType
    return df.withColumn(target, F.coalesce(F.col(target), F.col(source).cast(t)))


def add_placeholders(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add typed all-null columns that are missing."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def canonicalise_ids(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Apply :func:`canonical_id` to the id columns present."""
    return df.withColumns({c: canonical_id(c) for c in columns if c in df.columns})
