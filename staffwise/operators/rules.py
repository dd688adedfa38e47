"""Declarative data-quality rules and reports (Q1-Q4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Label appended when ``when`` holds (always, if None) and any of ``required`` is blank."""

    label: str
    required: Sequence[str]
    when: Column | str | None = None


def blank(c: str) -> Column:
    """Null, or text that is empty after trimming."""
    col = F.col(c)
    return col.isNull() | (F.trim(col.cast("string")) == F.lit(""))


def rule_hit(rule: Rule) -> Column:
    any_blank = None
    for c in rule.required:
        any_blank = blank(c) if any_blank is None else any_blank | blank(c)
    cond = any_blank if any_blank is not None else F.lit(False)
    if rule.when is not None:
        w = F.expr(rule.when) if isinstance(rule.when, str) else rule.when
        cond = F.coalesce(w, F.lit(False)) & cond
    return cond


def apply_rules(df: DataFrame, rules: Sequence[Rule], out: str = "error", sep: str = "; ",
                trailing_sep: bool = True) -> DataFrame:
    """Add ``out``: the labels of all rules that fire, in rule order; null when none (Q1).

    ``trailing_sep=True`` writes each label followed by ``sep`` (``'Cat A error; '``),
    the form of the original reports; otherwise labels are joined by ``sep``.
    """
    if trailing_sep:
        parts = [F.when(rule_hit(r), F.lit(r.label + sep)) for r in rules]
        text = F.concat_ws("", *parts)
    else:
        parts = [F.when(rule_hit(r), F.lit(r.label)) for r in rules]
        text = F.concat_ws(sep, *parts)
    return df.withColumn(out, F.nullif(text, F.lit("")))


def error_report(df: DataFrame, by: Sequence[str], error: str = "error", out: str = "n_errors") -> DataFrame:
    """Rows with an error counted by ``by`` + error text (Q2)."""
    return (df.filter(F.col(error).isNotNull()).groupBy(*by, error)
            .agg(F.count(F.col(error)).alias(out)))


def error_list(df: DataFrame, columns: Sequence[str], error: str = "error") -> DataFrame:
    """Chosen columns of the rows with an error (Q3)."""
    return df.filter(F.col(error).isNotNull()).select(*columns, error)


def validation_table(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Named aggregate checks evaluated in one pass, returned as ``(check, value)`` rows (Q4)."""
    wide = df.agg(*[c.cast("double").alias(f"__q{i}") for i, c in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"__q{i}").alias("value"))
                     for i, name in enumerate(checks)])
    return wide.select(F.inline(rows))
