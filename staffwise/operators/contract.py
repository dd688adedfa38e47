"""Declared type contracts.

A contract is ``{column: type}`` where type is a Spark SQL type name
(``"string"``, ``"bigint"``, ``"double"``, ``"boolean"``...) or a
``DateSpec`` naming the text formats to try.  Columns absent from the frame
are skipped; bad values become null (``try_cast`` / ``try_to_timestamp``)
so ANSI mode never fails a load on dirty text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import DAY_FIRST, DEFAULT_FORMATS, ISO, parse_date, parse_timestamp
from ..functions.ids import whole_number

# Text read as boolean true / false (compared upper-cased, trimmed).
TRUE_TOKENS = ("TRUE", "T", "YES", "Y", "1")
FALSE_TOKENS = ("FALSE", "F", "NO", "N", "0")


@dataclass(frozen=True)
class DateSpec:
    formats: Sequence[str] = DEFAULT_FORMATS
    timestamp: bool = False


def typed(c: Column, spec) -> Column:
    if isinstance(spec, DateSpec):
        return parse_timestamp(c, spec.formats) if spec.timestamp else parse_date(c, spec.formats)
    t = spec.lower()
    if t in ("string", "category"):
        return c.cast("string")
    if t == "boolean":
        u = F.upper(F.trim(c.cast("string")))
        return F.when(u.isin(list(TRUE_TOKENS)), F.lit(True)).when(u.isin(list(FALSE_TOKENS)), F.lit(False))
    if t == "date":
        return parse_date(c.cast("string"))
    if t in ("int", "bigint", "long", "smallint"):
        # integers written as "12.0" or "1e3" are accepted, exactly; a fraction is bad text
        text, name = F.trim(c.cast("string")), t if t != "long" else "bigint"
        whole, number = whole_number(text), text.try_cast("double")
        return F.when(whole.isNotNull(), whole.try_cast(name)).when(number == F.floor(number), number.try_cast(name))
    return F.trim(c.cast("string")).try_cast(t)


def _already(dtype: T.DataType, spec) -> bool:
    if isinstance(spec, DateSpec):
        return isinstance(dtype, T.TimestampType if spec.timestamp else T.DateType)
    name = {"long": "bigint", "category": "string"}.get(spec.lower(), spec.lower())
    return dtype.simpleString() == name


_DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def apply_contract(df: DataFrame, contract: Mapping[str, object]) -> DataFrame:
    """Cast the columns present to their declared types; columns already of
    their type and columns absent from the frame are left alone, and date or
    timestamp columns declared as dates are converted, not re-parsed."""
    out = {}
    for c, spec in contract.items():
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        if _already(dtype, spec):
            continue
        if isinstance(spec, DateSpec) and isinstance(dtype, _DATETIME):
            out[c] = F.col(c).cast("timestamp") if spec.timestamp else F.to_date(F.col(c))
        else:
            out[c] = typed(F.col(c), spec)
    return df.withColumns(out)


def all_strings(df: DataFrame) -> DataFrame:
    """Every column as text (the raw form files arrive in)."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


#: Types in the order they are preferred in, each with its bit and the text it takes.
#: Numbers with leading zeros are ids and stay text.
_BOOLEAN, _BIGINT, _DOUBLE, _DAY_FIRST, _ISO = 1, 2, 4, 8, 16
_LATTICE = (("boolean", _BOOLEAN), ("bigint", _BIGINT), ("double", _DOUBLE), ("date", _DAY_FIRST), ("date", _ISO))


def _fits(text: Column) -> Column:
    """The bits of all types that a value fits."""
    bit = lambda cond, b: F.when(cond, F.lit(b)).otherwise(F.lit(0))
    number = text.rlike(r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$")
    whole = text.rlike(r"^[+-]?(0|[1-9][0-9]*)$") & text.try_cast("bigint").isNotNull()
    dated = F.length(text).between(8, 10)
    return (bit(F.upper(text).isin("TRUE", "FALSE"), _BOOLEAN)
            .bitwiseOR(bit(whole, _BIGINT)).bitwiseOR(bit(number & text.try_cast("double").isNotNull(), _DOUBLE))
            .bitwiseOR(bit(dated & parse_date(text, [DAY_FIRST]).isNotNull(), _DAY_FIRST))
            .bitwiseOR(bit(dated & parse_date(text, [ISO]).isNotNull(), _ISO)))


def inferred_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, type, format, n_values, n_empty)`` of text columns.

    A type lattice in one aggregate: each value gives the set of types it fits,
    as bits, and the bits that all values of a column share are what the column
    can be; the first of boolean, bigint, double, day-first date and ISO date
    wins, else it stays text.  Null and blank values fit everything; a column
    of nothing else stays text.  Every value is looked at, and only one partial
    row per task is shuffled.  Columns of other types keep theirs.
    """
    names = list(columns) if columns is not None else df.columns
    q = lambda c: F.col(f"`{c}`")
    value = {c: F.nullif(F.trim(q(c).cast("string")), F.lit("")) for c in names}
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(names):
        text = isinstance(df.schema[c].dataType, T.StringType)
        aggs += [F.count(value[c]).alias(f"n{i}"), F.bit_and(F.when(value[c].isNotNull(), _fits(value[c]) if text else F.lit(0))).alias(f"b{i}")]
    out = []
    for i, c in enumerate(names):
        kind, fmt = F.lit("string"), F.lit(None).cast("string")
        if isinstance(df.schema[c].dataType, T.StringType):
            for name, b in reversed(_LATTICE):
                has = F.coalesce(F.col(f"b{i}"), F.lit(0)).bitwiseAND(F.lit(b)) != 0
                kind = F.when(has, F.lit(name)).otherwise(kind)
                fmt = F.when(has, F.lit({_DAY_FIRST: DAY_FIRST, _ISO: ISO}.get(b)).cast("string")).otherwise(fmt)
        else:
            kind = F.lit(df.schema[c].dataType.simpleString())
        out.append(F.struct(F.lit(c).alias("column"), kind.alias("type"), fmt.alias("format"), F.col(f"n{i}").alias("n_values"),
                            (F.col("rows") - F.col(f"n{i}")).alias("n_empty")))
    return df.agg(*aggs).select(F.inline(F.array(*out)))


def infer_contract(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, object]:
    """The contract for :func:`apply_contract` that :func:`inferred_types` finds (one row per column reaches the driver)."""
    return {r["column"]: DateSpec([r["format"]]) if r["type"] == "date" and r["format"] else r["type"]
            for r in inferred_types(df, columns).collect()}
