"""Identifier canonicalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Whole numbers as text: a sign, digits, and at most zeros after a point.
WHOLE = r"^\s*([+-]?\d+)(?:\.0*)?\s*$"


def whole_number(text: Column) -> Column:
    """The digits of a whole number written as text (``" 12.0 " -> "12"``); null for other text."""
    return F.nullif(F.regexp_extract(text, WHOLE, 1), F.lit(""))


def canonical_id(c: Column | str) -> Column:
    """Numeric text to integer text; anything else unchanged, null stays null.

    ``"12.0" -> "12"``, ``"00123" -> "123"``, ``"12.5" -> "12"``,
    ``"13.5" -> "14"`` (half-even), ``" 7 " -> "7"``, ``"1e3" -> "1000"``.
    Whole numbers are exact up to 38 digits; only text with a fraction or an
    exponent goes through ``double``.  ``"inf"``, ``"NaN"``, values beyond 38
    digits and text are left as they are.
    """
    col = F.col(c) if isinstance(c, str) else c
    whole = whole_number(col.cast("string"))
    rounded = F.bround(col.try_cast("double"), 0).try_cast("decimal(38,0)")
    exact = F.when(whole.isNotNull(), whole.try_cast("decimal(38,0)")).otherwise(rounded)
    return F.coalesce(exact.cast("string"), col)
