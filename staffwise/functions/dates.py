"""Date and time functions (D1-D15).  All are Catalyst expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Date formats tried, in order, when a column's format is not
# declared (day-first first, then ISO).
DAY_FIRST = "dd/MM/yyyy"
ISO = "yyyy-MM-dd"
DEFAULT_FORMATS = (DAY_FIRST, ISO)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_shape(fmt: str) -> str | None:
    """Regex of the text a numeric datetime format can produce (``dd/MM/yyyy`` ->
    ``^\\d{1,2}/\\d{1,2}/\\d{4}$``), or None for formats with text fields."""
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch in "dMHhms":
            if ch == "M" and run >= 3:
                return None
            out.append(r"\d{1,%d}" % max(run, 2))
        elif ch in "yu":
            out.append(r"\d{%d}" % run if run != 1 else r"\d{1,4}")
        elif ch == "S":
            out.append(r"\d{1,%d}" % run)
        elif ch.isalpha():
            return None
        else:
            out.append(re.escape(fmt[i:j]))
        i = j
    return "^" + "".join(out) + "$"


def _try_formats(col: Column, formats: Sequence[str]) -> list[Column]:
    tries = []
    for fmt in formats:
        parsed = F.try_to_timestamp(col, F.lit(fmt))
        shape = format_shape(fmt)
        # only text of the right shape is handed to the parser: a failed parse is expensive
        tries.append(F.when(col.rlike(shape), parsed) if shape else parsed)
    return tries


def parse_date(c: Column | str, formats: Sequence[str] = DEFAULT_FORMATS) -> Column:
    """Text to date with the first format that fits; bad text -> null.

    One format = strict parse (D1); several = first that fits (D2, D3).
    """
    tries = [F.to_date(t) for t in _try_formats(F.trim(_c(c)), formats)]
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


# Formats that a column's dates are tried in by vote, in order of preference.
VOTED_FORMATS = (DAY_FIRST, "MM/dd/yyyy", ISO, "d-MMM-yy", "d MMM yyyy")


def format_votes(df: DataFrame, columns: Sequence[str], by: str = "_file", formats: Sequence[str] = VOTED_FORMATS) -> DataFrame:
    """``(by, column, format, n_values, n_read, chosen, tie)``: how many values of
    each text column each format reads strictly, per file (D2).

    One aggregate; the format that reads the most values is chosen (ties: the
    first of ``formats``, with ``tie`` set on all that read as many), none
    where no format reads any.  Null and blank values don't vote.
    """
    q = lambda c: F.col(f"`{c}`")
    text = {c: F.nullif(F.trim(q(c)), F.lit("")) for c in columns}
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(F.count(text[c]).alias(f"n{i}"))
        aggs += [F.count(parse_date(text[c], [f])).alias(f"r{i}_{j}") for j, f in enumerate(formats)]
    rows = []
    for i, c in enumerate(columns):
        read = [F.col(f"r{i}_{j}") for j in range(len(formats))]
        best = F.greatest(*read) if len(read) > 1 else read[0]
        first = F.array_position(F.array(*read), best)
        many = F.size(F.filter(F.array(*read), lambda r: r == best)) > 1
        rows += [F.struct(F.lit(c).alias("column"), F.lit(f).alias("format"), F.col(f"n{i}").alias("n_values"), read[j].alias("n_read"),
                          ((best > 0) & (first == j + 1)).alias("chosen"), ((best > 0) & (read[j] == best) & many).alias("tie"))
                 for j, f in enumerate(formats)]
    return df.groupBy(q(by).alias(by)).agg(*aggs).select(by, F.inline(F.array(*rows)))


def parse_by_vote(df: DataFrame, columns: Sequence[str], by: str = "_file", formats: Sequence[str] = VOTED_FORMATS,
                  votes: DataFrame | None = None) -> DataFrame:
    """``df`` with its text ``columns`` as dates, each read by the one format that
    :func:`format_votes` (or the given ``votes``) chose for it in its file; other values become null."""
    votes = format_votes(df, columns, by, formats) if votes is None else votes
    pick = [F.max(F.when(F.col("chosen") & (F.col("column") == c), F.col("format"))).alias(f"__f{i}") for i, c in enumerate(columns)]
    per = votes.groupBy(F.col(f"`{by}`").alias("__by")).agg(*pick)
    joined = df.join(per, F.col(f"`{by}`").eqNullSafe(F.col("__by")), "left")
    out = {}
    for i, c in enumerate(columns):
        read = F.lit(None).cast("date")
        for f in formats:
            read = F.when(F.col(f"__f{i}") == f, parse_date(F.col(f"`{c}`"), [f])).otherwise(read)
        out[c] = read
    return joined.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in df.columns])


def parse_timestamp(c: Column | str, formats: Sequence[str]) -> Column:
    tries = _try_formats(F.trim(_c(c)), formats)
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


def epoch_text_to_timestamp(c: Column | str) -> Column:
    """``'/Date(1704067200000)/'`` -> UTC wall-clock ``timestamp_ntz``.

    Signed millis are accepted; the result does not depend on the session zone.
    """
    digits = F.regexp_extract(_c(c), r"(-?\d+)", 1)
    ms = F.nullif(digits, F.lit("")).try_cast("bigint")
    return F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def end_of_month(c: Column | str) -> Column:
    """Last day of the month as a date."""
    return F.last_day(_c(c))


def fill_month_start(date_col: Column | str, year: Column | str, month: Column | str) -> Column:
    """Keep the date; where null use the first day of (year, month)."""
    return F.coalesce(F.to_date(_c(date_col)), F.to_date(F.try_make_timestamp(_c(year), _c(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0))))


def month_of(c: Column | str) -> Column:
    return F.month(_c(c))


def year_of(c: Column | str) -> Column:
    return F.year(_c(c))


def fiscal_label(month: Column | str, year: Column | str, start_month: int = 4, padded: bool = False) -> Column:
    """Fiscal-year label with the year starting in ``start_month``.

    Two-digit left year + right year, e.g. May 2023 -> ``'2324'``, Mar 2023 -> ``'2223'``.
    Parity mode (default) does not zero-pad: Mar 2009 -> ``'89'``, May 1999 -> ``'99100'``,
    Feb 2000 -> ``'-10'``.  ``padded=True`` gives ``'0809'`` style labels from the full year.
    Null month or year -> null.
    """
    m = _c(month)
    y = _c(year)
    if padded:
        left_year = F.when(m < start_month, y - 1).otherwise(y)
        return F.when(m.isNotNull() & y.isNotNull(),
                      F.concat(F.lpad((F.pmod(left_year, F.lit(100))).cast("string"), 2, "0"),
                               F.lpad((F.pmod(left_year + 1, F.lit(100))).cast("string"), 2, "0")))
    yy = F.pmod(y, F.lit(100))
    left = F.when(m < start_month, yy - 1).otherwise(yy)
    right = F.when(m < start_month, yy).otherwise(yy + 1)
    return F.when(m.isNotNull() & y.isNotNull(), F.concat(left.cast("string"), right.cast("string")))


def calendar_year_from_fiscal(label: Column | str, month: Column | str, start_month: int = 4, century: str = "20") -> Column:
    """Calendar year from a padded fiscal label ``'2324'`` and month (D9):
    months before the start month fall in the right-hand year."""
    lab = _c(label)
    part = F.when(_c(month) < start_month, F.substring(lab, 3, 2)).otherwise(F.substring(lab, 1, 2))
    return F.when(lab.isNotNull() & _c(month).isNotNull(), F.concat(F.lit(century), part))


def as_of(left_date: Column | str, snapshot_date: Column | str) -> Column:
    """Date to measure at: leaving date when present, else the snapshot date."""
    return F.coalesce(F.to_date(_c(left_date)), F.to_date(_c(snapshot_date)))


def age_years(birth: Column | str, asof: Column) -> Column:
    """Whole years, ``days / 365.25`` truncated; null birth or as-of -> 0."""
    days = F.datediff(asof, F.to_date(_c(birth)))
    return F.coalesce((days / F.lit(365.25)).cast("int"), F.lit(0))


def tenure_years(joined: Column | str, asof: Column) -> Column:
    """``days / 365.25`` rounded half-even to 2 places; null join date -> null."""
    days = F.datediff(asof, F.to_date(_c(joined)))
    return F.bround(days / F.lit(365.25), 2)


def month_start(c: Column | str) -> Column:
    """Truncate to the first of the month, as a date."""
    return F.to_date(F.date_trunc("month", _c(c)))


def load_stamp(instant_utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC wall-clock instant, truncated to the
    minute, as ``timestamp_ntz`` (D14).  Pass ``current_timestamp()`` (or a fixed
    instant in tests)."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), instant_utc.cast("timestamp_ntz"))
    # rebuilt from its parts: date_trunc would pass through the session zone
    return F.make_timestamp_ntz(F.year(local), F.month(local), F.dayofmonth(local), F.hour(local),
                                F.minute(local), F.lit(0))


def utc_now() -> Column:
    """The current instant as UTC wall-clock ``timestamp_ntz``, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def day_diff(end: Column | str, start: Column | str) -> Column:
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))
