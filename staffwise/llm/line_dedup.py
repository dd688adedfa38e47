"""Line dedup by site-relative frequency.

Per host, the share of pages that contain a line; a line on more than
``max_ratio`` of its host's pages is boilerplate and is dropped from them.
Only line digests are counted, combined on the map side.  A host has fewer
than (mean lines of its pages / max_ratio) boilerplate lines, so the list
stays short however many pages the host has.

Lines meet the list by a hashed join on (host, digest); what comes back is one
row per text with the places of its boilerplate lines, so the work on a page
grows in proportion to its lines, however many of them are boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import col, fresh, let

BROADCAST_LINES = 500_000  # digests of boilerplate lines that are broadcast; more are joined by a shuffle


def _clean(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"[ \t\r\f]+", " "))


def _digest(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"))


def boilerplate_lines(df: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.2,
                      min_pages: int = 1, equal_texts_once: bool = False) -> DataFrame:
    """``(host, h, g)``: digests of each host's boilerplate lines.

    Every row with a host is a page, null texts too; a page counts once for a
    line it repeats.  Lines compare with blank runs collapsed; blank lines and
    pages without a host are left out.  ``min_pages``: a line on fewer pages is
    not boilerplate.  ``equal_texts_once``: rows of a host with equal texts are
    one page.
    """
    pages = df.filter(col(host).isNotNull()).select(col(host).alias("host"), F.xxhash64(col(text)).alias("page"), col(text).alias("text"))
    lines = F.array_distinct(F.transform(F.filter(F.transform(F.split("text", "\n"), _clean), lambda x: x != ""), _digest))
    on = pages.select("host", "page", F.explode(lines).alias("line"))
    if equal_texts_once:
        on, pages = on.distinct(), pages.select("host", "page").distinct()
    seen = on.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    return seen.join(totals, "host").filter(F.col("pages") > F.lit(max_ratio) * F.col("total")).select("host", "line.h", "line.g")


def line_dedup(df: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.2, min_pages: int = 1,
               equal_texts_once: bool = False, removed: str | None = "n_removed") -> DataFrame:
    """``df`` with boilerplate lines dropped from ``text``.

    Kept lines and their order are untouched; a page of nothing but
    boilerplate becomes the empty text, so the only page of a host does.  Null
    texts stay null, pages without a host stay as they are.  ``removed`` names
    a count of dropped lines that is added (replacing a column of that name;
    None: not added).  ``min_pages`` and ``equal_texts_once``: see
    :func:`boilerplate_lines`.
    """
    common, seen = cut_lineage(boilerplate_lines(df, host, text, max_ratio, min_pages, equal_texts_once), "boilerplate", {"n": F.count(F.lit(1))})
    if seen["n"] <= BROADCAST_LINES:
        common = F.broadcast(common)
    t1, t2 = F.xxhash64(col(text)), F.hash(col(text))
    a, b, c, at = fresh(df, "bp_host", "bp_text", "bp_check", "bp_lines")
    line = (df.filter(col(host).isNotNull() & col(text).isNotNull())
            .select(col(host).alias("host"), t1.alias("t1"), t2.alias("t2"), F.posexplode(F.split(col(text), "\n")).alias("i", "x"))
            .select("host", "t1", "t2", "i", _digest(_clean(F.col("x"))).alias("d")).select("host", "t1", "t2", "i", "d.h", "d.g"))
    gone = line.join(common, ["host", "h", "g"]).groupBy("host", "t1", "t2").agg(F.sort_array(F.collect_set("i")).alias("i")).toDF(a, b, c, at)
    joined = df.join(gone, (col(host) == F.col(a)) & (t1 == F.col(b)) & (t2 == F.col(c)), "left")
    cut = F.col(at)

    def others(lines: Column) -> Column:  # the lines between two dropped ones, each line taken once
        begins = F.concat(F.array(F.lit(0)), F.transform(cut, lambda i: i + 1))
        ends = F.concat(cut, F.array(F.size(lines)))
        return F.array_join(F.flatten(F.zip_with(begins, ends, lambda x, y: F.slice(lines, x + 1, y - x))), "\n")
    out = {text: F.when(cut.isNotNull(), let(F.split(col(text), "\n"), others)).otherwise(col(text))}
    if removed:
        out[removed] = F.coalesce(F.when(cut.isNotNull(), F.size(cut)), F.lit(0))
    names = [n for n in df.columns if not removed or n.lower() != removed.lower()]
    return joined.select(*[(out[n] if n in out else col(n)).alias(n) for n in names],
                         *([out[removed].alias(removed)] if removed else []))
