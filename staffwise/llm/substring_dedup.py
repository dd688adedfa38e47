"""Substring dedup by hashing lines.

A text is cut into units: its lines, and within a line also after sentence
marks, so that a passage pasted into the middle of a line is found too; the
units of a text, joined, are the text.  Units are normalised and hashed; the
digests are grouped globally and of equal units the earliest ranked occurrence
(smallest document id, then text hash, then place) is kept.  Repeated units
that follow each other form a run, and a run of at least ``min_words`` words
is removed; with ``whole_lines`` a line that repeats an earlier line as a whole
goes whatever its length.  Offsets refer to the original text.

Only digests are shuffled, never texts.  The count per digest is combined on
the map side and joined back, so a unit that occurs in a third of all texts
costs one row per task and a join partition that can be split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import col, fresh

UNIT = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
BATCH = 200_000  # units that a task holds before it passes them on


def normalised(unit: str) -> str:
    """Lower case, white space collapsed."""
    return " ".join(unit.lower().split())


def units(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, normalised unit) of the units that are not blank."""
    return [(m.start(), m.end(), n) for m in UNIT.finditer(text or "") if (n := normalised(m[0]))]


def lines(text: str | None) -> list[tuple[int, int, int, int, str]]:
    """(first unit, number of units, start, end, normalised line) of the lines that are not blank."""
    out, unit, n, start, end = [], 0, 0, 0, 0
    for m in UNIT.finditer(text or ""):
        if m[0].strip():
            start, end, n = (start if n else m.start()), m.end(), n + 1
        if n and ("\n" in m[0] or m.end() == len(text)):
            out.append((unit, n, start, end, normalised(text[start:end])))
            unit, n = unit + n, 0
    return out


def unit_table(df: DataFrame, id_col: str, text: str, whole_lines: bool = False) -> DataFrame:
    """``(id, text_hash, unit, start, end, words, line, h, g)``; ``h`` and ``g`` are
    96 bits of digest, ``unit`` numbers a text's units that are not blank.
    ``line`` is 0; with ``whole_lines`` each line has a row too, with its first
    unit and, as ``line``, its number of units."""
    src = df.filter(col(text).isNotNull()).select(col(id_col).alias("id"), F.xxhash64(col(text)).alias("text_hash"),
                                                  col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "text_hash", "unit", "start", "end", "words", "line", "h", "g"]
        for b in batches:
            rows: list[tuple[int, int, int, int, int, int]] = []
            digests: list[bytes] = []

            def made() -> pa.RecordBatch:
                i, k, s, e, w, c = np.array(rows, np.int64).reshape(-1, 6).T
                d = np.frombuffer(b"".join(digests), np.dtype([("h", "<i8"), ("g", "<i4"), ("rest", "<i4")]))
                at = pa.array(i)
                ints = [pa.array(x.astype(np.int32)) for x in (k, s, e, w, c)]
                return pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *ints, pa.array(d["h"].copy()), pa.array(d["g"].copy())],
                                                  names=names)

            for i, t in enumerate(b.column(2)):
                t = t.as_py()
                found = [(k, s, e, n, 0, n) for k, (s, e, n) in enumerate(units(t))]
                found += [(k, s, e, n, c, "\n" + n) for k, c, s, e, n in lines(t)] if whole_lines else []
                for k, s, e, n, c, hashed in found:
                    rows.append((i, k, s, e, n.count(" ") + 1, c))
                    digests.append(xxhash.xxh3_128_digest(hashed))
                    if len(rows) >= BATCH:
                        yield made()
                        rows, digests = [], []
            if rows:
                yield made()

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text_hash long, unit int, start int, end int, words int, line int, h long, g int")


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 15, whole_lines: bool = False) -> DataFrame:
    """Runs to remove: ``(id, text_hash, start, end, n_units, n_words, kept_id, kept_start)``.

    ``start`` and ``end`` are offsets in characters of the original text;
    ``kept_id`` and ``kept_start`` give the kept occurrence of the run's first
    unit.  With ``whole_lines`` the units of a shorter run that make up repeated
    whole lines are returned too.  A unit that a text repeats within itself counts too.  Rows equal in
    id and text are one document; a null id ranks first; a null or empty text has
    no units.
    """
    unit = cut_lineage(unit_table(df, id_col, text, whole_lines), "units")
    rank = F.struct("id", "text_hash", "unit", "start")
    first = unit.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("first")).filter("n > 1").select("h", "g", "first")
    first = cut_lineage(first, "repeated-units")  # written, so that a frequent unit's partition of the join can be split
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("unit") == F.col("first.unit"))
    again = unit.join(first, ["h", "g"]).filter(~same).select(
        "id", "text_hash", "unit", "start", "end", "words", "line", F.col("first.id").alias("kept_id"), F.col("first.start").alias("kept_start"))
    if whole_lines:  # a line's row marks its units, which are repeated themselves
        mine = lambda c: F.when(F.col("line") == 0, F.col(c)).alias(c)
        own = ["start", "end", "words", "kept_id", "kept_start"]
        again = again.select("id", "text_hash", *[mine(c) for c in own], (F.col("line") > 0).alias("whole"),
                             F.explode(F.sequence("unit", F.col("unit") + F.greatest(F.col("line") - 1, F.lit(0)))).alias("unit"))
        again = (again.repartition("id", "text_hash").groupBy("id", "text_hash", "unit")
                 .agg(*[F.max(c).alias(c) for c in own], F.max("whole").alias("whole")).filter("start IS NOT NULL"))
    else:
        again = again.drop("line").withColumn("whole", F.lit(False)).repartition("id", "text_hash").distinct()  # equal rows; the runs need the same partitioning
    place = Window.partitionBy("id", "text_hash").orderBy("unit")
    runs = again.withColumn("run", F.col("unit") - F.row_number().over(place))
    if whole_lines:  # what goes of a short run are its whole lines
        runs = (runs.withColumn("long", F.sum("words").over(Window.partitionBy("id", "text_hash", "run")) >= min_words)
                .filter("long OR whole").withColumn("run", F.col("unit") - F.row_number().over(place)))
    return (runs.groupBy("id", "text_hash", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).cast("int").alias("n_units"),
                 F.sum("words").cast("int").alias("n_words"), F.min(F.struct("unit", "kept_id", "kept_start")).alias("k"))
            .filter(F.lit(whole_lines) | (F.col("n_words") >= min_words))
            .select("id", "text_hash", "start", "end", "n_units", "n_words", "k.kept_id", "k.kept_start"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 15, spans: str = "removed_spans",
                   whole_lines: bool = False) -> DataFrame:
    """``df`` with the repeated runs cut out of ``text`` and their original
    offsets added as ``spans``, an array of (start, end), empty where nothing
    went (a column of that name is replaced)."""
    kept = [c for c in df.columns if c.lower() != spans.lower()]
    a, b, c = fresh(df, "cut_id", "cut_hash", "cut_spans")
    cuts = (repeated_spans(df, id_col, text, min_words, whole_lines).groupBy("id", "text_hash")
            .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")).toDF(a, b, c))
    joined = df.join(cuts, col(id_col).eqNullSafe(F.col(a)) & (F.xxhash64(col(text)) == F.col(b)), "left")
    cut = F.col(c)
    begins = F.concat(F.array(F.lit(0)), F.transform(cut, lambda s: s["end"]))
    ends = F.concat(F.transform(cut, lambda s: s["start"]), F.array(F.length(col(text))))
    pieces = F.zip_with(begins, ends, lambda x, y: F.substring(col(text), x + 1, y - x))
    clean = F.when(cut.isNull(), col(text)).otherwise(F.array_join(pieces, ""))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return joined.select(*[(clean if n == text else col(n)).alias(n) for n in kept], F.coalesce(cut, empty).alias(spans))
