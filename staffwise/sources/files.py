"""File sources.

Files are read as text (every column a string), so a bad value never fails the
load; types come later from a declared contract
(:mod:`staffwise.operators.contract`).
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .delimited import load_delimited


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """``(path, name, modified, length)`` of the files matching ``pattern``; the
    file contents are not read (only the metadata columns are selected).  Files of
    zero bytes are not listed: they hold no header and no rows."""
    return (spark.read.format("binaryFile").load(pattern)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                    F.col("modificationTime").alias("modified"), "length"))


def latest_file(spark: SparkSession, pattern: str) -> str | None:
    """Path of the newest file matching ``pattern``."""
    row = list_files(spark, pattern).orderBy(F.col("modified").desc(), F.col("path").desc()).select("path").first()
    return row[0] if row else None


def _same_path(path: str) -> str:
    """``file:///x`` and ``file:/x`` are one path."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def headers_of(spark: SparkSession, paths: Sequence[str], record_no: int = 1, sep: str = ",") -> dict[str, tuple[list[str], bool]]:
    """Cells of CSV record ``record_no`` (1-based) of each file, and whether the
    records up to it span more physical lines than records (quoted newlines).

    One job for all files: each file is a read task of its own, which takes
    lines from the file's start until the record is complete, however many
    lines that needs, and then stops.  Only the header cells reach the driver.
    A file that ends before the record does raises with its name.
    """
    def first_record(batches):
        path = None

        def lines():
            nonlocal path
            for b in batches:
                for value, file, start in zip(*(c.to_pylist() for c in b.columns)):
                    if start:
                        return
                    if path is None:
                        path = file
                    if file != path:
                        return
                    yield value + "\n"

        rows = csv.reader(lines(), delimiter=sep, strict=True)
        cells, error = [], None
        try:
            for _ in range(record_no):
                cells = next(rows)
        except (StopIteration, csv.Error) as exc:
            cells, error = [], str(exc) or "the file ends first"
        if path is not None:
            spanned = rows.line_num > record_no
            yield pa.RecordBatch.from_pydict({"path": [path], "cells": pa.array([cells], pa.list_(pa.string())),
                                              "spanned": [spanned], "error": pa.array([error], pa.string())})

    # a session of its own, whose reads never pack two files into one task
    probe = spark.newSession()
    probe.conf.set("spark.sql.files.openCostInBytes", probe.conf.get("spark.sql.files.maxPartitionBytes"))
    found = (probe.read.text(list(paths)).select("value", "_metadata.file_path", "_metadata.file_block_start")
             .mapInArrow(first_record, "path string, cells array<string>, spanned boolean, error string").collect())
    by_path = {_same_path(r["path"]): r for r in found}
    out = {}
    for p in paths:
        r = by_path.get(_same_path(p))
        if r is None or r["error"] or not r["cells"]:
            raise ValueError(f"no complete header record {record_no} in {p}: {(r and r['error']) or 'the file is empty there'}")
        out[p] = (list(r["cells"]), r["spanned"])
    return out


def header_of(spark: SparkSession, path: str, record_no: int = 1, sep: str = ",") -> tuple[list[str], bool]:
    """:func:`headers_of` for one file."""
    return headers_of(spark, [path], record_no, sep)[path]


def read_delimited(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", title_line: bool = False,
                   exclude: Iterable[str] = (), normalise: bool = True, encoding: str = "cp1252", rejects: str = "drop") -> DataFrame:
    """The rows of delimited text files whose header is line 1, or line 2 after a
    title line (S1, S4), as text columns matched by name.  Adds ``_file`` (file
    name, S9) and ``_row`` (increasing within a file, for keep-first/last
    dedupes; order by ``_file, _row`` across files).

    The rows of :func:`staffwise.sources.delimited.load_delimited`, which see
    for charsets (``encoding`` is its fallback for files that are not UTF-8 or
    UTF-16), quoted newlines and the records that are kept apart; take the
    load itself to see these.  A file that ends before its header record does
    raises with its name (empty files are skipped); with ``rejects="error"`` any other reject does, too.

    ``exclude``: skip files whose name contains any of these substrings (S3).
    """
    load = load_delimited(spark, paths, sep, title_line, exclude, normalise, encoding)
    bad = load.files.filter("status IS NOT NULL AND lines > 0").orderBy("file").first()
    if bad:
        raise ValueError(f"{bad['status']} in {bad['file']}: the file ends first")
    if rejects == "error" and (bad := load.rejects.first()):
        raise ValueError(f"{bad['file']}, line {bad['row']}: {bad['reason']}")
    return load.rows


def tag_by_name(df: DataFrame, rules: Mapping[str, str], out: str = "source", file_col: str = "_file") -> DataFrame:
    """Label rows by substrings of their file name, first match wins (S3)."""
    expr = None
    for sub, label in rules.items():
        cond = F.col(file_col).contains(sub)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(out, expr)


def year_month_from_name(df: DataFrame, file_col: str = "_file", year: str = "year", month: str = "month") -> DataFrame:
    """``YYYY?MM...`` file names to integer year and month columns."""
    return df.withColumns({year: F.substring(file_col, 1, 4).try_cast("int"),
                           month: F.substring(file_col, 6, 2).try_cast("int")})
