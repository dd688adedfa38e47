"""Loading delimited text files with rejects.

Two passes over the files' bytes, both split across tasks however long a file
is and whatever its values hold:

1. *Facts* per split: its number of lines, whether its bytes are UTF-8, and
   where it leaves the state "inside a quoted value" if it starts outside,
   and if it starts inside.  A running combination of these over a file's
   splits says in which state each split really starts, so that newlines in
   quoted values are told from the ends of records.  The first split of a
   file also tells UTF-16 and gives the header record.
2. *Records*: every split puts its lines together to records; what a record
   has on both sides of a split's end is joined from the few fragments there.
   Records are decoded with their file's charset, their cells parsed by
   Spark's CSV functions, and each gets a status.

Records with the status ``row`` load; the others are kept apart with their
file, line, reason and raw text, so one bad record or file never ends a load.
Driver memory holds the list of files (as Spark's own listing does) and the
distinct headers, never one header per file.
"""

from __future__ import annotations

import codecs
import csv
import io
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import dedupe_names, normalise_name
from ..session import cut_lineage

MAX_HEADERS = 1_000  # distinct headers of one load

#: Reasons of rejects, as they stand in ``reason``.
TOO_MANY_CELLS, OPEN_QUOTE, UNDECODABLE, NO_HEADER = "too many cells", "quote never closed", "undecodable bytes", "no header record"

_UTF8, _UTF16, _FALLBACK = "utf-8", "utf-16", "fallback"


def _past_quote(line: bytes, at: int) -> int:
    """The place after the quote that closes a value whose text starts at ``at``; -1 if none does."""
    while True:
        at = line.find(b'"', at)
        if at < 0:
            return -1
        if line[at + 1:at + 2] != b'"':
            return at + 1
        at += 2


def scan(line: bytes, inside: bool, sep: bytes = b",") -> tuple[bool, int]:
    """Whether a quoted value is open after ``line``, and how many separators end
    a cell in it.  A quote opens a value only as a cell's first letter."""
    at, seps, n = 0, 0, len(sep)
    while True:
        if inside or line[at:at + 1] == b'"':
            at = _past_quote(line, at + (not inside))
            if at < 0:
                return True, seps
            inside = False
        nxt = line.find(sep + b'"', at)
        if nxt < 0:
            return False, seps + line.count(sep, at)
        seps += line.count(sep, at, nxt) + 1
        at = nxt + n


def _quoted(lines: pa.Array) -> np.ndarray:
    """The numbers of the lines that hold a quote."""
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))


def _utf8(lines: pa.Array) -> bool:
    try:
        lines.cast(pa.string())
        return True
    except pa.ArrowInvalid:
        return False


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """(split, whether it is new, its lines) with a split's lines in order; columns 1 and 2 name the split."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        file, block = (b.column(i).to_numpy() for i in (1, 2))
        ends = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for a, z in zip([0, *ends], [*ends, b.num_rows]):
            key = (file[a], block[a])
            yield key, key != last, b.slice(a, z - a)
            last = key


def _key(path: Column) -> Column:
    """A file's number; ``file:///x`` and ``file:/x`` are one."""
    return F.xxhash64(F.regexp_replace(path, r"^(\w+):/+", "$1:/"))


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``(line, file, block)``: lines as bytes, without their ends.  Every split is a task of its own, of one size in every read."""
    probe = spark.newSession()
    probe.conf.set("spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    probe.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return probe.read.option("lineSep", "\n").text([unquote(f) for f in files]).select(
        F.col("value").cast("binary").alias("line"), _key(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_path").alias("path"))


def _facts(lines: DataFrame, record_no: int, sep: str) -> DataFrame:
    """One row per split (see the module)."""
    mark = sep.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row: dict | None = None

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("file", pa.int64()), ("block", pa.int64()), ("path", pa.string()), ("lines", pa.int64()), ("from_out", pa.bool_()),
                ("from_in", pa.bool_()), ("utf8", pa.bool_()), ("mark", pa.string()), ("head", pa.binary()), ("head_lines", pa.int32())]))

        head: list[bytes] = []
        open_, left = False, 0
        for (file, block), new, part in _splits(batches):
            lines_ = part.column(0)
            if new:
                if row:
                    yield made()
                row = {"file": int(file), "block": int(block), "path": part.column(3)[0].as_py(), "lines": 0, "from_out": False, "from_in": True,
                       "utf8": True, "mark": None, "head": None, "head_lines": None}
                head, open_, left = [], False, record_no if block == 0 else 0
                first = lines_[0].as_py()
                if block == 0 and (first.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)) or b"\0" in first):
                    row["mark"], left = _UTF16, 0
            row["lines"] += part.num_rows
            row["utf8"] = row["utf8"] and _utf8(lines_)
            for i in _quoted(lines_).tolist():
                line = lines_[i].as_py()
                row["from_out"] = scan(line, row["from_out"], mark)[0]
                row["from_in"] = scan(line, row["from_in"], mark)[0]
            for i in range(part.num_rows):  # stops with the header
                if not left:
                    break
                line = lines_[i].as_py()
                row["head_lines"] = (row["head_lines"] or 0) + 1
                head.append(line)
                open_ = scan(line, open_, mark)[0]
                if not open_:
                    left -= 1
                    if not left:
                        row["head"] = b"\n".join(head)
                    head = []
        if row:
            yield made()

    return lines.mapInArrow(run, "file long, block long, path string, lines long, from_out boolean, from_in boolean, utf8 boolean, "
                                 "mark string, head binary, head_lines int")


def _start_states(facts: DataFrame) -> DataFrame:
    """``(file, block)`` of the splits that start inside a quoted value.

    A split either leaves one state whatever it starts with, or keeps or turns
    the state: the state before a split is that of the last settled one, turned
    as often as splits since then turn it.
    """
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    settled = F.col("from_out") == F.col("from_in")
    turns = F.sum((F.col("from_out") & ~F.col("from_in")).cast("int"))
    at = facts.withColumn("turned", turns.over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "last", F.last(F.when(settled, F.struct(F.col("from_out").cast("int").alias("state"), "turned")), ignorenulls=True).over(before)).withColumn(
        "seen", F.coalesce(F.lag("turned").over(order), F.lit(0)))
    state = F.coalesce(F.col("last.state"), F.lit(0)) + F.col("seen") - F.coalesce(F.col("last.turned"), F.lit(0))
    return at.filter(state % 2 == 1).select("file", "block", F.lit(True).alias("inside"))


def _assemble(lines: pa.Array, first: int, inside: bool, held: list[bytes], held_at: int, held_seps: int, sep: bytes):
    """Records that end in ``lines`` (numbered from ``first``): (rows, texts, line counts,
    separators) and what stays open.  ``held`` are the lines of a record begun before."""
    n = len(lines)
    seps = pc.count_substring(lines, sep.decode()).to_numpy().astype(np.int64)
    opens = np.zeros(n, bool)  # whether a value is open after the line
    state, done = inside, 0
    for i in _quoted(lines).tolist():
        opens[done:i] = state
        if state:
            seps[done:i] = 0  # in the middle of a value
        state, seps[i] = scan(lines[i].as_py(), state, sep)
        opens[i], done = state, i + 1
    opens[done:] = state
    if state:
        seps[done:] = 0
    if not held and not opens.any():
        return (first + np.arange(n), lines, np.ones(n, np.int64), seps), state, [], 0, 0
    ends = np.flatnonzero(~opens)
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    texts, rows = [], first + starts
    total = np.array([seps[a:e + 1].sum() for a, e in zip(starts, ends)], np.int64)
    count = ends - starts + 1
    for a, e in zip(starts.tolist(), ends.tolist()):
        texts.append(lines[a].as_py() if a == e else b"\n".join(x.as_py() for x in lines[a:e + 1]))
    rest = int(ends[-1]) + 1 if len(ends) else 0
    if held and len(ends):
        texts[0] = b"\n".join([*held, texts[0]])
        rows[0], total[0], count[0] = held_at, total[0] + held_seps, count[0] + len(held)
        held, held_seps = [], 0
    if rest < n:
        if not held:
            held_at = first + rest
        held = [*held, *(x.as_py() for x in lines[rest:])]
        held_seps += int(seps[rest:].sum())
    return (rows, pa.array(texts, pa.binary()), count, total), state, held, held_at, held_seps


_RECORD = ("file long, block long, row long, lines long, seps long, part string, good boolean, text string")


def _records(lines: DataFrame, sep: str, charsets: Sequence[str], whole: bool) -> DataFrame:
    """Records and fragments of records, decoded.  ``lines``: (line, file, block, charset,
    inside); ``whole``: each line is a whole file, to be decoded first.

    ``part`` is null for a record; ``open``, ``middle`` and ``close`` are the
    pieces of a record that goes over a split's end.  ``row`` is the number of
    the first line in its split.
    """
    mark = sep.encode()
    names = [f.split()[0] for f in _RECORD.split(", ")]
    types = [pa.int64()] * 5 + [pa.string(), pa.bool_(), pa.string()]

    def decoded(raw: bytes, charset: str) -> tuple[bool, str]:
        raw = raw[:-1] if raw.endswith(b"\r") else raw
        try:
            return True, raw.decode(charset)
        except UnicodeDecodeError:
            return False, raw.decode(charset, "replace")

    def batch(file: int, block: int, charset: str, rows, texts, count, seps, part: str | None = None) -> pa.RecordBatch:
        n = len(rows)
        plain = None
        if charset == _UTF8 and not pc.any(pc.ends_with(texts, "\r")).as_py():
            try:
                plain = texts.cast(pa.string())
            except pa.ArrowInvalid:
                pass
        good = pa.array(np.ones(n, bool))
        if plain is None:
            pairs = [decoded(t.as_py(), charset) for t in texts]
            good, plain = pa.array([g for g, _ in pairs], pa.bool_()), pa.array([t for _, t in pairs], pa.string())
        full = lambda v, t: pa.array([v] * n, t)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, file)), pa.array(np.full(n, block)), pa.array(np.asarray(rows, np.int64)), pa.array(np.asarray(count, np.int64)),
                                           pa.array(np.asarray(seps, np.int64)), full(part, pa.string()), good, plain], schema=pa.schema(list(zip(names, types))))

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not whole:
            yield from batches
            return
        for b in batches:  # a file's lines, as UTF-8 bytes like those of the others
            for i in range(b.num_rows):
                raw = b.column(0)[i].as_py()
                order = "utf-16" if raw[:2] in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE) else "utf-16-le" if raw[1:2] == b"\0" else "utf-16-be"
                text = raw.decode(order, "replace")
                found = pa.array([x.encode() for x in (text[:-1] if text.endswith("\n") else text).split("\n")], pa.binary())
                same = [b.column(c).take(pa.array(np.full(len(found), i))) for c in range(1, b.num_columns)]
                yield pa.RecordBatch.from_arrays([found, *same], names=b.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 0
        held: list[bytes] = []
        held_at = held_seps = 0
        state = began_inside = False
        at: tuple[int, int, str] = (0, 0, _UTF8)

        def left() -> Iterator[pa.RecordBatch]:
            if held:
                yield batch(*at, [held_at], pa.array([b"\n".join(held)], pa.binary()), [len(held)], [held_seps], "middle" if began_inside else "open")

        for (file, block), new, part in _splits(lines_of(batches)):
            if new:
                yield from left()
                at = (int(file), int(block), _UTF8 if whole else charsets[part.column(3)[0].as_py()])
                first, held, held_at, held_seps = 0, [], 0, 0
                state = began_inside = bool(part.column(4)[0].as_py())
            found, state, held, held_at, held_seps = _assemble(part.column(0), first, state, held, held_at, held_seps, mark)
            first += part.num_rows
            rows, texts, count, seps = found
            if began_inside and len(rows):  # the end of a record begun in an earlier split
                yield batch(*at, rows[:1], texts[:1], count[:1], seps[:1], "close")
                rows, texts, count, seps, began_inside = rows[1:], texts[1:], count[1:], seps[1:], False
            if len(rows):
                yield batch(*at, rows, texts, count, seps)
        yield from left()

    return lines.mapInArrow(run, _RECORD)


def _joined(pieces: DataFrame) -> DataFrame:
    """Fragments put together to records; ``part`` is null for those that are complete."""
    order = Window.partitionBy("file").orderBy("block", (F.col("part") == "open").cast("int"))
    chain = pieces.withColumn("chain", F.sum((F.col("part") == "open").cast("int")).over(order))
    closed = F.max(F.col("part") == "close").over(Window.partitionBy("file", "chain"))
    chain = chain.withColumn("closed", closed)
    one = (chain.filter("closed").groupBy("file", "chain").agg(
        F.min("block").alias("block"), F.min_by("row", "block").alias("row"), F.sum("lines").alias("lines"), F.sum("seps").alias("seps"),
        F.min("good").alias("good"), F.sort_array(F.collect_list(F.struct("block", "text"))).alias("t"))
        .select("file", "block", "row", "lines", "seps", F.lit(None).cast("string").alias("part"), "good",
                F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("text")))
    # a value that is never closed: its fragments are rejected one by one, whatever their length
    return one.unionByName(chain.filter("NOT closed").select(one.columns))


@dataclass(frozen=True)
class Load:
    """What :func:`load_delimited` found.

    ``records``: one row per record: ``file``, ``row``, ``lines``, ``status``
    (``row``, ``header``, ``blank`` or the reason of a reject), ``raw`` and the
    cells (null for other records than rows).  ``files``: one row per file with
    its ``charset``, ``lines`` and, without a header record, ``status``.
    """
    records: DataFrame
    files: DataFrame
    columns: Sequence[str] = field(default_factory=tuple)
    _facts: DataFrame | None = None

    @property
    def rows(self) -> DataFrame:
        """The good rows: the cells, ``_file`` (name) and ``_row`` (increasing within a file)."""
        return self.records.filter(F.col("status") == "row").select(*[F.col(f"cells.`{c}`").alias(c) for c in self.columns],
                                                                    F.col("file").alias("_file"), F.col("row").alias("_row"))

    @property
    def rejects(self) -> DataFrame:
        """``(file, row, reason, raw)``: what did not load; ``row`` is the number of
        the record's first line in its file, null for a file without a header."""
        bad = self.records.filter(~F.col("status").isin("row", "header", "blank"))
        before = self._facts.withColumn("before", F.coalesce(F.sum("lines").over(
            Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        at = bad.join(before.select(F.col("file").alias("f"), F.col("block").alias("b"), "before"), (F.col("fkey") == F.col("f")) & (F.col("block") == F.col("b")), "left")
        lines = at.select("file", (F.coalesce("before", F.lit(0)) + F.col("row") - F.col("block") + 1).alias("row"), F.col("status").alias("reason"), "raw")
        return lines.unionByName(self.files.filter("status IS NOT NULL").select(
            "file", F.lit(None).cast("long").alias("row"), F.col("status").alias("reason"), F.lit(None).cast("string").alias("raw")))

    @property
    def counts(self) -> DataFrame:
        """``(file, status, records, lines)``; the lines of a file add up to all it has."""
        per = self.records.groupBy("file", "status").agg(F.count(F.lit(1)).alias("records"), F.sum("lines").alias("lines"))
        none = self.files.filter("status IS NOT NULL").select("file", "status", F.lit(0).cast("long").alias("records"), "lines")
        return per.unionByName(none)


def _listed(spark: SparkSession, paths: str | Sequence[str], exclude: Iterable[str]) -> list[str]:
    skip, out = list(exclude), []
    for p in [paths] if isinstance(paths, str) else list(paths):
        found = spark.read.format("binaryFile").load(p).inputFiles()
        out += sorted(f for f in found if not any(s in f.rsplit("/", 1)[-1] for s in skip))
    out = list(dict.fromkeys(out))
    if not out:
        raise FileNotFoundError(f"no files match {paths}")
    return out


def load_delimited(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", title_line: bool = False, exclude: Iterable[str] = (),
                   normalise: bool = True, fallback: str = "cp1252") -> Load:
    """Load delimited text files, good rows and rejects apart.

    * The header is a file's first record, or its second after a title line;
      columns are matched by name over all files, missing ones are null.
    * A file is UTF-8 if all its bytes are (a byte-order mark is dropped), else
      its charset is ``fallback``.  Files with a UTF-16 mark or zero bytes in
      the first line are UTF-16; each of those is decoded by one task.
    * Values in quotes may hold separators, doubled quotes and newlines.
    * Rejected are records with more cells than the header, with bytes that
      the charset doesn't have, with a quoted value that is never closed, and
      files without a complete header record.  Records with fewer cells get
      nulls; blank lines are skipped.
    * ``exclude``: files whose names contain one of these are left out.

    Empty files have no header.  Equal headers in different files are one.
    """
    files = _listed(spark, paths, exclude)
    record_no = 2 if title_line else 1
    facts = cut_lineage(_facts(_lines(spark, files), record_no, sep), "file-facts")
    listing = spark.createDataFrame([(f,) for f in files], "path string").select(_key(F.col("path")).alias("file"), "path")
    per = (facts.groupBy("file").agg(F.min("path").alias("path"), F.sum("lines").alias("lines"), F.min("utf8").alias("utf8"), F.max("mark").alias("mark"),
                                     F.max("head").alias("head"), F.max("head_lines").alias("head_lines"))
           .withColumn("charset", F.coalesce("mark", F.when(F.col("utf8"), F.lit(_UTF8)).otherwise(F.lit(_FALLBACK)))))
    per = cut_lineage(per, "files")

    states = _start_states(facts)
    charsets = [_UTF8, _UTF16, fallback]
    number = F.when(F.col("charset") == _UTF8, 0).when(F.col("charset") == _UTF16, 1).otherwise(2)
    kind = per.select(F.col("file").alias("k_file"), number.alias("charset"))
    # both are bounded: one row per file of the listing, and per split of the read
    lines = _lines(spark, files).drop("path")
    lines = (lines.join(F.broadcast(kind), F.col("file") == F.col("k_file")).filter("charset <> 1")
             .join(F.broadcast(states.toDF("s_file", "s_block", "inside")), (F.col("file") == F.col("s_file")) & (F.col("block") == F.col("s_block")), "left")
             .select("line", "file", "block", "charset", F.coalesce("inside", F.lit(False)).alias("inside")))
    found = _records(lines, sep, charsets, False)
    wide = [unquote(r["path"]) for r in per.filter(F.col("charset") == _UTF16).select("path").collect()]
    if wide:
        content = spark.read.format("binaryFile").load(wide).select(
            F.col("content").alias("line"), _key(F.col("_metadata.file_path")).alias("file"), F.lit(0).cast("long").alias("block"),
            F.lit(1).alias("charset"), F.lit(False).alias("inside"))
        found = found.unionByName(_records(content, sep, charsets, True))
    found = cut_lineage(found, "records")
    record = found.filter("part IS NULL").unionByName(_joined(found.filter("part IS NOT NULL")))

    # header records by what their split's first records are
    first = Window.partitionBy("file").orderBy("row")
    top = (record.filter((F.col("block") == 0) & (F.col("row") < 64) & F.col("part").isNull())
           .withColumn("at", F.row_number().over(first)))
    if wide:  # (their headers are known only now)
        wide_head = top.filter(F.col("at") == record_no).join(per.filter(F.col("charset") == _UTF16).select("file"), "file").select(
            "file", F.col("text").alias("head_text"), (F.col("row") + F.col("lines")).cast("int").alias("wide_lines"))
    else:
        wide_head = spark.createDataFrame([], "file long, head_text string, wide_lines int")
    decode = _decoder(charsets)
    heads = (per.join(wide_head, "file", "left").withColumn("head_text", F.coalesce("head_text", decode(F.col("head"), number)))
             .withColumn("head_lines", F.coalesce("wide_lines", "head_lines")))
    heads = heads.withColumn("head_text", F.when(F.trim("head_text") != "", F.col("head_text")))
    heads = cut_lineage(heads.select("file", "path", "lines", "charset", "head_text", "head_lines"), "heads")
    distinct = heads.filter("head_text IS NOT NULL").groupBy("head_text").agg(F.min("path").alias("path")).limit(MAX_HEADERS + 1).collect()
    if len(distinct) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers")
    distinct.sort(key=lambda r: r["path"])
    columns: dict[str, None] = {}
    layouts = []
    for r in distinct:
        cells = next(csv.reader(io.StringIO(r["head_text"], newline=""), delimiter=sep))
        names = [normalise_name(c) for c in cells] if normalise else cells
        names = dedupe_names([n if n else "unnamed" for n in names])
        layouts.append((r["head_text"], names))
        columns.update(dict.fromkeys(names))
    columns = list(columns)
    table = spark.createDataFrame([(t, i, len(n)) for i, (t, n) in enumerate(layouts)], "h_text string, layout int, n_cells int")
    known = heads.join(F.broadcast(table), F.col("head_text") == F.col("h_text"), "left").select(
        F.col("file").alias("h_file"), "layout", "n_cells", "head_lines", F.element_at(F.split("path", "/"), -1).alias("name"))

    cells = F.lit(None).cast(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    for i, (_, names) in enumerate(layouts):
        cells = F.when(F.col("layout") == i, _parsed(F.col("text"), names, columns, sep)).otherwise(cells)
    status = (F.when((F.col("block") == 0) & (F.col("row") < F.col("head_lines")), F.lit("header"))
              .when(F.col("part").isNotNull(), F.lit(OPEN_QUOTE)).when(~F.col("good"), F.lit(UNDECODABLE))
              .when(F.trim("text") == "", F.lit("blank")).when(F.col("seps") + 1 > F.col("n_cells"), F.lit(TOO_MANY_CELLS)).otherwise(F.lit("row")))
    records = (record.join(F.broadcast(known), F.col("file") == F.col("h_file")).filter("layout IS NOT NULL")
               .withColumn("status", status)
               .select(F.col("name").alias("file"), F.col("file").alias("fkey"), "block", (F.col("block") + F.col("row")).alias("row"), "lines", "status",
                       F.when(F.col("status") == "row", F.lit(None)).otherwise(F.col("text")).alias("raw"),
                       F.when(F.col("status") == "row", cells).alias("cells")))
    name = F.element_at(F.split("path", "/"), -1)
    all_files = listing.join(heads.drop("path"), "file", "left").select(
        name.alias("file"), "charset", F.coalesce("lines", F.lit(0)).alias("lines"),
        F.when(F.col("head_text").isNull(), F.lit(NO_HEADER)).alias("status"))
    return Load(records, all_files, columns, facts)


def _decoder(charsets: Sequence[str]):
    @F.pandas_udf("string")
    def decode(raw, number):
        return raw.combine(number, lambda b, n: None if b is None else bytes(b).decode(charsets[n], "replace").rstrip("\r"))
    return decode


def _parsed(text: Column, names: Sequence[str], columns: Sequence[str], sep: str) -> Column:
    """The cells of a record under one header, as a struct of all ``columns``."""
    place = {n: f"c{i}" for i, n in enumerate(names)}
    got = F.from_csv(text, ", ".join(f"{p} string" for p in place.values()), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    none = F.lit(None).cast("string")
    return F.when(text.isNotNull(), F.struct(*[(got[place[c]] if c in place else none).alias(c) for c in columns]))
