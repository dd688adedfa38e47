"""JSON payloads (S15, S16): landed API responses read by Spark's JSON
reader, record arrays exploded, nested structs flattened to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import dedupe_names
from ..session import cut_lineage, drop_cut


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested struct fields to top-level columns ``parent_child`` (json_normalize);
    names that would repeat are numbered (``a_b``, ``a_b_1``)."""
    cols: list[Column] = []
    names: list[str] = []

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref)
            names.append(sep.join(path).replace(".", sep))

    for f in df.schema.fields:
        walk(f.dataType, [f.name])
    return df.select([c.alias(n) for c, n in zip(cols, dedupe_names(names))])


def read_records(spark: SparkSession, paths, records: str | None = None, schema: T.StructType | str | None = None,
                 multi_line: bool = True) -> DataFrame:
    """Records of JSON documents: ``records`` is the dotted path of the record
    array (e.g. ``"result.records"``); each element becomes one flattened row."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    doc = r.json(paths)
    if records:
        doc = doc.select(F.explode(F.col(records)).alias("__rec")).select("__rec.*")
    return flatten(doc)


def read_pages(spark: SparkSession, paths, results: str = "d.results", next_link: str = "d.__next", multi_line: bool = True) -> DataFrame:
    """Paged payloads already landed as files: the results of every page, in
    one frame (S16).  ``_file`` and ``_next`` keep the page lineage.
    ``multi_line``: one page per file; False: one page per line."""
    doc = spark.read.option("multiLine", multi_line).json(paths)
    nxt = F.col(next_link).cast("string") if _has(doc.schema, next_link.split(".")) else F.lit(None).cast("string")
    rows = doc.select(F.col("_metadata.file_name").alias("_file"), nxt.alias("_next"),
                      F.explode_outer(F.col(results)).alias("__rec"))
    return flatten(rows.filter(F.col("__rec").isNotNull()).select("_file", "_next", "__rec.*"))


def _has(schema: T.DataType, path: list[str]) -> bool:
    """Whether a schema has the field at ``path``."""
    for name in path:
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return False
        schema = schema[name].dataType
    return True


def page_chains(pages: DataFrame, page: str = "page", next_page: str = "next") -> DataFrame:
    """``(page, chain, position, problem)``: pages in the order of their next links.

    ``chain`` is the page that the chain starts with, ``position`` counts from
    0.  ``problem`` is ``gap`` where the next link names no page, ``fork`` for a
    page that several pages link to (it starts a chain of its own) and
    ``loop`` for pages whose links go in a circle or hang on one (chain and
    position are null).  Null pages are left out; of a page that is listed
    more than once the smallest next link counts.

    List ranking by pointer doubling: every round joins each unsettled page
    to the page as far before it as is known, so rounds number the logarithm
    of the longest chain.  A round that settles nothing leaves only circles.
    Rounds are written to the shared checkpoint folder.
    """
    p = pages.select(F.col(page).alias("page"), F.col(next_page).alias("next")).filter("page IS NOT NULL").groupBy("page").agg(F.min("next").alias("next"))
    p = cut_lineage(p, "pages")
    into = p.filter("next IS NOT NULL").groupBy(F.col("next").alias("to")).agg(F.count(F.lit(1)).alias("links"), F.min("page").alias("before"))
    known = p.select(F.col("page").alias("there"))
    base = (p.join(into, F.col("page") == F.col("to"), "left").join(known, F.col("next") == F.col("there"), "left")
            .select("page", F.when(F.col("links") == 1, F.col("before")).alias("before"),
                    F.when(F.col("links") > 1, F.lit("fork")).when(F.col("next").isNotNull() & F.col("there").isNull(), F.lit("gap")).alias("problem")))
    base = cut_lineage(base, "page-links")
    # a page ``steps`` after the page ``back``; settled once ``back`` starts a chain
    state = cut_lineage(base.select("page", F.coalesce("before", "page").alias("back"), F.col("before").isNotNull().cast("long").alias("steps"),
                                    F.col("before").isNull().alias("settled")), "page-ranks")
    left = state.filter("NOT settled").count()
    while left:
        ahead = state.select(F.col("page").alias("back"), F.col("back").alias("far"), F.col("steps").alias("more"), F.col("settled").alias("done"))
        moved = state.filter("NOT settled").join(ahead, "back").select(
            "page", F.col("far").alias("back"), (F.col("steps") + F.col("more")).alias("steps"), F.col("done").alias("settled"))
        new, seen = cut_lineage(state.filter("settled").unionByName(moved), "page-ranks", {"left": F.sum((~F.col("settled")).cast("long"))})
        drop_cut(state)
        state, before, left = new, left, seen["left"] or 0
        if left == before:
            break
    return base.join(state, "page").select(
        "page", F.when(F.col("settled"), F.col("back")).alias("chain"), F.when(F.col("settled"), F.col("steps")).alias("position"),
        F.when(F.col("settled"), F.col("problem")).otherwise(F.lit("loop")).alias("problem"))
