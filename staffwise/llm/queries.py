"""The operators applied to the driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embed_dedup, langid, packing, simhash, spelling, toxicity, warc
from .common import fold
from .decontaminate import contaminated
from .line_dedup import line_dedup
from .runs import periodic_runs
from .substring_dedup import repeated_spans
from .suffix_dedup import remove_repeated_bytes
from .url_filter import url_filter

#: The rules that the url filter's query judges by.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]

MAX_LINE_RATIO = 0.2  # a line on more than a fifth of its host's pages is boilerplate


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    spans = repeated_spans(_table(spark, sf, "documents").select("doc_id", "text"), min_words=15, whole_lines=True)
    return spans.select(F.col("id").alias("doc_id"), F.col("start").alias("start_char"), F.col("end").alias("end_char"), "n_units", "n_words",
                        F.col("kept_id").alias("kept_doc_id"), F.col("kept_start").alias("kept_start_char"))


def op2_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return url_filter(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = line_dedup(_table(spark, sf, "documents"), host="source", max_ratio=MAX_LINE_RATIO)
    return docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"), "n_removed")


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf, "documents").select("doc_id", "text"), words=4, radius=4, seed=42)
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         F.col("component").alias("component_id"))


def op5_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embed_dedup.embedding_groups(_table(spark, sf, "embeddings"), threshold=0.95)


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf, "labels"))
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return (toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", held.alias("held_out"), "score",
                                               (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.derivatives(warc.responses(_table(spark, sf, "pages")), key="page_id")


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    languages, profiles = langid.fit_profiles(docs.filter(fold(F.col("doc_id"), 3) != 1), "text", "lang")
    return (langid.predict(docs, languages, profiles, keep=["doc_id"])
            .select("doc_id", held.alias("held_out"), "lang_pred", "score"))


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    out = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    hits = contaminated(_table(spark, sf, "documents").select("doc_id", "text"), _table(spark, sf, "benchmark"),
                        shingle=5, threshold=0.8, radius=20)
    return hits.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.round("similarity", 9).alias("similarity"),
                       F.col("start").alias("start_word"), "n_words")


def _id_hash(*rest: Column) -> Column:
    """crc32 of the document id as text, with ``rest`` after it."""
    return F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *rest).cast("binary"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text", _id_hash().alias("h"))
    # every tenth document's words repeat from some place on
    g, w = F.floor(F.col("h") / 10), F.col("w")
    n = F.size("w").cast("long")
    p = F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + g % 8))
    docs = (docs.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
            .withColumn("a", F.when(n > 0, g % n)).withColumn("p", F.when(n > 0, p)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    periodic = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, at(i).cast("int"))), " ")
    docs = docs.select("doc_id", F.when(F.col("a").isNotNull(), periodic).otherwise(F.col("text")).alias("text"))
    out = periodic_runs(docs, min_exponent=4, min_length=6, keep=["doc_id"])
    higher = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]  # noqa: E731  (exactly; the runs are in order of start, then period)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, x: F.when(higher(x, b), x).otherwise(b))
    row = lambda r: F.concat(*[F.concat(r[c].cast("string"), F.lit(end)) for c, end in (("start", ","), ("length", ","), ("period", "\n"))])
    return (out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", row), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256")))


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", spelling.ascii_lower(F.col("text")).alias("text"))
    word = (docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[a-zÀ-ÿ]{6,}"), F.lit(0))).alias("run"))  # deleting a letter makes none longer
            .select("run", _id_hash(F.lit(":"), F.col("run")).alias("h")))
    at = (F.col("h") % F.length("run")).cast("int")
    typo = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    counts = (word.select(F.when(F.col("h") % 199 == 0, typo).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= 6)
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5"))
    return spelling.spelling_variants(counts, ratio=5).select("word", "form", "root", "n", "n_near", "form_n")


def op13_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = remove_repeated_bytes(_table(spark, sf, "documents").select("doc_id", "text"), length=400)
    gone = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), gone.alias("n_removed"),
                      F.size("removed_spans").cast("long").alias("n_spans"),
                      F.sha2(F.coalesce("kept", F.lit("").cast("binary")), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_line_dedup": op3_line_dedup,
    "op4_simhash": op4_simhash,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_suffix_dedup": op13_suffix_dedup,
}
