"""Corpus pipeline: the stages a document passes before training.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written and read again as the next one's
``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffwise.llm import packing, simhash, toxicity
from staffwise.llm.decontaminate import decontaminate
from staffwise.llm.line_dedup import line_dedup
from staffwise.llm.queries import MAX_LINE_RATIO
from staffwise.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (6): documents that the classifier rejects go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, out="__toxicity").filter(F.col("__toxicity") < 0.5).select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (3): lines on too many of a source's documents go."""
    return (line_dedup(docs, host="source", max_ratio=MAX_LINE_RATIO, removed=None)
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (4): the document with the smallest id of each group stays."""
    return simhash.simhash_dedup(docs, words=4, radius=4, seed=42).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (10): documents that hold an item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), shingle=5, threshold=0.8, radius=20).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing (9): token ids of every piece and its place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The trained classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written to the
    shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
