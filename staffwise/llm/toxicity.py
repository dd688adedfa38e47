"""Toxicity by non-negative positive-unlabelled learning.

A linear model over words and word beginnings is fitted in numpy from
confirmed toxic texts (P) and unlabelled texts (U) with the class-prior
corrected risk

    pi * R_P(+)  +  max(0, R_U(-) - pi * R_P(-))

and scored over all texts in Spark.  Labels of 0 serve for the prior only,
where none is given: the texts that have them are unlabelled ones.

The fit is bounded: at most ``max_positive`` and ``max_unlabelled`` sampled
texts, in the order of a hash of their id, one row per id.  All features that
pass the test are kept.  Feature counts over the sample are made in Spark; the
driver gets the features and, per sampled text, the numbers of those it has.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_cut
from .common import col, fold, quoted, with_text

WORD = re.compile(r"\w+")
FLUSH = 400_000  # features that a task counts before it passes the counts on


def word_features(word: str) -> tuple[str, ...]:
    """The word and its beginnings of 4, 5 and 6 letters."""
    return (word, *["^" + word[:k] for k in (4, 5, 6) if len(word) >= k])


def text_features(text: str | None) -> set[str]:
    return {f for w in set(WORD.findall((text or "").lower())) for f in word_features(w)}


@dataclass
class Model:
    weights: dict[str, float]
    bias: float


def fit_nnpu(rows: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float, steps: int = 400,
             rate: float = 0.05, l2: float = 5e-4) -> tuple[np.ndarray, float]:
    """Weights and bias from binary rows (feature numbers of each text).

    Full-batch Adam on the non-negative risk with the logistic loss; when the
    unlabelled negative risk less the positives' share falls below zero, the
    step goes up that term's gradient instead.
    """
    at = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)] or [np.zeros(0, int)]).astype(np.int64)
    feat = np.concatenate(rows or [np.zeros(0, int)]).astype(np.int64)
    p, u = positive.astype(bool), ~positive.astype(bool)
    n_p, n_u = max(1, p.sum()), max(1, u.sum())
    w, b = np.zeros(n_features), 0.0
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    soft = lambda z: np.logaddexp(0, z)
    sig = lambda z: 0.5 * (1 + np.tanh(z / 2))
    for t in range(1, steps + 1):
        z = b + np.bincount(at, w[feat], len(rows))
        rest = soft(z[u]).sum() / n_u - prior * soft(z[p]).sum() / n_p
        g = np.zeros(len(rows))
        down_p, down_u = prior * sig(z[p]) / n_p, sig(z[u]) / n_u
        if rest >= 0:
            g[p] = -prior * sig(-z[p]) / n_p - down_p
            g[u] = down_u
        else:
            g[p] = down_p
            g[u] = -down_u
        gw, gb = np.bincount(feat, g[at], n_features) + l2 * w, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        folds: int = 5, held_out: int = 0, prior: float | None = None, max_positive: int = 8192,
        max_unlabelled: int = 16384, min_count: int = 4, min_evidence: float = 12.0) -> Model:
    """Learn from documents whose crc32(id as text) mod ``folds`` is not
    ``held_out`` (rows with a null id are not learned from).

    Features kept: all in at least ``min_count`` toxic texts, more than
    their share of unlabelled texts lets expect by a Poisson deviance of
    ``min_evidence``.  Of the rows of a sampled id the text with the smallest
    hash is learned from.

    ``prior`` is the share of toxic texts; None: their share among the
    labelled rows that may be learned from.  Several labels of one id count as
    toxic if one is.  Without any positive label every text scores as clean.
    """
    learn = F.coalesce(fold(F.col("id"), folds) != held_out, F.lit(False))
    known = (labels.select(col(id_col).alias("id"), col(label).alias("y")).filter(learn & F.col("y").isNotNull())
             .groupBy("id").agg(F.max((F.col("y") == 1).cast("int")).alias("y")))
    if prior is None:
        prior = known.agg(F.avg("y").alias("p")).first()["p"]
    if not prior:
        return Model({}, -10.0)
    prior = min(float(prior), 0.95)
    order = F.xxhash64("id")
    pos = known.filter("y = 1").orderBy(order, "id").limit(max_positive).select("id", F.lit(1).alias("y"))
    everyone = docs.select(col(id_col).alias("id")).filter(learn).distinct()
    unl = everyone.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(max_unlabelled).select("id", F.lit(0).alias("y"))
    picked = F.broadcast(pos.unionByName(unl))  # at most max_positive + max_unlabelled ids
    sample = cut_lineage(docs.select(col(id_col).alias("id"), col(text).cast("string").alias("text"))
                         .join(picked, "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "y"), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flushed() -> Iterator[pa.RecordBatch]:
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict({"f": pa.array(keys, pa.string()), "u": pa.array([seen[0][k] for k in keys], pa.int64()),
                                              "p": pa.array([seen[1][k] for k in keys], pa.int64())})
            for s in seen:
                s.clear()

        for b in batches:
            for t, y in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                seen[y].update(text_features(t.as_py()))
                if len(seen[0]) + len(seen[1]) > FLUSH:
                    yield from flushed()
        yield from flushed()

    n_p, n_u = (sample.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count(F.lit(1))).first())
    n_u -= n_p
    counts = (sample.mapInArrow(count, "f string, u long, p long").groupBy("f").agg(F.sum("u").alias("u"), F.sum("p").alias("p"))
              .filter(F.col("p") >= min_count))
    # Poisson deviance of a feature's count among the toxic texts, from what its share of U lets expect
    expected = (F.col("u") + 1) * (n_p / max(n_u, 1))
    evidence = 2 * (F.col("p") * F.log(F.col("p") / expected) - (F.col("p") - expected))
    chosen = (counts.filter(F.col("p") > expected).withColumn("evidence", evidence).filter(F.col("evidence") >= min_evidence)
              .orderBy(F.col("evidence").desc(), "f").select("f").collect())  # bounded by the sample
    number = {r["f"]: i for i, r in enumerate(chosen)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            have = [sorted(number[f] for f in text_features(t.as_py()) if f in number) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(have, pa.list_(pa.int32()))], names=["y", "have"])

    data = sample.mapInArrow(rows, "y int, have array<int>").toArrow()
    y, lists = data["y"].to_numpy(), data["have"].combine_chunks()
    have = np.split(lists.flatten().to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())[:-1]) if len(y) else []
    drop_cut(sample)
    w, b = fit_nnpu(have, y, len(number), prior)
    return Model({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-3}, b)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score", keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``; None: all) with a score from 0 to 1 (a column of that name is replaced).
    Whole texts count; a null or empty text gets the score of no features."""
    src, kept, at = with_text(df, text, (out,), keep)
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, tuple[str, ...]] = {}  # of words met so far, the features that weigh
        for b in batches:
            scores = []
            for t in b.column(at):
                found: set[str] = set()
                for w in set(WORD.findall((t.as_py() or "").lower())):
                    have = words.get(w)
                    if have is None:
                        if len(words) > 1_000_000:
                            words.clear()
                        have = words[w] = tuple(f for f in word_features(w) if f in weights)
                    if have:
                        found.update(have)
                z = bias + sum(weights[f] for f in found)
                scores.append(0.5 * (1 + float(np.tanh(z / 2))))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(kept))], pa.array(scores, pa.float64())], names=[*kept, out])

    schema = ", ".join([*[f"{quoted(f.name)} {f.dataType.simpleString()}" for f in src.schema[: len(kept)]], f"{quoted(out)} double"])
    return src.mapInArrow(run, schema)
