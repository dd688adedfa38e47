"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1/-1.  A letter n-gram is bound from its
letters' vectors, each permuted (rolled) by its place, and multiplied; a text
is the bundle (sum) of its n-grams; a language's prototype bundles its texts,
each scaled to about unit length so that no long text dominates.  A text gets
the language whose prototype has the largest cosine with its bundle.

Because bundling is a sum, the dot product of a text's bundle with a prototype
is the sum of its n-grams' dot products; these are kept per n-gram in the
Python worker, so a text costs one table look-up per letter instead of one
vector addition.  The text's own length is the same for all languages, so it
changes neither the order nor the score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, per_process, quoted, with_text

SYMBOLS = 128  # 0 is the gap between words, 1-26 a-z, other letters share the rest
CHUNK = 1 << 20  # letters handled at once


def _symbol_table() -> np.ndarray:
    """The symbol of every code point."""
    return per_process(("symbols", SYMBOLS), _make_symbol_table)


def _make_symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000 and chr(p).isalpha()])
    table[points] = 27 + (points * 2654435761 >> 7) % (SYMBOLS - 27)
    table[ord("a"):ord("z") + 1] = np.arange(1, 27)
    return table


def symbols(text: str) -> np.ndarray:
    """The lower-cased text's letters as symbols, each run of other characters
    as one 0, with a 0 at both ends; empty if the text has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    s = _symbol_table()[points]
    s = np.concatenate(([0], s, [0])).astype(np.int64)
    s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]
    return s if len(s) > 2 else s[:0]


def ngram_codes(text: str | None, n: int) -> np.ndarray:
    """One number per n-gram of the text's symbols (shorter texts: none)."""
    s = symbols(text) if text else np.zeros(0, np.int64)
    if len(s) < n:
        return s[:0]
    code = s[: len(s) - n + 1].copy()
    for k in range(1, n):
        code = code * SYMBOLS + s[k : len(s) - n + 1 + k]
    return code


def letter_vectors(dim: int, seed: int) -> np.ndarray:
    return (np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dim)) * 2 - 1).astype(np.int8)


def ngram_vectors(codes: np.ndarray, n: int, letters: np.ndarray) -> np.ndarray:
    """Bound vectors of n-gram codes: the product over the places of the
    letter's vector rolled by its distance from the last place."""
    out = np.ones((len(codes), letters.shape[1]), np.int8)
    for k in range(n):  # k: distance from the last letter
        out *= np.roll(letters, k, axis=1)[codes // SYMBOLS**k % SYMBOLS]
    return out


def _strings(column: pa.ChunkedArray | pa.Array) -> Iterator[str | None]:
    for x in column:
        yield x.as_py()


def fit_profiles(df: DataFrame, text: str, lang: str, n: int = 3, dim: int = 2048, seed: int = 17,
                 max_languages: int = 1000) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes (one unit row each).

    Each task bundles its rows into one vector per language; Spark sums them,
    so the driver gets ``languages x dim`` numbers; more than
    ``max_languages`` languages raise, before any numbers are fetched.  Rows
    with a null language or a text without letters teach nothing.
    """
    several = df.select(col(lang)).distinct().limit(max_languages + 2).count()
    if several > max_languages + 1:  # null counts as one here
        raise ValueError(f"more than {max_languages} languages")
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, weights = letter_vectors(dim, seed), {}
        for b in batches:
            for t, g in zip(_strings(b.column(0)), _strings(b.column(1)), strict=True):
                codes = ngram_codes(t, n)
                if len(codes):
                    u, c = np.unique(codes, return_counts=True)
                    w = weights.setdefault(g, (np.zeros(0, np.int64), np.zeros(0), [], []))
                    w[2].append(u)
                    w[3].append(c / np.sqrt(np.square(c, dtype=float).sum()))
                    if len(w[2]) >= 512:
                        weights[g] = (*_merged(w), [], [])
        for g, w in weights.items():
            codes, c = _merged(w)
            v = np.zeros(dim)
            for i in range(0, len(codes), 4096):
                v += c[i : i + 4096] @ ngram_vectors(codes[i : i + 4096], n, letters)
            yield pa.RecordBatch.from_pydict({"lang": [g] * dim, "k": np.arange(dim, dtype=np.int32), "v": v})

    learned = (df.filter(col(lang).isNotNull() & col(text).isNotNull()).select(col(text).cast("string"), col(lang).cast("string"))
               .mapInArrow(bundle, "lang string, k int, v double").groupBy("lang", "k").agg(F.sum("v").alias("v")).toPandas())
    if learned.empty:
        return [], np.zeros((0, dim))
    table = learned.pivot(index="lang", columns="k", values="v").sort_index()
    p = table.to_numpy()
    return list(table.index), p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-300)


def _merged(w: tuple) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([w[0], *w[2]]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([w[1], *w[3]]), len(codes))


class _Scorer:
    """Dot products of n-grams with the prototypes, filled in as n-grams are met."""

    def __init__(self, profiles: np.ndarray, n: int, dim: int, seed: int):
        self.profiles, self.n, self.letters = profiles, n, letter_vectors(dim, seed)
        self.slot = np.full(SYMBOLS**n, -1, np.int32)
        self.rows, self.used = np.zeros((1024, len(profiles))), 0

    def dots(self, codes: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.profiles))
        for i in range(0, len(codes), CHUNK):
            part = codes[i : i + CHUNK]
            at = self.slot[part]
            if (at < 0).any():
                new = np.unique(part[at < 0])
                while self.used + len(new) > len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                for j in range(0, len(new), 4096):
                    some = new[j : j + 4096]
                    self.rows[self.used : self.used + len(some)] = ngram_vectors(some, self.n, self.letters).astype(float) @ self.profiles.T
                    self.slot[some] = np.arange(self.used, self.used + len(some), dtype=np.int32)
                    self.used += len(some)
                at = self.slot[part]
            total += np.bincount(at, minlength=self.used) @ self.rows[: self.used] if len(at) > self.used else self.rows[at].sum(0)
        return total


def predict(df: DataFrame, languages: list[str], profiles: np.ndarray, text: str = "text", n: int = 3, dim: int = 2048,
            seed: int = 17, out: tuple[str, str] = ("lang_pred", "score"), keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``; None: all) with the predicted language and a score (columns of these names
    are replaced).

    The largest cosine wins, be it negative.  The score is its share of all
    positive cosines, 0 to 1 (0 if none is positive).  Ties go
    to the first language in order.  A null text, one without letters, or a
    model without languages gives ``und`` and 0.
    """
    src, kept, at = with_text(df, text, out, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(profiles, n, dim, seed)
        for b in batches:
            names, scores = [], []
            for t in _strings(b.column(at)):
                codes = ngram_codes(t, n)
                dots = scorer.dots(codes) if len(codes) and languages else np.zeros(1)
                k, near = int(dots.argmax()), np.maximum(dots, 0)
                names.append(languages[k] if len(codes) and languages else "und")
                scores.append(float(near[k] / near.sum()) if near.sum() > 0 else 0.0)
            cols = [b.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*kept, *out])

    schema = ", ".join([*[f"{quoted(f.name)} {f.dataType.simpleString()}" for f in src.schema[: len(kept)]],
                        f"{quoted(out[0])} string", f"{quoted(out[1])} double"])
    return src.mapInArrow(run, schema)
