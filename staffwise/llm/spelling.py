"""Spelling variant grouping by PartEnum signatures, in DataFrame functions only.

A word is the multiset of its letters, as a binary vector with one dimension
per (letter, occurrence): an inserted or deleted letter changes one bit, a
replaced one two.  Words one edit apart are therefore within Hamming distance
two, and an exact signature scheme finds them:

1. Partition and enumerate.  The dimensions are dealt by a hash to ``n1``
   parts of ``n2`` pieces.  Of ``r`` differing bits some part has at most
   ``r // n1``, so it agrees on a set of ``n2 - r // n1`` pieces; a word's
   signatures are its bits on every such set of every part, with r = 2 for
   words of its own length and r = 1 for those one letter longer or shorter.
2. Equi-join.  Words meet by equal signatures.  Since one edit also leaves the
   first or the last half of the letters in place, each signature is made
   twice, with either half; so that few words meet that only share letters.
3. Verification, in the join itself, by the edit distance of the words.

Words are counted before anything is joined, so the text's size doesn't
matter; only verified pairs leave the join.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_cut
from .common import col, let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _bits(word: Column, cells: int) -> Column:
    """The word's dimensions in order: (letter, occurrence, cell they are dealt to)."""
    places = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))

    def bits(letters: Column) -> Column:
        def bit(c: Column, i: Column) -> Column:
            nth = i - F.array_position(letters, c).cast("int")
            return F.struct(c.alias("c"), nth.alias("k"), F.pmod(F.xxhash64(c, nth), F.lit(cells)).cast("int").alias("cell"))
        return F.transform(letters, bit)
    return let(F.sort_array(F.transform(places, lambda i: F.substring(word, i, F.lit(1)))), bits)


def signatures(words: DataFrame, n1: int = 1, n2: int = 4) -> DataFrame:
    """``(sig, word, n)``: the signatures of distinct words with counts."""
    if n1 < 1 or n2 <= 2 // n1:
        raise ValueError("n2 must exceed 2 // n1")
    piece = lambda cell: F.xxhash64(F.transform(F.filter("bits", lambda b: b["cell"] == cell), lambda b: F.struct(b["c"], b["k"])))
    pieces = [piece(c) for c in range(n1 * n2)]  # (of a written table: an expression would be worked out for each)
    size = F.col("m")
    made = []
    for radius, longer in ((2, size), (1, size), (1, size + 1)):  # pairs of one length; pairs whose longer, whose shorter word this is
        half = F.floor((longer - 1) / 2).cast("int")
        for side, part in enumerate((F.substring("word", F.lit(1), half), F.substring("word", size - half + 1, half))):
            made += [F.xxhash64(F.lit(radius), longer, F.lit(side), part, F.lit(i), *[F.lit(j) for j in s], *[F.get("pieces", F.lit(i * n2 + j)) for j in s])
                     for i in range(n1) for s in combinations(range(n2), n2 - radius // n1)]
    bits = cut_lineage(words.select("word", "n", F.length("word").alias("m"), _bits(F.col("word"), n1 * n2).alias("bits")), "bits")
    return (cut_lineage(bits.select("word", "n", "m", F.array(*pieces).alias("pieces")), "pieces")
            .select("word", "n", F.explode(F.array(*made)).alias("sig")))


def near_pairs(words: DataFrame, n1: int = 1, n2: int = 4) -> DataFrame:
    """``(a, n_a, b, n_b)``, ``a < b``: the pairs of ``words`` (distinct ``word``, ``n``) one edit apart."""
    sig = cut_lineage(signatures(words, n1, n2), "signatures")  # written, so that a frequent signature's partition can be split
    a = sig.select("sig", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = sig.select("sig", F.col("word").alias("b"), F.col("n").alias("n_b"))
    return a.join(b, "sig").filter((F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b").distinct()


def spelling_variants(words: DataFrame, word: str = "word", n: str = "n", ratio: int = 5, n1: int = 1, n2: int = 4) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` per distinct word.

    ``words`` holds words with counts; rows of one word are added up, null
    words and null counts are left out.  Two words are near if one code point
    is inserted, deleted or replaced.  A word's form is its near word with the
    largest count (ties: the smallest in code-point order) if that count is at
    least ``ratio`` times its own, else null; ``root`` follows the forms to
    the last (the word itself if it has none).  Counts grow along forms, so
    there are no circles.  An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    known = cut_lineage(words.select(col(word).alias("word"), col(n).cast("long").alias("n")).filter("word IS NOT NULL AND n > 0")
                        .groupBy("word").agg(F.sum("n").alias("n")), "words")
    pair = cut_lineage(near_pairs(known, n1, n2), "near-words")
    link = pair.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pair.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = link.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("b"))
    enough = -F.col("b.k") >= F.lit(ratio) * F.col("n")
    out = cut_lineage(known.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("b.near")).alias("form"), F.when(enough, -F.col("b.k")).alias("form_n")), "forms")
    root = _roots(out.filter("form IS NOT NULL").select("word", F.col("form").alias("to")))
    return (out.join(root.toDF("word", "root"), "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, to)`` with ``to`` at the end of the word's forms: each round doubles
    the step, so their number is the logarithm of the longest chain."""
    state = cut_lineage(forms, "roots")
    while True:
        ahead = state.toDF("to", "next")
        new, seen = cut_lineage(state.join(ahead, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")),
                                "roots", {"moved": F.max("moved")})
        drop_cut(state)
        state = new.select("word", "to")
        state._staffwise_cut = new._staffwise_cut
        if not seen["moved"]:
            return state
