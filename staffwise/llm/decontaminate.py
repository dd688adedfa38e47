"""Benchmark decontamination by SimHashed windows, in DataFrame functions only.

Texts are lower-cased words (runs of letters, marks and digits); a benchmark
item of ``n`` words is compared with windows of ``n`` words of a document
(the whole document where that is shorter).  An item of fewer words than a
shingle is one shingle as a whole.

1. Windows.  A window of which too few places hold a shingle of the items of
   its length cannot reach the threshold, whatever else it holds; every other
   window is built, at whatever place its shingles have in the item.  Shingles
   meet by their hash in one pass over the documents; the places of a document
   then give the ranges of starts.
2. SimHash.  Every distinct window gets a 64-bit fingerprint of its shingles,
   counted as often as they occur, and so does every item.
3. Multi-index.  The fingerprint is cut into ``pieces``; two that differ in at
   most ``radius`` bits have a piece that differs in at most ``radius //
   pieces``, and every item lists the values so near to its own.  A pair that
   reaches the threshold also shares one of the first few of its shingles in
   order of their hashes (how few follows from the threshold), so an entry is
   a piece's value together with one of those: windows and items without a
   common shingle never meet, whatever their number.  The join of windows and
   items of one length on these entries misses none within the radius; the
   rest is removed by the exact distance.
4. Verification.  Weighted shingle similarity of what remains: the sum of the
   smaller counts over the sum of the larger ones, from the words themselves,
   row by row.

Distinct windows are fingerprinted and verified once, however many documents
share them.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import col, fresh, let
from .url_filter import _bits, bloom_blocks, build_filter

BROADCAST_SHINGLES = 1_000_000  # rows of (shingle, length) up to which they are broadcast; more pass a Bloom filter and a shuffle
BROADCAST_RANGES = 200_000  # ranges of starts up to which they are broadcast


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def shingle_hashes(words: Column, k: int) -> Column:
    """Hashes of ``words``' shingles; fewer words than ``k`` are one shingle (a hash skips nulls)."""
    return let(words, lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))),
                                            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))


def shingles(words: Column, k: int) -> Column:
    return let(words, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))),
                                            lambda i: F.array_join(F.slice(w, i, F.lit(k)), " ")))


def _numbered(shingle: Column) -> Column:
    """Shingles told apart by how often they occurred before."""
    return let(F.sort_array(shingle), lambda at: F.transform(at, lambda x, i: F.concat(x, F.lit(" "), (i - F.array_position(at, x)).cast("string"))))


def simhash(hashes: Column) -> Column:
    """Bit ``b`` is set if it is set in over half the hashes."""
    def bit(b: Column) -> Column:
        ones = F.size(F.filter(hashes, lambda h: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1).cast("long")) == 1))
        return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(bit(b)))


def _edges(pieces: int) -> list[int]:
    return [64 * i // pieces for i in range(pieces + 1)]


def _pieces(fp: Column, pieces: int) -> Column:
    """(piece, value) of a fingerprint."""
    edge = _edges(pieces)
    return F.array(*[F.struct(F.lit(i).alias("i"), F.shiftrightunsigned(fp, edge[i]).bitwiseAND(F.lit((1 << edge[i + 1] - edge[i]) - 1)).alias("v"))
                     for i in range(pieces)])


def _near_pieces(fp: Column, pieces: int, radius: int) -> Column:
    """(piece, value) of all values that differ from the fingerprint's in at most ``radius // pieces`` bits."""
    edge = _edges(pieces)
    masks = [(i, sum(1 << b for b in bits)) for i in range(pieces) for d in range(radius // pieces + 1) for bits in combinations(range(edge[i + 1] - edge[i]), d)]
    return let(_pieces(fp, pieces), lambda own: F.array(*[
        F.struct(F.lit(i).alias("i"), F.get(own, F.lit(i))["v"].bitwiseXOR(F.lit(m)).alias("v")) for i, m in masks]))


def _needed(window: Column, item: Column, threshold: float) -> Column:
    """The least number of common shingles of a window and an item of so many that reach the threshold."""
    return F.greatest(F.lit(1), F.ceil((window + item) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9)).cast("int"))


def _entries(pieces: Column, hashes: Column, first: Column) -> Column:
    """Hashes of (length, piece, value, shingle) for the first shingles in order of their hashes."""
    early = F.array_distinct(F.slice(F.sort_array(hashes), F.lit(1), first))
    return let(pieces, lambda at: F.flatten(F.transform(early, lambda h: F.transform(at, lambda p: F.xxhash64(F.col("n"), p["i"], p["v"], h)))))


def _similarity(window: Column, item: Column, shingle: int) -> Column:
    """Weighted shingle similarity of two texts."""
    def of(ab: Column) -> Column:
        a, b = ab["a"], ab["b"]
        once = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
        both = F.when(once, F.size(F.array_intersect(a, b))).otherwise(F.size(F.array_intersect(_numbered(a), _numbered(b))))
        return both / (F.size(a) + F.size(b) - both)
    return let(F.struct(shingles(window, shingle).alias("a"), shingles(item, shingle).alias("b")), of)


def _starts(shingle: int, threshold: float) -> Column:
    """Ranges (lo, hi) of the starts whose window of ``n`` words has enough of
    the sorted places ``at`` in a text of ``size`` words: the similarity is at
    most ``held / (window + item - held)``.  The ranges don't overlap."""
    width = lambda n: F.greatest(n - (shingle - 1), F.lit(1))
    window = width(F.least("size", "n"))
    least = _needed(window, width(F.col("n")), threshold)
    at = lambda i: F.get("at", i)
    # the first place in the window is the i-th, so the start lies after the one before; the last one needed lies in the window, too
    span = lambda i: F.struct(F.greatest(F.lit(0), at(i - 1) + 1, at(i + least - 1) - window + 1).alias("lo"),
                              F.least(at(i), F.greatest(F.lit(0), F.col("size") - F.col("n"))).alias("hi"))
    spans = F.when(F.size("at") >= least, F.transform(F.sequence(F.lit(0), F.size("at") - least), span))
    return F.filter(F.coalesce(spans, F.array().cast("array<struct<lo:int,hi:int>>")), lambda r: r["lo"] <= r["hi"])


def _shared_places(doc: DataFrame, item: DataFrame, shingle: int) -> DataFrame:
    """``(id, text_hash, size, n, at)``: the places in a document, of ``size`` words, of shingles of items of ``n`` words."""
    place, seen = cut_lineage(item.select("n", F.explode(shingle_hashes(F.col("w"), shingle)).alias("h")).distinct(), "item-shingles",
                              {"rows": F.count(F.lit(1)), "short": F.sort_array(F.collect_set(F.when(F.col("n") < shingle, F.col("n"))))})
    # one row per word, its shingles hashed in generated code; only rows that join leave it
    word = doc.select("id", "text_hash", words_of(F.col("text")).alias("w")).select("id", "text_hash", "w", F.posexplode("w").alias("p", "word"))
    starts = lambda k: F.when(F.col("p") <= F.size("w") - k, F.xxhash64("word", *[F.get("w", F.col("p") + j) for j in range(1, k)]))
    short = seen["short"] or []  # lengths of items that are one shingle; few, if any
    h = F.explode(F.array(*[starts(k) for k in [*short, shingle]])) if short else starts(shingle)
    placed = word.select("id", "text_hash", F.size("w").alias("size"), "p", h.alias("h")).filter("h IS NOT NULL")
    if seen["rows"] <= BROADCAST_SHINGLES:
        shared = placed.join(F.broadcast(place), "h")
    else:  # the documents are still read once: a filter of bounded size, then the exact join
        blocks = bloom_blocks(seen["rows"], max_blocks=1 << 20)
        block, masks = _bits(F.col("h"), F.col("h"), blocks)
        passed = placed.withColumns({"block": block, **{f"m{i}": m for i, m in enumerate(masks)}}).join(
            F.broadcast(build_filter(place.select("h").distinct(), "h", "h", blocks)), "block")
        for i in range(len(masks)):
            passed = passed.filter(F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) != 0)
        shared = passed.select("id", "text_hash", "size", "p", "h").join(place, "h")
    return shared.groupBy("id", "text_hash", "size", "n").agg(F.sort_array(F.collect_set("p")).alias("at"))


def matched_windows(docs: DataFrame, items: DataFrame, id_col: str, text: str, item_id: str, item_text: str, shingle: int,
                    threshold: float, radius: int, pieces: int) -> DataFrame:
    """``(id, text_hash, item, similarity, distance, start, n)`` of windows that match."""
    item = items.select(col(item_id).alias("item"), words_of(col(item_text)).alias("w")).filter(F.size("w") > 0).withColumn("n", F.size("w"))
    doc = docs.filter(col(text).isNotNull()).select(col(id_col).alias("id"), F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))
    ranges, seen = cut_lineage(_shared_places(doc, item, shingle).select("id", "text_hash", "n", _starts(shingle, threshold).alias("ranges"))
                               .filter(F.size("ranges") > 0), "window-starts", {"n": F.sum(F.size("ranges"))})
    ranges = ranges.toDF("r_id", "r_hash", "n", "ranges").hint("broadcast" if (seen["n"] or 0) <= BROADCAST_RANGES else "shuffle_hash")
    found = (doc.join(ranges, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")))
             .select("id", "text_hash", "n", words_of(F.col("text")).alias("w"), F.explode("ranges").alias("r"))
             .select("id", "text_hash", "n", "w", F.explode(F.sequence("r.lo", "r.hi")).alias("start"))
             .select("id", "text_hash", "n", "start", F.array_join(F.slice("w", F.col("start") + 1, F.col("n")), " ").alias("window"))
             .withColumns({"k1": F.xxhash64("n", "window"), "k2": F.xxhash64(F.lit(1), "window", "n")}))
    found = cut_lineage(found, "windows")

    # distinct windows and items: fingerprints, then candidates that share an entry of the index
    window = (found.groupBy("n", "k1", "k2").agg(F.first("window").alias("window")).withColumn("hashes", shingle_hashes(F.split("window", " "), shingle))
              .withColumn("fp", simhash(F.col("hashes"))))
    window = cut_lineage(window, "window-fingerprints")  # else the plan works them out once per piece
    known = (item.withColumn("item_words", F.array_join("w", " ")).select("n", "item_words", shingle_hashes(F.col("w"), shingle).alias("hashes")).distinct()
             .withColumn("item_fp", simhash(F.col("hashes"))))
    known = cut_lineage(known, "items")
    size, full = F.size("hashes"), F.greatest(F.col("n") - (shingle - 1), F.lit(1))
    a = window.select("n", "k1", "k2", "fp", F.explode(_entries(_pieces(F.col("fp"), pieces), F.col("hashes"), size - _needed(size, full, threshold) + 1)).alias("e"))
    # (the shortest window that can match, a whole document, needs the most of the item's first shingles)
    low = _needed(F.ceil(size * F.lit(threshold) - F.lit(1e-9)), size, threshold)
    b = known.select(F.col("n").alias("b_n"), "n", "item_words", "item_fp",
                     F.explode(_entries(_near_pieces(F.col("item_fp"), pieces, radius), F.col("hashes"), size - low + 1)).alias("e"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    candidate = (a.join(b.drop("n"), "e").filter(F.col("n") == F.col("b_n")).withColumn("distance", distance).filter(F.col("distance") <= radius)
                 .select("n", "k1", "k2", "item_words", "distance").distinct())

    # weighted similarity from the words themselves
    verified = (candidate.join(window.select("n", "k1", "k2", "window"), ["n", "k1", "k2"])
                .withColumn("similarity", _similarity(F.split("window", " "), F.split("item_words", " "), shingle))
                .filter(F.col("similarity") >= threshold).select("n", "k1", "k2", "item_words", "distance", "similarity"))
    named = verified.join(item.select("item", F.array_join("w", " ").alias("item_words")).distinct(), "item_words").select("n", "k1", "k2", "item", "distance", "similarity")
    return found.drop("window").join(named, ["n", "k1", "k2"]).select("id", "text_hash", "item", "similarity", "distance", "start", "n")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", shingle: int = 5, threshold: float = 0.8, radius: int = 20, pieces: int = 11) -> DataFrame:
    """``(id, text_hash, item, similarity, distance, start, n_words)``: for
    each document text and item that match, the best window (the highest
    similarity, then the first).

    ``text_hash`` tells rows of a repeated id apart; equal rows give one
    result.  Texts and items that are null or have no words match nothing; an
    item of fewer than ``shingle`` words matches where they stand in a
    document, in a row.  A null item id is reported as null.
    """
    hit = matched_windows(docs, items, id_col, text, item_id, item_text, shingle, threshold, radius, pieces)
    best = F.max_by(F.struct("similarity", "distance", "start", F.col("n").alias("n_words")), F.struct("similarity", -F.col("start")))
    return (hit.groupBy("id", "text_hash", "item").agg(best.alias("b"))
            .select("id", "text_hash", "item", "b.similarity", "b.distance", "b.start", "b.n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", broadcast_rows: int = 200_000,
                  **options) -> DataFrame:
    """``docs`` without the rows whose text matches an item.  The list of
    matched texts is broadcast while it is at most ``broadcast_rows`` long."""
    a, b = fresh(docs, "hit_id", "hit_hash")
    hit, seen = cut_lineage(contaminated(docs, items, id_col, text, **options).select("id", "text_hash").distinct(), "contaminated",
                            {"n": F.count(F.lit(1))})
    hit = hit.toDF(a, b).hint("broadcast" if seen["n"] <= broadcast_rows else "shuffle_hash")
    return docs.join(hit, col(id_col).eqNullSafe(F.col(a)) & (F.xxhash64(col(text)) == F.col(b)), "left_anti")
