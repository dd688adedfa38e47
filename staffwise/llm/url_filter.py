"""URL filter: blocked Bloom filter, then an exact hash join.

The listed rules (host, path, verdict) are put into a blocked Bloom filter:
each rule sets one bit in each of the eight 64-bit words of one block.  The
number of blocks follows the number of rules up to a fixed cap, so the filter
that is broadcast has a proven size; above the cap it only gets less
selective.  A url's candidate keys (its host and parent domains, times the
path prefixes of the lengths that occur among the rules) are tested against
the filter, and possible hits go through an exact join that removes the false
positives.  The result never depends on the filter's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8  # 64-bit words in a block of the filter


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url.

    Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased.  Path: from there up to ``?``, ``#`` or the end.  Both are
    empty for a null url or one without ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def _bits(host: Column, path: Column, blocks: int) -> tuple[Column, list[Column]]:
    h = F.xxhash64(host, path)
    second = F.xxhash64(h, F.lit(1))
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
             for i in range(WORDS)]
    return F.pmod(h, F.lit(blocks).cast("long")), masks


def bloom_blocks(n_keys: int, bits_per_key: int = 16, max_blocks: int = 1 << 17) -> int:
    """Blocks of 512 bits for ``n_keys``; at most ``max_blocks`` (8 MB)."""
    return max(1, min(max_blocks, -(-n_keys * bits_per_key // (64 * WORDS))))


def build_filter(keys: DataFrame, host: str, path: str, blocks: int) -> DataFrame:
    """One row per block that holds a key: ``block, w0 .. w7``."""
    block, masks = _bits(col(host), col(path), blocks)
    return (keys.select(block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
            .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]))


def url_filter(df: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow",
               max_blocks: int = 1 << 17) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict`` for each url.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``);
    a rule fits its host and all subdomains when the url's path starts with
    the rule's path.  The longest rule text wins, then the longer host.  Rules
    with a null host or path fit nothing; of two verdicts for one rule,
    ``block`` wins.  A url that no rule fits gets ``otherwise`` and a null
    rule; so does a null or empty url.  Rows are never merged or lost:
    verdicts are found per distinct (host, path) and joined back.  Columns of
    ``df`` named like the four new ones are replaced.
    """
    host, path = url_parts(col(url))
    kept = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    pages = df.withColumns({"host": host, "path": path}).select(*[col(c) for c in kept], "host", "path")
    listed = (rules.filter(col("host").isNotNull() & col("path").isNotNull())
              .groupBy(col("host").alias("r_host"), col("path").alias("r_path")).agg(F.max(col("verdict")).alias("r_verdict")))
    # a few numbers about the rules: how many, the most labels of a host, the lengths of paths
    shape = listed.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
                       F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths")).first()
    if not shape["n"]:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(otherwise)})
    blocks = bloom_blocks(shape["n"], max_blocks=max_blocks)
    bloom = build_filter(listed, "r_host", "r_path", blocks)

    labels = F.split("host", r"\.")
    most = F.least(F.size(labels), F.lit(shape["labels"]))
    tails = F.transform(F.sequence(F.lit(1), most),
                        lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    heads = F.transform(F.filter(F.array(*[F.lit(n) for n in shape["lengths"]]), lambda n: n <= F.length("path")),
                        lambda n: F.substr(F.col("path"), F.lit(1), n))
    keys = pages.select("host", "path", F.explode(tails).alias("k_host"), heads.alias("heads")).select(
        "host", "path", "k_host", F.explode("heads").alias("k_path"))
    block, masks = _bits(F.col("k_host"), F.col("k_path"), blocks)
    probe = keys.withColumns({"block": block, **{f"m{i}": m for i, m in enumerate(masks)}})
    passed = probe.join(F.broadcast(bloom), "block")
    for i in range(WORDS):
        passed = passed.filter(F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) != 0)
    passed = passed.select("host", "path", "k_host", "k_path").distinct()
    # the exact join removes the filter's false positives
    hits = passed.join(listed, (F.col("k_host") == F.col("r_host")) & (F.col("k_path") == F.col("r_path")))
    text = F.concat("r_host", "r_path")
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct(text.alias("rule"), F.col("r_verdict").alias("verdict")),
                 F.struct(F.length(text), F.length("r_host"))).alias("best"))
    new = fresh(pages, "b_host", "b_path", "b_best")
    best = best.toDF(*new)
    out = pages.join(best, (pages["host"] == best[new[0]]) & (pages["path"] == best[new[1]]), "left")
    return out.select(*[pages[f"`{c}`"] for c in kept], pages["host"], pages["path"], F.col(f"{new[2]}.rule").alias("rule"),
                      F.coalesce(F.col(f"{new[2]}.verdict"), F.lit(otherwise)).alias("verdict"))


def listed_urls(df: DataFrame, url: str = "url", verdict: str = "block") -> DataFrame:
    """Rules from a list of urls: each one's canonical host and path (see
    :func:`url_parts`) with ``verdict``; urls without a host list nothing."""
    host, path = url_parts(col(url))
    return df.select(host.alias("host"), path.alias("path"), F.lit(verdict).alias("verdict")).filter("host <> ''").distinct()
