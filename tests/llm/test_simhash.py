"""SimHash: fingerprints, links and groups against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from staffwise.llm import queries, simhash
from staffwise.llm.common import connected_components

LETTERS = [chr(c) for c in range(97, 123)]


def brute_fingerprint(text, n=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c == " " or 9 <= ord(c) <= 13:
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    sh = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """rows: (id, fingerprint); smallest id reachable per row."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= 4:
                root[find(b)] = find(a)
    low = {}
    for d, f in rows:
        r = find(f)
        if d is not None:
            low[r] = min(d, low.get(r, d))
    return [low.get(find(f)) for _, f in rows]


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices(LETTERS, k=rng.randint(2, 6)))
    out = [None, "", " \t\n", "One", "one ONE One", "É É é É", "a b c d", "A  B\nC\td", "x" * 5000, "  em space is a word"]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 300))]
        out.append(" ".join(base))
        for _ in range(4):
            other = list(base)
            for _ in range(rng.randint(0, 2)):
                other[rng.randrange(len(other))] = word()
            out.append(" ".join(other))
    out.append(" ".join(word() for _ in range(80_000)))
    return out + out[:3] + out[12:20]


def test_groups_match_brute_force(spark):
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts())] + [(3, "One"), (3, "quite another text of this id"), (3, "One")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string").repartition(5)
    got = simhash.simhash_groups(df).collect()
    want = [(i, brute_fingerprint(t)) for i, t in rows]
    comp = brute_components(want)
    assert Counter((r["id"], r["fp"] % 2**64, r["component"]) for r in got) == Counter((i, f, c) for (i, f), c in zip(want, comp))
    kept = simhash.simhash_dedup(df)
    assert kept.columns == ["doc_id", "text", "fp"]
    out = kept.collect()
    assert len(out) == len({r["root"] for r in got})
    assert sorted(brute_fingerprint(r["text"]) for r in out) != []


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).count() == 0
    assert simhash.simhash_dedup(df).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_near_pairs_are_all_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(-2**63, 2**63, 40, dtype=np.int64)
    fps = np.concatenate([base] + [base ^ (np.int64(1) << rng.integers(0, 63, 40)) ^ (np.int64(1) << rng.integers(0, 63, 40)) for _ in range(9)])
    group = np.sort(rng.integers(0, 5, len(fps)))
    got = {(int(a), int(b)) for i, j in simhash.near_pairs(fps, group, radius) for a, b in zip(i, j)}
    x = np.bitwise_count(fps[:, None] ^ fps[None, :])
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if group[i] == group[j] and x[i, j] <= radius}
    assert got == want


def test_every_spread_and_segment_gives_the_same_links(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(-2**62, 2**62, 30, dtype=np.int64)
    fps = np.unique(np.concatenate([base] + [base ^ (np.int64(1) << rng.integers(0, 63, 30)) ^ (np.int64(1) << rng.integers(0, 63, 30)) for _ in range(12)]))
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    want = None
    for n, segment in ((1, 2048), (10**7, 2048), (10**9, 2048), (1, 7)):
        monkeypatch.setattr(simhash, "SEGMENT", segment)
        got = {(r["node"], r["component"]) for r in connected_components(simhash.link_forest(df, n)).collect()}
        want = want or got
        assert got == want and got


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5001), (5001, 5000), (7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}, 5000: 5000, 5001: 5000}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op4_simhash(spark, sf).collect()}
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    comp = brute_components(rows)
    assert got == {d: (f"{f:016x}", c) for (d, f), c in zip(rows, comp)}
