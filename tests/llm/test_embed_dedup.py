"""Embedding near-dedup: forest, links and groups against brute force."""

import numpy as np
import pytest

from staffwise.llm import embed_dedup, queries


def brute(ids, vecs, threshold=0.95):
    """(links per row, component per row) from all cosines in double precision."""
    n = len(ids)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vecs]
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = set()
    for d in {len(v) for v, o in zip(vecs, ok) if o}:
        at = [i for i in range(n) if ok[i] and len(vecs[i]) == d]
        x = np.array([vecs[i] for i in at], float)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        c = x @ x.T >= threshold
        for a, b in zip(*np.nonzero(np.triu(c, 1))):
            i, j = at[a], at[b]
            pairs.add((i, j))
            links[i] += 1
            links[j] += 1
            root[find(max(i, j))] = find(min(i, j))
    name = {}
    for i in range(n):
        if ids[i] is not None:
            r = find(i)
            name[r] = min(ids[i], name.get(r, ids[i]))
    return links, [name.get(find(i), ids[i]) for i in range(n)]


def table(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((60, 16))
    vecs = [list(map(float, v)) for v in base]
    for v in base:
        for e in (0.0, 0.05, 0.15, 0.25, 0.3, 0.35):
            vecs.append(list(map(float, v * rng.uniform(0.1, 9) + e * np.linalg.norm(v) * rng.standard_normal(16) / 4)))
    vecs += [vecs[0]] * 5 + [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1e300] * 16, [2e300] * 16,
                             [1.0, 2.0], [2.0, 4.0], [-1.0, -2.0], [1e-300] * 16]
    ids = list(range(len(vecs)))
    ids[7], ids[9], ids[70] = None, 8, None
    return ids, vecs


@pytest.mark.parametrize("segment,leaf", [(1024, 1000), (1024, 16), (5, 16), (5, 1000)])
def test_matches_brute_force(spark, monkeypatch, segment, leaf):
    monkeypatch.setattr(embed_dedup, "SEGMENT", segment)
    ids, vecs = table()
    df = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, vecs)], "vec_id long, embedding array<double>, leaf string").repartition(3)
    got = embed_dedup.embedding_groups(df, leaf=leaf, trees=12, spill=1.0).collect()
    links, comp = brute(ids, vecs)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    want = sorted(((i, n, c, i == c) for i, n, c in zip(ids, links, comp)), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want


def test_empty_table(spark):
    assert embed_dedup.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    none = embed_dedup.embedding_groups(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in none] == [(1, 0, 1, True)]


def test_recall_of_the_forest():
    """Of pairs right at the threshold, the share that meets in a leaf of a deep forest."""
    rng = np.random.default_rng(2)
    dim, n = 64, 6000
    a = embed_dedup.unit(rng.standard_normal((n, dim)))
    side = rng.standard_normal((n, dim))
    side -= (side * a).sum(1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * embed_dedup.unit(side)
    forest = embed_dedup.Forest(a, dim, 6, 9, 0.5 * np.sqrt(0.1) / np.sqrt(dim), 29)
    ra, ca = forest.leaves(a)
    rb, cb = forest.leaves(b)
    met = set(zip(ra.tolist(), ca.tolist())) & set(zip(rb.tolist(), cb.tolist()))
    assert len({r for r, _ in met}) >= 0.97 * n
    assert len(ra) / n < 6 * 4


def test_recall_on_planted_pairs(spark):
    """Half the vectors have a partner right above the threshold."""
    rng = np.random.default_rng(3)
    n, dim = 3000, 64
    a = embed_dedup.unit(rng.standard_normal((n, dim)))
    side = rng.standard_normal((n, dim))
    side -= (side * a).sum(1, keepdims=True) * a
    c = rng.uniform(0.9505, 0.97, (n, 1))
    b = c * a + np.sqrt(1 - c**2) * embed_dedup.unit(side)
    vecs = np.concatenate([a, b, embed_dedup.unit(rng.standard_normal((n, dim)))])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vecs.tolist())], "vec_id long, embedding array<double>")
    got = embed_dedup.embedding_groups(df, leaf=64).collect()
    links, comp = brute(list(range(3 * n)), vecs.tolist())
    assert sum(links) >= 2 * n and sum(r["n_links"] for r in got) >= 0.9 * sum(links)
    assert all(r["n_links"] <= links[r["vec_id"]] for r in got)
    assert sum(r["component_id"] == comp[r["vec_id"]] for r in got) >= 0.9 * len(got)


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = {r["vec_id"]: r for r in queries.op5_embedding_dedup(spark, sf).collect()}
    links, comp = brute([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    want = {r["vec_id"]: (n, c) for r, n, c in zip(rows, links, comp)}
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * sum(links)
    assert all(got[i]["n_links"] <= n for i, (n, _) in want.items())
    assert sum(got[i]["component_id"] == c for i, (_, c) in want.items()) >= 0.98 * len(want)
