"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from staffwise.llm import runs as R
from staffwise.llm.queries import op11_periodic_runs


def brute(w, exponent=4, least=6):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size, s = j - i + q, w[i:j + q]
            if size >= max(least, exponent * q) and all(any(s[k] != s[k + p] for k in range(size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequence(rng):
    n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 5])
    w = [rng.randrange(k) for _ in range(n)]
    if rng.random() < 0.5 and n > 4:
        a = rng.randrange(n)
        p = 1 + (n - a) // (3 + rng.randrange(8))
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    return w


def test_tree_of_all_suffixes():
    rng = random.Random(5)
    for _ in range(100):
        s = [x + 1 for x in sequence(rng)] + [0]
        tree = R.SuffixTree(s, 6)
        n = len(s)
        assert sorted(range(n), key=lambda i: s[i:]) == np.argsort(tree.rank).tolist()
        turned = [9 - x if x else 0 for x in s]
        assert sorted(range(n), key=lambda i: turned[i:]) == np.argsort(tree.reversed_rank()).tolist()
        i, j = np.triu_indices(n, 1)
        want = [next((k for k in range(n) if s[a + k] != s[b + k]), 0) for a, b in zip(i, j)]
        assert tree.lce(i, j).tolist() == want


def test_runs_and_stretches():
    rng = random.Random(1)
    for _ in range(600):
        exponent, least = rng.choice([(4, 6), (2, 2), (3, 5), (2, 6), (4, 4)])
        docs = [sequence(rng), [7, 7, 7], sequence(rng)]
        for w in docs:
            assert [tuple(r) for r in R.runs(w, exponent, least).tolist()] == brute(w, exponent, least)
        first = np.r_[0, np.cumsum([len(w) for w in docs])]
        got = [[], [], []]
        for a, b in R.stretches(np.concatenate(docs).astype(np.int64), np.repeat([0, 1, 2], [len(w) for w in docs]), exponent, least):
            d = int(np.searchsorted(first, a, "right")) - 1
            got[d] += [(s + a - first[d], n, p) for s, n, p in R.runs(np.concatenate(docs)[a:b], exponent, least).tolist()]
        assert got == [brute(w, exponent, least) for w in docs]


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(R, "HELD_WORDS", 50)
    texts = [None, "", " \n\t ", "one", "a " * 9, "x a b a b\ta b a  b y", "a b " * 3000 + "c", "ä ö " * 5, "p " * 4, "a " * 9]
    df = spark.createDataFrame([(1, t, "r", 2) for t in texts], "doc_id long, text string, runs string, b int")
    out = R.periodic_runs(df)
    assert out.columns == ["doc_id", "text", "b", "runs", "collapsed"]
    got = out.collect()
    assert len(got) == len(texts)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        want = brute(words)
        assert [tuple(x) for x in r["runs"]] == want
        gone = {i for s, n, p in want for i in range(s + p, s + n)}
        assert r["collapsed"] == (None if r["text"] is None else " ".join(w for i, w in enumerate(words) if i not in gone))
    assert R.periodic_runs(df.limit(0)).count() == 0


def test_query_against_brute_force(spark, tmp_dir):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices("abcdefghij"[:rng.choice([2, 10])], k=rng.randint(0, 80))) if i % 17 else None) for i in range(200)] + [(5, "a a a a a a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (k - a) % p] if k >= a else x for k, x in enumerate(w)]
        found = brute(w)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
        gone = {k for s, m, p in found for k in range(s + p, s + m)}
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None, digest("".join(f"{s},{m},{p}\n" for s, m, p in found)),
                     digest(" ".join(x for k, x in enumerate(w) if k not in gone))))
    got = [tuple(r) for r in op11_periodic_runs(spark, tmp_dir).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] for r in want) > 20
