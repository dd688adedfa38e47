"""Spelling variants against a comparison of all words."""

import random

import pytest

from staffwise.llm import spelling as P


def edit1(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio):
    out = {}
    for w, n in counts.items():
        near = [(-m, v) for v, m in counts.items() if edit1(w, v)]
        best = min(near) if near else None
        form = best[1] if best and -best[0] >= ratio * n else None
        out[w] = (n, len(near), form, counts[form] if form else None)
    for w in out:
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        out[w] += (root,)
    return out


@pytest.mark.parametrize("n1,n2", [(1, 4), (2, 3), (3, 1)])
def test_all_pairs_are_found(spark, n1, n2):
    rng = random.Random(n2)
    words = {"".join(rng.choices("abcé🙂×", k=rng.randint(1, 7))) for _ in range(500)} | {"", "a", "aaaaaaaaaa", "aaaaaaaaa", "abcdefghij", "bacdefghij"}
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {(r["a"], r["b"]) for r in P.near_pairs(df, n1, n2).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and edit1(a, b)}


def test_forms_and_roots(spark):
    rng = random.Random(3)
    counts = {"".join(rng.choices("abcdÿ", k=rng.randint(3, 6))): rng.choice([1, 2, 5, 9, 40, 300, 2000, 2000]) for _ in range(400)}
    chain = {"q" * 12 + "w" * i: 3 * 5 ** i for i in range(9)}  # each is the form of the one before
    counts.update(chain)
    rows = [(w, n - 1, "x") for w, n in counts.items() if n > 1] + [(w, 1, "x") for w in counts] + [(None, 5, "x"), ("zz", None, "x")]
    got = P.spelling_variants(spark.createDataFrame(rows, "word string, n long, root string").repartition(3)).collect()
    want = brute(counts, 5)
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == want and len(got) == len(want)
    assert want["q" * 12][4] == "q" * 12 + "w" * 8


def test_empty_table_and_bad_ratio(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert P.spelling_variants(empty).count() == 0
    with pytest.raises(ValueError):
        P.spelling_variants(empty, ratio=1)


def test_only_ascii_is_lowered(spark):
    df = spark.createDataFrame([("AbÀ É",), ("XYZ",), (None,)], "t string")
    assert [r[0] for r in df.select(P.ascii_lower(df["t"])).collect()] == ["abÀ É", "xyz", None]
