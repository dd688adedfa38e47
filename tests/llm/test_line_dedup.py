"""Line dedup against a loop."""

import random
from collections import Counter

from staffwise.llm.line_dedup import line_dedup


def clean(line):
    out = []
    for c in line:
        c = " " if c in "\t\r\f" else c
        if not (c == " " and out and out[-1] == " "):
            out.append(c)
    return "".join(out).strip(" ")


def brute(rows, ratio, least=1, once=False):
    pages = set(rows) if once else rows
    total, seen = Counter(h for h, _ in pages), Counter()
    for h, t in pages:
        if h is not None and t is not None:
            seen.update((h, x) for x in {clean(line) for line in t.split("\n")} if x)
    out = []
    for h, t in rows:
        if t is None or h is None:
            out.append((t, 0))
            continue
        lines = t.split("\n")
        keep = [x for x in lines if not (clean(x) and seen[h, clean(x)] >= least and seen[h, clean(x)] > ratio * total[h])]
        out.append(("\n".join(keep), len(lines) - len(keep)))
    return out


def test_matches_a_loop(spark):
    rng = random.Random(0)
    common = ["Menu", "About us", "© all rights"]
    rows = [(None, "Menu\nx"), (None, None), ("a", None), ("a", ""), ("solo", "Menu\nown"), ("a", "Menu\r\nMenu\n  Menu \n\nbody"), ("a", "x\n" * 50_000)]
    for _ in range(200):
        h = rng.choice(["a", "a", "a", "b", "c"])
        body = [f"line {rng.randint(0, 40)}" for _ in range(rng.randint(0, 6))] + [c for c in common if rng.random() < 0.25]
        rng.shuffle(body)
        rows.append((h, rng.choice(["\n", "\n\n", " \n"]).join(body)))
    rows += rows[20:30] + [("b", "a page\ntaken often")] * 90
    df = spark.createDataFrame([(i, h, t, "z", "y") for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string, host string, N_Removed string").repartition(3)
    for options in ({}, {"max_ratio": 0.2, "min_pages": 3, "equal_texts_once": True}, {"max_ratio": 0.0}, {"max_ratio": 1.0}):
        got = sorted(line_dedup(df, **options).collect())
        want = brute(rows, options.get("max_ratio", 0.2), options.get("min_pages", 1), options.get("equal_texts_once", False))
        assert [(r["text"], r["n_removed"]) for r in got] == want
    assert line_dedup(df, removed=None).columns == df.columns
    assert line_dedup(df.limit(0)).count() == 0


def test_pages_are_counted_not_texts(spark):
    rows = [("h", "head\nown")] * 40 + [("h", f"page {i}") for i in range(60)] + [("two", "x\ny"), ("two", "x\nz")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, text string")
    got = {(r["source"], r["n_removed"]) for r in line_dedup(df, max_ratio=0.5).collect()}
    assert got == {("h", 0), ("two", 1)}
    assert line_dedup(df, max_ratio=0.2).filter("source = 'h' AND n_removed = 2 AND text = ''").count() == 40


def test_a_page_of_many_boilerplate_lines(spark, monkeypatch):
    from staffwise.llm import line_dedup as L
    monkeypatch.setattr(L, "BROADCAST_LINES", 10)
    body = "\n".join(f"line {i}" for i in range(20_000))
    df = spark.createDataFrame([(1, "h", body + "\n\nmine"), (2, "h", "\n" + body), (3, "h", "other")], "doc_id long, source string, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup(df, max_ratio=0.5).collect()}
    assert got == {1: ("\nmine", 20_000), 2: ("", 20_000), 3: ("other", 0)}
