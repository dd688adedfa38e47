"""Line dedup over the whole corpus against a plain loop."""

import random
import re

from staffwise.llm import substring_dedup as S


def brute(rows, min_words):
    """rows: (id, text) with ids that may be null, none repeated.  Spans to remove per row."""
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        runs, last, k = [], None, 0
        for m in re.finditer(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", rows[i][1] or ""):
            n = " ".join(m[0].lower().split())
            if not n:
                continue
            if n in first:
                if last == k - 1 and runs:
                    runs[-1][1] = m.end()
                    runs[-1][2] += len(n.split(" "))
                else:
                    runs.append([m.start(), m.end(), len(n.split(" ")), first[n]])
                last = k
            else:
                first[n] = (rows[i][0], m.start())
            k += 1
        out += [(rows[i][0], s, e, w, *f) for s, e, w, f in runs if w >= min_words]
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgé🙂", k=rng.randint(1, 6)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(3, 14))).capitalize() + rng.choice([".", "!", "?", "...", ""])
    texts = [None, "", " \n\n ", ".", "one", "One. Two! one. TWO!"]
    passage = " ".join(sentence() for _ in range(8))
    for i in range(60):
        own = [sentence() for _ in range(rng.randint(1, 12))]
        if i % 3 == 0:
            own.insert(rng.randrange(len(own) + 1), passage if i % 2 else passage.upper().replace(" ", "  "))
        texts.append(rng.choice([" ", "\n"]).join(own))
    texts += [texts[10], texts[20] + "\n" + texts[21], "Is so. " * 400, "\n".join([sentence()] * 5), " ".join(word() for _ in range(50_000))]
    return [(i if i != 9 else None, t) for i, t in enumerate(texts)]


def test_spans_and_cut_text(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, `start` string, h int").repartition(4)
    for least in (1, 15):
        got = S.repeated_spans(df, min_words=least).collect()
        want = brute(rows, least)
        assert sorted(((r["id"], r["start"], r["end"], r["n_words"], r["kept_id"], r["kept_start"]) for r in got), key=repr) == want
    out = S.remove_repeats(df, min_words=15)
    assert out.columns == ["doc_id", "text", "start", "h", "removed_spans"]
    text = dict(rows)
    cut = {}
    for i, s, e, *_ in brute(rows, 15):
        cut.setdefault(i, []).append((s, e))
    for r in out.collect():
        spans = sorted(cut.get(r["doc_id"], []))
        assert [tuple(x) for x in r["removed_spans"]] == spans
        t = text[r["doc_id"]]
        for s, e in reversed(spans):
            t = t[:s] + t[e:]
        assert r["text"] == t


def test_short_whole_lines(spark):
    rows = [(1, "Share this\nOne. Two!\nYes.\nA line of its own here."), (2, "Fresh one.\nshare  THIS\nOne. Two!\nmore text"),
            (3, "Yes. share this"), (4, "Two! One.\nYes.\n\nYes.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    got = sorted((r["id"], text[r["id"]][r["start"]:r["end"]], r["kept_id"]) for r in S.repeated_spans(df, whole_lines=True).collect())
    assert got == [(2, "share  THIS\nOne. Two!\n", 1), (4, "Yes.\n\nYes.", 1)]
    assert [r["text"] for r in S.remove_repeats(df, whole_lines=True).orderBy("doc_id").collect()] == [rows[0][1], "Fresh one.\nmore text", rows[2][1], "Two! One.\n"]


def test_whole_lines_of_a_corpus(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["id"], p) for r in S.repeated_spans(df, whole_lines=True).collect() for p in range(r["start"], r["end"])}
    seen, want = set(), {(i, p) for i, s, e, *_ in brute(rows, 15) for p in range(s, e)}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for m in re.finditer(r"[^\n]+\n*", t or ""):
            n = " ".join(m[0].lower().split())
            want |= {(i, p) for p in range(*m.span())} if n in seen else set()
            seen |= {n} - {""}
    assert got == want


def test_equal_rows_are_one_document(spark):
    long = " ".join(f"w{i}" for i in range(30)) + "."
    df = spark.createDataFrame([(1, long), (1, long), (2, "Fresh text of its own."), (1, "other " + long)], "doc_id long, text string")
    assert S.repeated_spans(df).count() == 0
    assert S.remove_repeats(df.union(spark.createDataFrame([(5, long)], df.schema))).filter("text = ''").count() == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.repeated_spans(df).count() == 0 and S.remove_repeats(df).count() == 0
