"""Run-length indexes and the removal of repeated bytes against brute force."""

import random
from collections import Counter

import numpy as np

from staffwise.llm import suffix_dedup as S


def brute(texts, length):
    """Per text the spans of bytes that lie in a string of ``length`` bytes standing at several places."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * (len(b) + 1)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        edges = [i for i in range(len(b) + 1) if gone[i] != (gone[i - 1] if i else False)]
        out.append(list(zip(edges[::2], edges[1::2])))
    return out


def test_run_index_against_sorted_suffixes():
    rng = random.Random(2)
    for _ in range(120):
        n, k = rng.randint(1, 250), rng.choice([1, 2, 4, 200])
        t = [rng.randrange(k) + 2 for _ in range(n)]
        t = (t + [1] + t[:n // 2] + [1] + t if rng.random() < 0.5 else t) + [0]
        text, size = np.array(t, np.int16), len(t)
        order = sorted(range(size), key=lambda i: t[i:])
        assert S.SuffixArray(text).order.tolist() == order
        index = S.RunIndex(text)
        bwt = [t[i - 1] for i in order]
        lengths = np.diff(np.r_[index.starts, size])
        assert np.repeat(index.heads, lengths).tolist() == bwt
        assert index.top.tolist() == [order[i] for i in index.starts]
        above, below = index.matching_statistics()

        def lcp(i, j):
            c = 0
            while max(i, j) + c < size and t[i + c] == t[j + c]:
                c += 1
            return c

        for r, p in enumerate(order):
            assert above[p] == (lcp(p, order[r - 1]) if r else 0)
            assert below[p] == (lcp(p, order[r + 1]) if r + 1 < size else 0)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    for _ in range(100):
        n, k, length = rng.randint(0, 400), rng.choice([1, 2, 20]), rng.randint(3, 60)
        gram = rng.randint(1, length)
        d = np.array([rng.randrange(k) for _ in range(n)], np.uint8)
        start, windows, place, _ = S.pieces(d, length, gram)
        assert windows.sum() == max(0, n - length + 1)
        anchors = {}
        for s, w, p in zip(start, windows, place):
            for i in range(w):
                assert anchors.setdefault(d[s + i:s + i + length].tobytes(), p - i) == p - i


def corpus(rng):
    word = lambda: "".join(rng.choices("abcdé🙂 ", k=rng.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(30)
    out = [None, "", "a", "x" * 300, "ab" * 200, text(4000)]
    out += [text(rng.randint(0, 40)) + passage + text(rng.randint(0, 40)) for _ in range(40)]
    out += [passage[:90] + text(20) for _ in range(20)] + [out[7]] * 4 + [out[9][5:], text(30)]
    return out


def test_removed_bytes(spark, monkeypatch):
    rng = random.Random(4)
    for length, gram, group, block in ((40, 12, 2000, 1 << 18), (40, 12, 3, 500), (25, 25, 2, 100)):
        texts = corpus(rng)
        monkeypatch.setattr(S, "BLOCK_BYTES", block)
        ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
        rows = [(i, t, "x", 1) for i, t in zip(ids, texts)] + [(1, texts[20], "x", 1)] * 2  # equal rows
        df = spark.createDataFrame(rows, "doc_id long, text string, kept string, tid int").repartition(5)
        out = S.remove_repeated_bytes(df, length=length, gram=gram, group_pieces=group)
        assert out.columns == ["doc_id", "text", "tid", "removed_spans", "kept"]
        texts = [r[1] for r in rows]
        want = {t: s for t, s in zip(texts, brute(texts, length))}
        got = out.collect()
        assert len(got) == len(rows)
        for r in got:
            spans = [(s["start"], s["end"]) for s in r["removed_spans"]]
            assert spans == want[r["text"]]
            if r["text"] is None:
                assert r["kept"] is None
            else:
                raw = r["text"].encode()
                cut = bytearray(raw)
                for a, b in reversed(spans):
                    del cut[a:b]
                assert bytes(r["kept"]) == bytes(cut)


def test_a_long_text_is_taken_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 64)
    rng = random.Random(5)
    base = "".join(rng.choices("abc", k=700))
    texts = [base, "zz" + base[100:500] + "q" * 90, base[333:], "".join(rng.choices("abc", k=500))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = S.remove_repeated_bytes(df, length=50, gram=20).orderBy("doc_id").collect()
    assert [[(s["start"], s["end"]) for s in r["removed_spans"]] for r in rows] == brute(texts, 50)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeated_bytes(df).count() == 0
