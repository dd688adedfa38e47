"""Packing: ids, cuts, gapless sequences, and the plan against a lower bound."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from staffwise.llm import packing, queries

FILE = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, docs, capacity, end_id=2):
    """rows of pack(); docs: texts in order.  Returns the number of sequences."""
    tok = Tokenizer.from_file(FILE)
    want = sorted(tuple(tok.encode(t or "", add_special_tokens=False).ids + [end_id]) for t in docs)
    by_seq = defaultdict(list)
    for r in rows:
        assert 1 <= r["length"] <= capacity
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    return by_seq, want


@pytest.mark.parametrize("capacity", [16, 64])
def test_pack_small_table(spark, capacity):
    rng = random.Random(3)
    texts = [None, "", " ", "<|endoftext|>", "a <|endoftext|> b", "naïve 漢字 🙂", "word " * 200] + [
        " ".join(rng.choice(["alpha", "beta", "of", "x"]) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    rows = [(i, t, 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(4)
    got = packing.pack(df, FILE, capacity=capacity).collect()
    by_seq, want = check(got, texts, capacity)
    docs = defaultdict(list)
    for r in got:
        docs[r["doc_id"]].append(r)
    assert len(docs) == len(texts)
    built = []
    for pieces in docs.values():
        pieces.sort(key=lambda r: r["piece"])
        ids = []
        for k, r in enumerate(pieces):
            assert (r["piece"], r["start"], r["length"]) == (k, len(ids), len(r["ids"]))
            assert len(r["ids"]) == capacity or k == 0
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            ids += r["ids"]
        built.append(tuple(ids))
    assert sorted(built) == want
    assert len(by_seq) <= brute_best_fit([r["length"] for r in got], capacity)


def test_repeated_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "same"), (None, "same"), (4, "same"), (4, None)], "doc_id long, text string")
    got = packing.pack(df, FILE, capacity=8).collect()
    assert len(got) == 4
    check(got, ["same", "same", "same", None], 8)
    assert packing.pack(df.limit(0), FILE).count() == 0


@pytest.mark.parametrize("name", ["Piece", "lo", "task"])
def test_id_columns_named_like_others(spark, name):
    df = spark.createDataFrame([(7, "one two"), (7, None), (8, "three")], f"{name} long, text string")
    got = packing.pack(df, FILE, id_col=name, capacity=8)
    assert got.columns == [name, "piece_" if name == "Piece" else "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"]
    assert sorted(r[0] for r in got.collect()) == [7, 7, 8]


def test_shuffled_counts_give_the_same_lengths(spark):
    df = spark.createDataFrame([(i, "w " * (i % 40)) for i in range(200)], "doc_id long, text string").repartition(3)
    a, b = (packing.pack(df, FILE, capacity=32, broadcast_rows=n).collect() for n in (10**6, 0))
    assert len(check(a, [], 32)[0]) == len(check(b, [], 32)[0])
    assert sorted((r["doc_id"], r["piece"]) for r in a) == sorted((r["doc_id"], r["piece"]) for r in b)


def brute_best_fit(lengths, capacity):
    """Best fit decreasing, one piece at a time."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            g = min(fit)
            gaps.remove(g)
        else:
            g = capacity
        gaps.append(g - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_everything_and_is_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 30, 100, 1024])
    counts = {rng.randint(1, cap): rng.randint(1, 40) for _ in range(rng.randint(0, 30))}
    bins = packing.plan(counts, cap)
    used = defaultdict(int)
    for b in bins:
        assert b.n > 0 and sum(n * k for n, k in b.held) <= cap
        assert sum(k for n, k in b.held if 3 * n > cap) <= 2
        for n, k in b.held:
            used[n] += k * b.n
    assert used == counts
    lengths = [n for n, c in counts.items() for _ in range(c)]
    assert sum(b.n for b in bins) <= brute_best_fit(lengths, cap) * 1.02 + 1
    spots = packing.places(bins)
    for n in counts:
        spans = sorted((lo, hi) for m, lo, hi, *_ in spots if m == n)
        assert spans[0][0] == 0 and spans[-1][1] == counts[n] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_fast_ids_equal_the_tokenizers_ids(spark):
    enc, tok = packing.Encoder(FILE), Tokenizer.from_file(FILE)
    assert enc.fast is not None
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["", "<|endoftext|>x", "a" * 200_000, " " * 50_000 + "x", "\n" * 5000, *[f"a{chr(c)}b {chr(c)}{chr(c)} {chr(c)}'s" for c in range(0x500)]]
    for t in texts:
        assert enc(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op9_packing(spark, sf).collect()
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    by_seq, want = check(got, docs, 1024)
    assert len(by_seq) <= brute_best_fit([r["length"] for r in got], 1024)
    assert sum(r["length"] for r in got) == sum(map(len, want))
