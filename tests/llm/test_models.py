"""Toxicity and language ID: held-out accuracy, bundling, odd rows."""

import numpy as np
import pytest

from staffwise.llm import langid, queries, toxicity

ODD = [None, "", " \n", "123 !?", "a", "É", "漢字", "x" * 100_000, "word " * 50_000]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op6_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic, clean = [r for r in rows if r["toxic"] == 1], [r for r in rows if r["toxic"] == 0]
    assert len(toxic) > 50 and sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_toxicity_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(i % 5 or None, t, "s") for i, t in enumerate(ODD)], "doc_id long, text string, Score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0)):
        m = toxicity.fit(docs, lab)
        out = toxicity.score(docs, m)
        assert out.columns == ["doc_id", "text", "score"]
        assert all(0 <= r["score"] <= 1 for r in out.collect()) and out.count() == len(ODD)
    assert toxicity.score(docs.limit(0), toxicity.Model({}, 0.0)).count() == 0


def test_nnpu_recovers_the_positive_feature():
    rng = np.random.default_rng(0)
    u = rng.random(4000) < 0.2  # the unlabelled texts' hidden classes
    rows = [np.array([0, 2]) if p else np.array([1, 2]) for p in [*[True] * 500, *u]]
    w, b = toxicity.fit_nnpu(rows, np.array([1] * 500 + [0] * 4000), 3, 0.2)
    assert b + w[0] + w[2] > 0 > b + w[1] + w[2]


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op8_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


def test_language_odd_rows(spark):
    train = spark.createDataFrame([("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), (None, "de"), ("no letters: 12".replace("no letters: ", ""), "es"), ("x y", None)],
                                  "text string, lang string")
    languages, profiles = langid.fit_profiles(train, "text", "lang")
    assert languages == ["en", "fr"] and profiles.shape == (2, 2048)
    docs = spark.createDataFrame([(i % 5 or None, t, "k") for i, t in enumerate(ODD + ["the mat", "la table"])], "doc_id long, text string, Lang_Pred string")
    rows = {r["text"]: r for r in langid.predict(docs, languages, profiles).collect()}
    assert all(rows[t]["lang_pred"] == "und" and rows[t]["score"] == 0 for t in (None, "", " \n", "123 !?"))
    assert rows["the mat"]["lang_pred"] == "en" and rows["la table"]["lang_pred"] == "fr"
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert {r["lang_pred"] for r in langid.predict(docs, [], np.zeros((0, 2048))).collect()} == {"und"}
    assert langid.fit_profiles(train.limit(0), "text", "lang")[0] == []
    with pytest.raises(ValueError, match="languages"):
        langid.fit_profiles(train, "text", "lang", max_languages=2)


def test_score_is_the_cosine_of_the_bundled_vectors():
    letters = langid.letter_vectors(2048, 17)
    text = "Some text, and a Ünïcode word; some more text."
    bundle = langid.ngram_vectors(langid.ngram_codes(text, 3), 3, letters).astype(float).sum(0)
    profiles = np.random.default_rng(1).standard_normal((3, 2048))
    profiles /= np.linalg.norm(profiles, axis=1, keepdims=True)
    dots = langid._Scorer(profiles, 3, 2048, 17).dots(langid.ngram_codes(text, 3))
    assert np.allclose(dots, profiles @ bundle)
    c = langid.ngram_codes("abc", 3)[1:2]  # the n-gram a, b, c after the opening gap
    a, b, d = letters[1], letters[2], letters[3]
    assert (langid.ngram_vectors(c, 3, letters)[0] == np.roll(a, 2) * np.roll(b, 1) * d).all()


def test_language_query_against_a_plain_loop(spark, tmp_dir):
    import zlib
    rng = np.random.default_rng(4)
    alphabets = {"aa": "abcdef", "bb": "defghi", "cc": "xyzabc", None: "abcxyz"}
    rows = [(i, " ".join("".join(rng.choice(list(alphabets[g]), 5)) for _ in range(rng.integers(0, 12))), g) for i in range(120) for g in [list(alphabets)[i % 4]]]
    rows += [(200 + i, "".join(chr(0x430 + k) for k in rng.integers(0, 32, 9)), None) for i in range(60)] + [(300, None, "aa")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_dir}/documents.parquet")
    letters = langid.letter_vectors(2048, 17)

    def bundle(text, scaled=False):
        codes = langid.ngram_codes(text or "", 3)
        u, c = np.unique(codes, return_counts=True)
        v = sum((k * x for k, x in zip(c, langid.ngram_vectors(u, 3, letters).astype(float))), np.zeros(2048))
        return v / np.sqrt((c * c).sum()) if scaled and len(c) else v

    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    names = ["aa", "bb", "cc"]
    protos = np.stack([sum(bundle(t, True) for i, t, g in rows if g == name and not held(i)) for name in names])
    protos /= np.linalg.norm(protos, axis=1, keepdims=True)
    got = {r["doc_id"]: r for r in queries.op8_language_id(spark, tmp_dir).collect()}
    negative = 0
    for i, t, _ in rows:
        dots = protos @ bundle(t)
        known = len(langid.ngram_codes(t or "", 3)) > 0
        assert got[i]["held_out"] == held(i)
        assert got[i]["lang_pred"] == (names[int(dots.argmax())] if known else "und")
        near = np.maximum(dots, 0)
        assert abs(got[i]["score"] - (near.max() / near.sum() if known and near.sum() > 0 else 0)) < 1e-9
        negative += known and dots.max() < 0
    assert len(got) == len(rows) and negative > 3


def test_toxicity_query_against_a_plain_loop(spark, tmp_dir):
    import math
    import zlib
    rng = np.random.default_rng(5)
    mild, harsh = [f"word{i}" for i in range(60)], [f"harsh{i}" for i in range(6)]
    docs, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        words = list(rng.choice(mild, 12)) + (list(rng.choice(harsh, 3)) if toxic else [])
        docs.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    docs.append((8, docs[8][1] + " harsh0"))  # an id of two rows
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    from pyspark.sql import functions as F
    hashes = {r["text"]: r["h"] for r in spark.createDataFrame([(t,) for _, t in docs], "text string").select("text", F.xxhash64("text").alias("h")).collect()}

    learn = lambda i: zlib.crc32(str(i).encode()) % 5 != 0
    text = {}
    for i, t in docs:
        if i not in text or hashes[t] < hashes[text[i]]:
            text[i] = t
    pos = [text[i] for i, y in labels if y and learn(i)]
    unl = [text[i] for i in text if learn(i)]
    prior = np.mean([y for i, y in labels if learn(i)])
    count = lambda texts: {f: sum(f in toxicity.text_features(t) for t in texts) for f in {f for t in texts for f in toxicity.text_features(t)}}
    p, u = count(pos), count(unl)
    chosen = []
    for f, n in p.items():
        expected = (u.get(f, 0) + 1) * len(pos) / len(unl)
        if n >= 4 and n > expected and 2 * (n * math.log(n / expected) - (n - expected)) >= 12:
            chosen.append(f)
    number = {f: k for k, f in enumerate(sorted(chosen))}
    rows = [np.array(sorted(number[f] for f in toxicity.text_features(t) if f in number), dtype=int) for t in pos + unl]
    w, b = toxicity.fit_nnpu(rows, np.array([1] * len(pos) + [0] * len(unl)), len(number), prior)
    got = {}
    for r in queries.op6_toxicity(spark, tmp_dir).collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    want = {}
    for i, t in docs:
        z = b + sum(w[number[f]] for f in toxicity.text_features(t) if f in number and abs(w[number[f]]) > 1e-3)
        want.setdefault(i, []).append(1 / (1 + math.exp(-z)))
    assert len(number) >= 6 and all(np.allclose(sorted(got[i]), sorted(want[i]), atol=1e-5) for i in want)


def test_toxicity_sample_is_bounded_in_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(7, f"bad words {i}") for i in range(300)] + [(i, "other text") for i in range(8, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit_nnpu", lambda rows, y, n, prior: seen.append((len(rows), int(sum(y)))) or (np.zeros(n), 0.0))
    toxicity.fit(docs, labels, max_positive=5, max_unlabelled=9)
    assert seen and seen[0][0] <= 14 and seen[0][1] <= 5
