"""Features against plain slicing, ratios against plain counts, held-out accuracy, and odd tables."""

import random
import zlib

import numpy as np

from fieldlens.llm import toxicity

STEMS = ["blorg", "snrak", "wuffex", "grimpt"]


def corpus(n=700, seed=3):
    """Texts of syllables; those with a word of a bad stem are toxic. Stems come with endings that differ."""
    rng = random.Random(seed)
    syllables = ["ta", "ren", "lo", "mi", "sha", "ker", "un", "ost", "é", "pli"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.choice([3, 30, 300]))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = (rng.choice(STEMS) + rng.choice(["", "a", "ish", "er"])).upper()
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def plain_grams(text):
    """The n-grams as strings."""
    low = "".join(c if ord(c) >= 128 or c.isalnum() else " " for c in f" {text.lower()} ")
    return {low[i:i + n] for n in toxicity.SIZES for i in range(len(low) - n + 1) if " " not in low[i + 1:i + n - 1]}


def bucket(gram):
    value = 0
    for c in gram:
        value = (value * 0x100000001B3 + ord(c)) % 2 ** 64
    return (value * 0x9E3779B97F4A7C15) % 2 ** 64 >> (64 - toxicity.BITS)


def test_features_are_the_n_grams(monkeypatch):
    rng = random.Random(1)
    texts = ["", None, "a", "ab", " ", "Abc", "é€ 𝄞xyz!", "one,two\nthree"] + ["".join(rng.choice("abé .Z") for _ in range(rng.randint(0, 90))) for _ in range(60)]
    want = [sorted({bucket(g) for g in plain_grams(t or "")}) for t in texts]
    row, found = toxicity.features_of(texts)
    assert [found[row == k].tolist() for k in range(len(texts))] == want
    monkeypatch.setattr(toxicity, "BLOCK", 7)  # long texts come in blocks
    assert [toxicity.features_of([t])[1].tolist() for t in texts] == want


def test_counts_cover_all_labelled_texts(spark):
    docs, labels = corpus(60)
    train = spark.createDataFrame([(t, y) for (_, t), (_, _, y) in zip(docs, labels)], "text string, toxic int").repartition(3)
    got = {r.bucket: (r.toxic, r.clean) for r in toxicity._counts(train).collect()}
    want = {}
    for (_, t), (_, _, y) in zip(docs, labels):
        for b in {bucket(g) for g in plain_grams(t)}:
            pair = want.setdefault(b, [0, 0])
            pair[1 - y] += 1
    assert got == {b: tuple(v) for b, v in want.items() if sum(v) >= toxicity.SUPPORT}


def test_regression_reaches_its_optimum():
    rng = np.random.default_rng(5)
    x = [np.flatnonzero(rng.random(8) < 0.4) for _ in range(200)]
    y = np.array([int((3 in v) ^ (rng.random() < 0.2)) for v in x])
    ratio = np.array([0.5, -1, 2, 1.5, 0.1, -0.2, 3, 1])
    bias, weights = toxicity.fitted(x, y, ratio, y.mean())
    p = 1 / (1 + np.exp(-np.array([weights[v].sum() + bias for v in x])))
    slope = [np.mean([(a - b) * (j in v) for a, b, v in zip(p, y, x)]) * ratio[j] + toxicity.PENALTY * weights[j] / ratio[j] for j in range(8)]
    assert np.abs(slope).max() < 1e-4 and abs(np.mean(p - y)) < 1e-4


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    got = toxicity.op12(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.7) for r in got)
    truth = {i: y for i, _, y in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out]
    caught = [p for p, y in held if y]
    assert len(held) > 150 and sum(caught) >= 0.95 * len(caught) and sum(p for p, y in held if not y) <= 0.01 * len(held)


def test_labels_of_the_held_out_third_are_not_read(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    turned = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in labels]
    a, b = (sorted(toxicity.op12(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()) for x in (labels, turned))
    assert a == b


def test_odd_rows_and_tables(spark):
    docs, labels = corpus(200)
    odd = docs + [(None, "blorg text"), (7777, None), (7778, ""), (docs[0][0], docs[0][1]), (7779, "x" * 50_000 + " snrak " + "y " * 50_000)]
    rows = spark.createDataFrame([(i, t, "keep", 0.5) for i, t in odd], "doc_id long, text string, toxic string, score double")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (4, 0, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(rows, marks)
    out = toxicity.score(rows, model)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "toxic", "score"] and len(got) == len(odd)
    empty = {r.score for r in got if not r.text}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert {r.score > 0.5 for r in got if r.doc_id in (None, 7779)} == {True}
    for none, share in ((marks.filter("false"), 1 / 2), (marks.filter("toxic = 0 and doc_id < 10"), None)):
        scores = {r.score for r in toxicity.op12(rows, none).collect()}
        assert len(scores) == 1 and (share is None or scores == {share})
    assert toxicity.op12(rows.filter("false"), marks).count() == 0
