"""Counts and the base score against plain counting; the model against the base and as a distribution."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from fieldlens.llm import pitman_yor as py


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    stems = ["".join(rng.choices(["an", "th", "er", "io", "ne"], k=rng.randrange(1, 4))) for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "same Text"), (3, "same Text"), (4, "É ß 日本語 zz")]
    for d in range(10, 500):
        lang = d % 2
        rows.append((d, " ".join(rng.choice(stems[:150] if lang else stems[150:]) + ("A" if lang else "o") for _ in range(rng.randrange(1, 60)))))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def tokens(t):
    return [*(t or "").encode().lower().split(), py.END]


@pytest.mark.parametrize("frequent", [30_000, 20])
def test_counts_base_and_gain(spark, docs, frequent, monkeypatch):
    monkeypatch.setattr(py, "FREQUENT", frequent)
    rows = docs.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    c = Counter(w for r in rows if not held[r.doc_id] for w in tokens(r.text))
    n, v = sum(c.values()), len(c)
    want = sorted((r.doc_id, held[r.doc_id], len(tokens(r.text)), sum(c[w] > 0 for w in tokens(r.text)), n,
                   round(sum(log10((c[w] + 1) / (n + v + 1)) for w in tokens(r.text)), 6)) for r in rows)
    got = py.score_documents(docs).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    test = [r for r in got if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test) and all(r.score < 0 for r in got)


def test_byte_model_is_a_distribution():
    words = [b"abc", b"abd", b"x", b"abc"]
    flat = np.frombuffer(b"".join(words), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    _, room, dish = py.byte_cells(flat, at[:-1], at[1:])
    cells, n = np.unique(room * 257 + dish, return_counts=True)
    p = 10 ** py.byte_model(cells, n)
    assert np.allclose(p.sum(axis=1), 1)
    assert py.spelled(flat, at[:-1], at[1:], np.log10(p))[0] > 1e-3


def test_seating_has_the_mean_of_a_restaurant():
    rng, d, mass = np.random.default_rng(0), 0.5, 3.0
    for n in (1, 2, 15, 400):
        mean = np.mean(py.seated(np.full(4000, n), np.full(4000, mass), d, rng))
        sims = []
        for _ in range(400):
            t = 1
            for i in range(1, n):
                t += rng.random() < mass / (mass + i - d * t)
            sims.append(t)
        assert abs(mean - np.mean(sims)) < 0.05 * np.mean(sims) + 0.1


def test_empty(spark, docs):
    assert py.score_documents(docs.filter("false")).count() == 0


@pytest.mark.parametrize("frequent", [300_000, 2])
def test_every_word_before_is_a_restaurant(spark, frequent, monkeypatch):
    """Words before that end alike predict as differently as what follows them does."""
    monkeypatch.setattr(py, "FREQUENT", frequent)
    ids = [d for d in range(2000) if zlib.crc32(str(d).encode()) % 7 != 2]
    tests = [d for d in range(2000, 3000) if zlib.crc32(str(d).encode()) % 7 == 2]
    rows = [(d, "banana red x" if k % 2 else "havana blue x") for k, d in enumerate(ids[:400])]
    probes = ["banana red", "banana blue", "havana blue", "havana red", "new red", "banana qqq", "banana " + "qwertz" * 200]
    rows += list(zip(tests, probes))
    got = {r.doc_id: r for r in py.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    score = dict(zip(probes, (got[d].score for d in tests)))
    assert score["banana red"] > score["banana blue"] + 1 and score["havana blue"] > score["havana red"] + 1
    assert score["banana blue"] > score["banana qqq"] > score["banana " + "qwertz" * 200] > -np.inf


@pytest.mark.parametrize("frequent", [300_000, 2])
def test_words_of_a_context_sum_to_one(spark, frequent, monkeypatch):
    """Of the words after one, the known ones and an unknown one's share by its spelling take the whole."""
    monkeypatch.setattr(py, "FREQUENT", frequent)
    rng, ids = random.Random(3), [d for d in range(3000) if zlib.crc32(str(d).encode()) % 7 != 2]
    stems = [a + b for a in "abcd" for b in "efg"]
    docs = spark.createDataFrame([(d, " ".join(rng.choices(stems, range(1, 13), k=rng.randrange(9)))) for d in ids[:150]], "doc_id long, text string").repartition(3)
    parents, parent = [], py.Parent
    monkeypatch.setattr(py, "Parent", lambda *a: parents.append(parent(*a)) or parents[-1])
    models, letters = [], py.byte_model
    monkeypatch.setattr(py, "byte_model", lambda *a: models.append(letters(*a)) or models[-1])
    tests = [d for d in range(3000, 9000) if zlib.crc32(str(d).encode()) % 7 == 2]
    words = [*stems, "zq"]
    probes = spark.createDataFrame(list(zip(tests, [f"ae {w}" for w in words] + ["ae"] + [f"{w}" for w in words])), "doc_id long, text string")
    got = {r.doc_id: r.score for r in py.score_documents(docs.unionByName(probes)).collect()}
    last = {r["id"]: [r[f"p{k}"] for k in py.CHAINS] for r in parents[-1].often.unionByName(parents[-1].rare).collect()}
    bytes_of = [*(w.encode() for w in stems), py.END]
    flat = np.frombuffer(b"".join(bytes_of), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(w) for w in bytes_of])])
    base = py.spelled(flat, at[:-1], at[1:], models[0])
    for k in py.CHAINS:
        assert abs(sum(p[k] for p in last.values()) + parents[-1].fresh[k] * (1 - base.sum()) - 1) < 1e-9
    assert len(got) == 150 + len(words) * 2 + 1 and all(np.isfinite(x) and x < 0 for x in got.values())
