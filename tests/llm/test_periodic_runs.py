"""Runs against a check of all periods at all places, odd texts, clashing columns and a long text."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np

from fieldlens.llm import periodic_runs


def plain(words):
    """All maximal runs by looking at every period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)  # the smallest comes first
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def digest(doc_id, text):
    words = (text or "").encode().split()
    words = periodic_runs.looped(words, doc_id)
    runs = plain(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def texts(rng):
    yield from [None, "", " \n ", "a", "a a a a a", "a a a a a a", "x a a a a a a a y", "\xa0 \xa0 \xa0 \xa0 \xa0 \xa0", "A a A a A a A a", "a b " * 3 + "a",
                "a b " * 4, "a a b " * 5 + "a a", ("a b " * 4 + "c ") * 5, "a\nb\tc\r" * 6, "é\x0bé\x0cé é é é é", "a b c d " * 4 + "b c d a " * 4]
    for k in range(150):
        alphabet = [f"w{i}" for i in range(rng.choice([1, 2, 3, 5, 40]))]
        words = []
        while len(words) < rng.randint(1, 150):
            if rng.random() < 0.4:
                words += [rng.choice(alphabet) for _ in range(rng.randint(1, 20))] * rng.randint(1, 9)
            words += [rng.choice(alphabet) for _ in range(rng.randint(0, 15))] + ["rare%d" % rng.randint(0, 99)] * (rng.random() < 0.3)
        yield " ".join(words)


def test_digest_against_every_period(spark):
    rng = random.Random(7)
    rows = [(i, t) for i, t in enumerate(texts(rng))]
    rows += [(i, "".join(rng.choice("ab ") for _ in range(90))) for i in range(1000, 1040)] + [rows[14], (5, "a a a b b b " * 9)]
    got = periodic_runs.op11(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((digest(*r) for r in rows), key=str)
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 5  # rewritten texts are among them


def test_columns_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "b a a a a a a", "k", 7), (1, None, None, None)], "doc_id long, text string, collapsed string, extra int")
    got = {r.doc_id: r for r in periodic_runs.find_runs(docs).collect()}
    assert got[None].collapsed == "b a" and got[None].runs[0].asDict() == {"start": 1, "length": 6, "period": 1} and got[None].extra == 7
    assert got[1].n_words == 0 and got[1].runs == [] and got[1].collapsed == ""
    assert periodic_runs.op11(docs.filter("false")).count() == 0
    assert {r.doc_id: r.n_runs for r in periodic_runs.op11(docs).collect()} == {None: 1, 1: 0}


def test_splitting_leaves_only_what_can_run():
    word = np.array([0, 1, 0, 1, 0, 1, 0, 1, 2, 0, 1, 0, 1, 0, 1, 3, 3, 3, 3, 3, 3])
    at = periodic_runs.split_by_frequency(word, np.zeros(len(word), np.int64))
    # the second stretch of 0 1 has each word three times once 2 and 3 have split it off
    assert at.tolist() == [0, 1, 2, 3, 4, 5, 6, 7, 15, 16, 17, 18, 19, 20]


def test_long_text_of_few_words_is_not_quadratic():
    rng = np.random.default_rng(1)
    word = np.concatenate([rng.integers(0, 2, 300_000), np.tile(rng.integers(0, 2, 50_000), 5)])
    start = time.time()
    s, n, q = periodic_runs.runs_in(word, np.zeros(len(word), np.int64))
    assert time.time() - start < 30
    long = [(a, b, c) for a, b, c in zip(s.tolist(), n.tolist(), q.tolist()) if c > 1000]
    assert len(long) == 1 and long[0][2] == 50_000 and long[0][1] >= 250_000
