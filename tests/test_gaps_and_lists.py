"""Gaps of crowded sequences and closest list values against plain Python."""

import difflib
import random

import pytest

from fieldlens.functions.text import plain_phrase_key
from fieldlens.plans import layer_qa_second as second


def test_gaps(spark):
    rng = random.Random(2)
    zones = {"A": set(range(1, 3000)) - {rng.randrange(1, 3000) for _ in range(60)}, "B": {7}, "C": {1, 2, 3}, "D": {10 ** 12, 5}, "E": set(rng.sample(range(1, 500), 250))}
    rows = [(z, n) for z, numbers in zones.items() for n in numbers] + [(None, 4)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {r.zone: (r.n_missing, list(r.first_missing)) for r in second.sequence_gaps(spark.createDataFrame(rows, "zone string, n long"), "zone", "n").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {z: [k for k in range(1, max(n)) if k not in n] for z, n in zones.items() if z not in "CD"}
    assert {z: v for z, v in got.items() if z != "D"} == {z: (len(m), m[:15]) for z, m in want.items() if m}
    assert got["D"] == (10 ** 12 - 2, [1, 2, 3, 4, *range(6, 17)])


@pytest.mark.parametrize("cutoff", [0.7, 0.8, 0.88])
def test_closest_values_are_those_of_a_full_search(spark, cutoff):
    rng = random.Random(int(cutoff * 100))
    word = lambda: "".join(rng.choice("abcdé -") for _ in range(rng.randint(1, 12))).strip() or "a"
    lists = {"f": [word() for _ in range(60)], "g": ["", "ab", "abab", "baba"] + [word() for _ in range(20)], "none": []}
    tokens = set()
    for f, values in lists.items():
        for v in values + [word() for _ in range(30)]:
            chars = list(v)
            for _ in range(rng.randint(0, 2)):
                chars.insert(rng.randint(0, len(chars)), rng.choice("abcdé"))
                if rng.random() < 0.5:
                    chars.pop(rng.randrange(len(chars)))
            tokens.add((f, "".join(chars)))
    want = {}
    for f, t in tokens:
        keys = {plain_phrase_key(v): v for v in lists[f]}
        hit = difflib.get_close_matches(plain_phrase_key(t), list(keys), n=1, cutoff=cutoff)
        if hit:
            want[f, t] = keys[hit[0]]
    got = second.closest_values(spark.createDataFrame(sorted(tokens), "field string, token string"), lists, cutoff)
    assert {(r.field, r.token): r._close for r in got.collect()} == want
