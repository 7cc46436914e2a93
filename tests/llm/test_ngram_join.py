"""Components of the n-gram join against comparing all pairs."""

import random

import pytest

from fieldlens.llm import ngram_join


def brute(rows, n, percent):
    def grams(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()

    sets = [(d, grams(t)) for d, t in rows]
    comp = list(range(len(sets)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                comp[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, len(s), low[root(i)]) for i, (d, s) in enumerate(sets))


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_components(spark, n, percent):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    rows, i = [(0, None), (1, ""), (2, "one"), (3, "ONE"), (4, "one two"), (5, " \n ")], 6
    shared = " ".join(rng.choices(words, k=30))
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([4, 12, 40, 120, 300]))
        for _ in range(rng.choice([1, 2, 6, 12])):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 30) + 2)):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((i, " ".join(w) + rng.choice(["", " " + shared, ""])))
            i += 1
    got = ngram_join.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n=n, percent=percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, n, percent)


def test_bits_and_fragments_never_lose_a_link():
    for percent in (80, 90):
        for size in range(1, 400):
            own = ngram_join.size_class(size, percent)
            for other in range(-(-size * percent // 100), size + 1):
                cls = ngram_join.size_class(other, percent)
                assert own - cls in (0, 1)
                least = -(-(size + other) * percent // (100 + percent))
                assert size + other - 2 * least < ngram_join.fragments_of(own, percent)


def test_one_of_each(spark):
    rows = [(5, "a b c d e f g", "p"), (3, "a b c d e f g", "q"), (3, "a b c d e f g", "q"), (9, "z y x w v u t", "r"), (None, "n", "s"), (8, None, "t")]
    got = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted((r.doc_id or -1, r.lang) for r in got.collect()) == [(-1, "s"), (3, "q"), (8, "t"), (9, "r")]


def test_links_are_counted_in_full(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    texts = [" ".join(w if k != 8 * i else "new" for k, w in enumerate(base)) for i in range(20)]
    texts += texts[:3] + ["a b c d", "a b c d", "other words stay alone", "", None]
    rows = list(enumerate(texts)) + [(2, texts[5])]
    rng.shuffle(rows)

    def grams(t):
        w = (t or "").split()
        return {tuple(w[i:i + 3]) for i in range(len(w) - 2)}

    sets = [(d, grams(t)) for d, t in rows]
    want = sorted((d, sum(bool(a) and i != j and 100 * len(a & b) >= 90 * len(a | b) for j, (_, b) in enumerate(sets))) for i, (d, a) in enumerate(sets))
    got = ngram_join.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), n=3, percent=90).collect()
    assert sorted((r.doc_id, r.n_links_found) for r in got) == want and max(n for _, n in want) == 23


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_linked_sets_share_a_key_and_stay_candidates(n, percent):
    """Without empty fragments every linked pair still meets, and the bound by parity bits rules none out."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(percent)
    texts = []
    for size in (3, 6, 9, 14, 25, 60, 150, 400, 1000, 2500):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randint(0, 1 + size * (100 - percent) // (220 * n) * 2)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            texts.append(" ".join(w[:len(w) - rng.randint(0, size // 12)]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    sets = ngram_join.shingle_sets(batch.column("text"), n)
    keys, linked = {}, 0
    for out in ngram_join._keyed(n, percent)([batch]):
        for k, node in zip(*(c.to_pylist() for c in out.columns)):
            keys.setdefault(node, set()).add(k)
    bits = [np.frombuffer(b, np.uint64) for out in ngram_join._measured(n)([batch]) for b in out.column("bits").to_pylist()]
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(np.intersect1d(a, sets[j]))
            if shared * 100 >= (len(a) + len(sets[j]) - shared) * percent:
                x, y = (int(ngram_join.class_of(s)) for s in (a, sets[j]))
                linked += x != y
                assert x == y or keys[x] & keys[y]
                assert int(np.bitwise_count(bits[i] ^ bits[j]).sum()) * (100 + percent) <= (len(a) + len(sets[j])) * (100 - percent)
    assert linked > 50


def test_large_sets_with_common_phrases_are_no_candidates():
    """Texts that share phrases but little else: few keys in common, and parity bits in their own width rule them out where they meet."""
    import pyarrow as pa

    rng = random.Random(11)
    phrases = [" ".join(f"p{rng.randrange(10 ** 6)}" for _ in range(9)) for _ in range(20)]
    texts = [" ".join(phrases + [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]) for size in (1800, 1900, 2000, 2100)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    measured = [r for out in ngram_join._measured(5)([batch]) for r in out.to_pylist()]
    keys = {}
    for out in ngram_join._keyed(5, 80)([batch]):
        for k, node in zip(*(c.to_pylist() for c in out.columns)):
            keys.setdefault(node, set()).add(k)
    own = [ngram_join.size_class(r["size"], 80) for r in measured]
    assert [len(keys[r["node"]]) for r in measured] == [sum(ngram_join.differences(c, 80) + 1 for c in (k, k + 1)) for k in own]
    columns = [c for c in measured[0] if c not in ("doc_id", "node")]
    met = pa.RecordBatch.from_pylist([{"key": 1, "a": r["node"], "b": measured[0]["node"]} | {f"{e}_{c}": x[c] for e, x in (("a", r), ("b", measured[0])) for c in columns}
                                      for r in measured[1:]])
    assert sum(out.num_rows for out in ngram_join._likely(80)([met])) == 0
