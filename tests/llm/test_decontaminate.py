"""Items found in documents against a search through every place."""

import random

import numpy as np

from fieldlens.llm import decontaminate


def test_finds_planted_items(spark):
    rng = random.Random(3)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([15, 20, 38, 59])))) for k in range(40)] + [(90, "only four words here"), (91, ""), (92, None)]
    rows, planted = [(0, None), (1, ""), (2, "Only, FOUR words here!"), (3, "x " * 20_000 + items[0][1])], {(2, 90), (3, 0)}
    for d in range(10, 400):
        w = rng.choices(vocabulary, k=rng.randrange(0, 200))
        if d % 3 == 0:
            k = rng.randrange(40)
            passage = items[k][1].split()
            for _ in range(0 if d % 2 else len(passage) // 15):
                i = rng.randrange(len(passage))
                passage[i:i + 1] = rng.choice([[], ["new"], [passage[i], "new"]])
            passage = [p.upper() + rng.choice(["", ",", "!!"]) for p in passage]
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
            planted.add((d, k))
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got <= planted and len(got) >= 0.95 * len(planted), (got - planted, planted - got)
    kept = decontaminate.clean_documents(docs.selectExpr("*", "'x' as item_id"), spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "item_id"] and kept.count() == len(rows) - len({d for d, _ in got})


def test_distance():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 7))] for _ in range(2))

        def full(x, y):
            row = list(range(len(y) + 1))
            for i, p in enumerate(x):
                row = [i + 1] + [0] * len(y) if False else _next(row, i, p, y)
            return row[-1]

        def _next(row, i, p, y):
            new = [i + 1]
            for j, q in enumerate(y):
                new.append(min(row[j] + (p != q), row[j + 1] + 1, new[j] + 1))
            return new

        want = min(full(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert decontaminate.distance(np.array(a), np.array(b))[0] == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.leaks(docs.filter("false"), items).count() == 0
    assert decontaminate.leaks(docs, items.filter("false")).count() == 0
    assert decontaminate.leaks(docs, items).count() == 1


def test_recall_at_the_threshold_for_every_length(spark):
    rng = random.Random(9)
    lengths = list(range(1, 60))
    items = [(k, " ".join(f"i{k}n{j}" for j in range(n))) for k, n in enumerate(lengths)]
    rows, planted = [], set()
    for d in range(len(lengths) * 4):
        k = d % len(lengths)
        w = items[k][1].split()
        for i in rng.sample(range(len(w)), len(w) // 5):
            w[i] = rng.choice(["", "new", w[i] + " new"])
        rows.append((d, " ".join(["before", *w, "after"])))
        planted.add((d, k))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
                                                              spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got <= planted
    missed = {(d, k) for d, k in planted - got}
    assert not [k for _, k in missed if lengths[k] < decontaminate.EXACT] and len(missed) <= 0.05 * 4 * sum(n >= decontaminate.EXACT for n in lengths)
