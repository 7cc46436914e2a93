"""The pipeline against a plain version of its stages on one small table."""

import random
import re

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from fieldlens.llm import quality_rules  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def good(text):
    """Kept text of a document by the quality rules, or None."""
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    twice = {w for w in windows if windows.count(w) > 1}
    hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    if len(words) < 50 or 100 * len(hit) > 50 * len(words):
        return None
    lines = [x for x in text.split("\n") if WORD.search(x)]

    def fails(x):
        return (re.search(quality_rules.NAVIGATION, x) or 20 * sum(c in "#*$%&|<>" for c in x) > len(x) or 40 * x.count("!!") > len(x)
                or re.search(quality_rules.BOILERPLATE, x) or (len(x) > 40 and not re.search(quality_rules.SENTENCE_MARK, x)))

    kept = [x for x in lines if not fails(x)]
    before, after = len("".join(words)), len("".join(WORD.findall("\n".join(kept))))
    return None if (before - after) * 2 > before else text if before == after else "\n".join(kept)


def grams(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def edits(item, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(item):
        new = [i + 1]
        for j, q in enumerate(text):
            new.append(min(row[j] + (p != q), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def table(rng):
    vocabulary = [f"{a}{b}" for a in ("an", "ther", "ion", "ess", "ly") for b in ("and", "o", "ing", "ed", "u", "en", "at", "is")]
    make = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ","]) for _ in range(n))
    rows, items = [], [(k, make(rng.choice([16, 30, 45]))) for k in range(6)]
    for d in range(90):
        kind = d % 9
        text = make(rng.randrange(60, 160)) + "."
        if kind == 1 and d > 9:
            w = rows[rng.randrange(len(rows))][1].split(" ")
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif kind == 2:
            text = text + " " + items[rng.randrange(6)][1] + " " + make(5)
        elif kind == 3:
            text = text + ' token = "' + "".join(rng.choices("0123456789abcdef", k=40)) + '" ' + make(4)
        elif kind == 4:
            text = text + "\nHome | News | About | Contact\n" + make(30) + "."
        elif kind == 5:
            text = rng.choice(["short.", "same again " * 60, "x### " * 80])
        elif kind == 6:
            text = text + " 4532123412341234 " + make(3)
        rows.append((d, text))
    return rows, items


def test_stages_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "decontamination", "secret_scan", "packing"]


def test_whole_pipeline(spark, tmp_path, monkeypatch):
    rows, items = table(random.Random(8))
    folder = str(tmp_path)
    spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    kept = [(d, good(t)) for d, t in rows if good(t) is not None]
    comp = {d: d for d, _ in kept}

    def root(d):
        while comp[d] != d:
            d = comp[d]
        return d

    sets = {d: grams(t) for d, t in kept}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    kept = [(d, t) for d, t in kept if root(d) == d]
    plain = lambda t: [w.lower().strip(".,\"") for w in WORD.findall(t)]
    kept = [(d, t) for d, t in kept if not any(edits(plain(i), plain(t)) <= 0.2 * len(plain(i)) for _, i in items)]
    kept = [(d, re.sub(r"\b[0-9a-f]{40}\b", "[SECRET]", t)) for d, t in kept]

    docs, expected = spark.read.parquet(f"{folder}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    assert sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == [(d, t, len(t)) for d, t in kept]

    from tokenizers import Tokenizer
    import public_tokenizers
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept}
    got = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    sizes = {}
    for r in got:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == expected
    fill = {}
    for r in got:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096 and len(fill) <= np.ceil(sum(sizes.values()) / 4096) + 1

    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[:1])
    assert corpus_pipeline.run(spark, folder).count() == sum(good(t) is not None for _, t in rows)


def test_stages_decide_per_row(spark):
    from fieldlens.llm import decontaminate, ngram_join, secret_forest

    rng = random.Random(2)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(40))
    item, secret = text(), "".join(rng.choices("0123456789abcdef", k=40))
    clean = [text() for _ in range(6)]
    near = clean[0].rsplit(" ", 1)[0] + " other"
    rows = [(None, clean[0], "a"), (None, near, "b"), (None, clean[1], "c"), (None, "x " + item, "d"), (7, clean[2], "e"), (7, clean[3], "f"),
            (7, item, "g"), (1, clean[4], "h"), (7, clean[4] + " more", "i"), (None, clean[5], "j"), (None, clean[5], "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = [r.lang for r in ngram_join.one_of_each(docs).collect()]
    assert len(set(kept) & {"a", "b"}) == 1 and sorted(set(kept) - {"a", "b"}) == ["c", "e", "f", "g", "h", "j"] and len(kept) == 7
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.lang for r in decontaminate.clean_documents(docs, items).collect()) == ["a", "b", "c", "e", "f", "h", "i", "j", "j"]
    own = spark.createDataFrame([(None, f'token = "{secret}" 1234567890123456', "k"), (None, f"token-like {clean[0]}", "l")], docs.schema)
    assert sorted((r.lang, secret in r.text) for r in secret_forest.without_secrets(own).collect()) == [("k", False), ("l", False)]
