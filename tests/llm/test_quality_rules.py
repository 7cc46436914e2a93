"""Measures and verdicts against plain counting, and columns of clashing names."""

import re

from fieldlens.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "x " * 60, "Fine words here, all of them new %d. " % 1, "A | B | C | D\n" * 3 + "Some sentence ends here.\n" * 2,
         " ".join(f"w{i}" for i in range(70)) + ".", "\n".join(" ".join(f"w{i}{k}" for i in range(12)) + "." for k in range(8)) + "\nHome | News | About | Login",
         "LOUD!! NOISE!! " * 30, "no mark at all " * 30, "\xa0nbsp is no blank é", " ".join(f"v{i}" for i in range(49)) + ".", " ".join(f"v{i}" for i in range(50)) + "."]


def plain(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    base = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), base)


def test_measures(spark):
    rows = list(enumerate(TEXTS)) + [(1, TEXTS[8]), (None, TEXTS[9])]
    got = quality_rules.op8(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), *r[1:7]) for r in got) == sorted((str(d), *plain(t)) for d, t in rows)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[8] and kept[9] and kept[14] and kept[None] and not (kept[5] or kept[10] or kept[11] or kept[13])


def test_stage_keeps_columns(spark):
    rows = [(i, t, len(t or ""), "k", "w", None) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, kept string, n_words string, clean_text string")
    got = quality_rules.good_documents(docs)
    assert got.columns == docs.columns
    out = {r.doc_id: r for r in got.collect()}
    assert set(out) == {8, 9, 14} and out[8].text == TEXTS[8] and out[8].kept == "k"
    assert "Home" not in out[9].text and out[9].n_chars == len(out[9].text) and out[9].text.count("\n") == 7
    assert quality_rules.good_documents(docs.filter("false")).count() == 0
