"""Transformed and restored texts against plain slicing, for frames of any size."""

import hashlib
import random
import re

import pytest
import zstandard

from fieldlens.llm import fill_middle

TEXTS = [None, "", "\n", "one", "one\n", "\n\n\n", "a\nb\nc", "a\nb\nc\n", "<P> in it\nb\n", "x <M>", "<S>\n", "<\nP>\n<S\n", "é\nü€\n𝄞\n" * 9, "no line end " * 40,
         "€" * 300 + "\n" + "b" * 100 + "\n\n" + "c\n" * 50, "\r\n\x0b\n  \n", "é" * 5 + "\n" + "é" * 500]


def plain(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < spm else "psm"
    return len(units), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@pytest.mark.parametrize("frame", [4, 7, 16, 65536])
def test_texts_of_any_frame_size(frame):
    rng = random.Random(frame)
    texts = TEXTS + ["".join(rng.choice("ab€\n<PS>M𝄞") for _ in range(rng.randint(0, 120))) for _ in range(150)]
    for k, text in enumerate(texts):
        frames = fill_middle.frames_of(text or "", frame)
        assert b"".join(zstandard.ZstdDecompressor().decompress(f["data"]) for f in frames).decode() == (text or "")
        want = plain(k, text)
        marked = any(m in (text or "") for m in ("<P>", "<S>", "<M>"))
        got = fill_middle.transformed(k, fill_middle.n_units(text or ""), len(text or ""), marked, frames, seed=7, rate=100, spm=50)
        out = b"".join(fill_middle.opened_frames(got[-1])).decode()
        assert (*got[:4], out) == want, (text, frame)
        assert b"".join(fill_middle.restored(got[-1], got[1])).decode() == (text or "")


def test_only_frames_with_a_cut_are_opened():
    text = "".join(f"line {i}\n" for i in range(20_000))
    frames = fill_middle.frames_of(text, 4096)
    n = fill_middle.n_units(text)
    opened = {}
    for unit in (0, n // 3, n // 2, n):
        k, at, chars = fill_middle._place(frames, n, len(text), unit, opened)
        assert chars == len("".join(text.splitlines(True)[:unit]))
    assert len(opened) <= 2 and len(frames) > 40
    out = fill_middle.transformed(3, n, len(text), False, frames, seed=7, rate=100, spm=50)[-1]
    assert len(set(f["data"] for f in frames) - set(out)) <= 2
    # the frames of the output are one stream for any reader
    whole = zstandard.ZstdDecompressor().stream_reader(b"".join(out), read_across_frames=True).read()
    assert whole.decode() == plain(3, text)[-1]


def test_query(spark):
    rows = list(enumerate(TEXTS)) + [(3, "again\nand\nagain\n"), (None, "no\nid\n"), (None, None), (99, "long line " * 20_000 + "\nshort\n" * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, fill_middle.op13(docs).collect()), key=str)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert got == sorted(((d, *plain(d, t)[:4], sha(plain(d, t)[4]), sha(t)) for d, t in rows), key=str)
    assert fill_middle.op13(docs.filter("false")).count() == 0


def test_columns_rate_and_texts(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb\nc\n", "f", 5) for i in range(60)], "doc_id long, text string, frames string, extra int")
    out = fill_middle.texts(fill_middle.fill_in_middle(fill_middle.store(docs), seed=1, rate=50, spm=0))
    rows = out.collect()
    assert out.columns == ["doc_id", "extra", "n", "form", "prefix_chars", "middle_chars", "text"] and {r.extra for r in rows} == {5}
    assert {(r.doc_id, r.form, r.text) for r in rows} == {(i, plain(i, f"a{i}\nb\nc\n", 1, 50, 0)[1], plain(i, f"a{i}\nb\nc\n", 1, 50, 0)[4]) for i in range(60)}
    assert {r.form for r in rows} == {"plain", "psm"}
