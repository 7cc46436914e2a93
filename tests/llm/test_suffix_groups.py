"""Suffix order and removed bytes against plain sorting and counting."""

import hashlib
import random
from collections import Counter

import pytest

from fieldlens.llm import suffix_groups


def test_suffix_order():
    rng = random.Random(1)
    for _ in range(3000):
        s = [rng.randrange(1, rng.choice([2, 3, 6])) for _ in range(rng.randrange(0, 40))] + [0]
        assert suffix_groups.grouped_suffixes(s) == sorted(range(len(s)), key=lambda i: s[i:]), s


def brute(rows, length):
    raws = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(r[i:i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for d, r in raws:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [120, 400])
def test_removed_bytes(spark, length):
    rng = random.Random(length)

    def prose(n):
        return "".join(rng.choice("abcdefé ") for _ in range(n))

    shared = [prose(k) for k in (length - 2, length - 1, length, length + 1, length + 20, length + 45, 3 * length)]
    rows = [(0, None), (1, ""), (2, prose(3 * length)), (3, "z" * (length + 40)), (4, "ab" * length), (None, prose(90))]
    for d in range(10, 90):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts.append(prose(rng.randrange(0, 2 * length)))
            if rng.random() < 0.5:
                x = rng.choice(shared)
                i = rng.choice([0, 0, rng.randrange(30)])
                parts.append(x[i:len(x) - rng.choice([0, 0, rng.randrange(30)])])
        rows.append((d, "".join(parts)))
    rows += [(90, rows[20][1]), (90, rows[20][1]), (91, rows[21][1] + "!")]
    got = suffix_groups.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), length=length).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, length)


def test_empty(spark):
    assert suffix_groups.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tasks_look_at_little_text_together(spark, monkeypatch):
    """The arrays of a task grow with the bytes looked at together, whatever a batch holds."""
    import pyarrow as pa

    seen, anchors = [], suffix_groups.Anchors
    monkeypatch.setattr(suffix_groups, "Anchors", lambda column, length: seen.append(column.nbytes) or anchors(column, length))
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcdefgh ", k=100_000)) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(texts)], ["h", "text"])
    for task in (suffix_groups._counted, suffix_groups._anchored):
        assert sum(out.num_rows for out in task(400)([batch]))
    assert max(seen) < 1_200_000 and len(seen) >= 8


def test_spans_are_joined_together():
    import pyarrow as pa
    lists = [[{"a": 5, "b": 9}, {"a": 0, "b": 5}, {"a": 2, "b": 3}, {"a": 11, "b": 12}], [{"a": 0, "b": 1}], [{"a": 3, "b": 30}, {"a": 4, "b": 6}, {"a": 31, "b": 40}]]
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    whole = pa.RecordBatch.from_arrays([pa.array([9, 7, 8, 6]), pa.array([[{"a": 1, "b": 2}], *lists], kind)], names=["h", "spans"])
    batch = whole.slice(1)  # a slice keeps the lists of the rows before it
    row, a, b = suffix_groups.joined(*suffix_groups._listed(batch.column("spans")))
    assert list(zip(row.tolist(), a.tolist(), b.tolist())) == [(0, 0, 9), (0, 11, 12), (1, 0, 1), (2, 3, 30), (2, 31, 40)]
    out = next(suffix_groups._merged([batch])).to_pydict()
    assert out == {"h": [7, 8, 6], "spans": [[{"a": 0, "b": 9}, {"a": 11, "b": 12}], [{"a": 0, "b": 1}], [{"a": 3, "b": 30}, {"a": 31, "b": 40}]]}


def test_anchors_are_told_once(spark, monkeypatch):
    """The hashes of windows are written, not made again by each job that reads them."""
    stored, names = suffix_groups.stored, []
    monkeypatch.setattr(suffix_groups, "stored", lambda df, name: names.append(name) or stored(df, name))
    text = "".join(chr(97 + i * i % 23) for i in range(900))
    df = spark.createDataFrame([(1, text), (2, "x" + text[100:800] + "y")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_groups.remove_repeats(df).collect()}
    assert names[0] == "tests" and got[2] >= 700


def test_anchors_found_once_stay_out_of_the_string(monkeypatch):
    import numpy as np
    import pyarrow as pa
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 300, 9000]))) for _ in range(30)]
    texts += [texts[k][100:2000] + texts[k + 1] for k in range(6)] + ["ab" * 700]
    sort, sizes = suffix_groups.grouped_suffixes, []
    monkeypatch.setattr(suffix_groups, "grouped_suffixes", lambda s: sizes.append(len(s)) or sort(s))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = Counter()
    for out in suffix_groups._counted(400)([batch]):
        for k, n in zip(out.column("key").to_pylist(), out.column("n").to_pylist()):
            assert k not in got
            got[k] = n
    a = suffix_groups.Anchors(pa.array(texts), 400)
    assert got == Counter(a.prints().view(np.int64).tolist()) and max(got.values()) > 1
    assert sizes[0] < 0.8 * len(a.anchor)


def test_hashes_of_all_grams_come_from_slices(monkeypatch):
    """Every place of a text has a gram, so these are not gathered place by place; anchors are those of plain search."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(5)
    texts = [None, "".join(rng.choice("abcdé ") for _ in range(2500)), "", "ab" * 300, "x" * 119, "".join(rng.choice("abc") for _ in range(120)), ""]
    gathered, call = [], suffix_groups.Prefix.__call__
    monkeypatch.setattr(suffix_groups.Prefix, "__call__", lambda self, start, end: gathered.append(len(start)) or call(self, start, end))
    length, gram = 120, 30
    a = suffix_groups.Anchors(pa.array(texts), length)
    assert not gathered
    start = np.arange(len(a.raw) - gram + 1)
    hashes = call(a.hash, start, start + gram)
    assert np.array_equal(a.hash.windows(gram), hashes) and np.array_equal(a.hash.windows(gram, 7), hashes)
    assert len(a.hash.windows(len(a.raw) + 1)) == 0
    want = []
    for row in range(len(texts)):
        for w in range(a.at[row], a.at[row + 1] - length + 1):
            best = min(range(w, w + length - gram + 1), key=lambda i: (int(hashes[i]) >> 31, -i))
            if want and want[-1][0] == best:
                want[-1][2] = w
            else:
                want.append([best, w, w, row])
    assert [list(x) for x in zip(a.anchor.tolist(), a.low.tolist(), a.high.tolist(), a.row.tolist())] == want
