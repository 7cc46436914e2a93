"""Periodic runs of words: stretches that repeat one period at least four times, and texts collapsed to one period of each.

Method: recursive frequency splitting. A run repeats its period ``TIMES`` times, so every word of it occurs that often in the segment around
it; rarer words split the segment, and the parts are judged again by their own counts until no part loses a word. The surviving segments are
scanned by lag, lags of one octave [2**k, 2**(k+1)) together: windows of 2**(k+1) words are named exactly (names of two halves make the name
of the whole), and each window looks for its next equal in the segment. The windows of a run of period q, all but the last few, find it
exactly q words on, and no others that find it at q lie beside them, so a stretch of equal distances is a whole run with its smallest period.
A segment of n words costs n log n per octave, whatever its lags; no pair of positions is listed.

All work is inside one row, so there is no shuffle; a task takes texts of a few megabytes at once, a longer text alone. Null and empty texts,
and texts without words, have no words and no runs; their collapsed text is empty. Words are compared as they are written, byte by byte. Equal
rows, repeated and null ids are judged row by row. Other columns pass through ``find_runs`` unless they bear the name of a result column, which
wins.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import pieces

#: A run has at least this many words, and repeats its period at least so often.
LEAST, TIMES = 6, 4

RESULT = ("n_words", "runs", "collapsed")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _breaks(at: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """True where a position does not follow the one before it in the same segment."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (segment[1:] != segment[:-1])
    return new


def split_by_frequency(word: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Positions that can lie in a run, in order; ``word`` and ``segment`` are ids per position."""
    at, n_words = np.arange(len(word)), int(word.max(initial=0)) + 1
    done = []
    while len(at):
        _, which, often = np.unique(segment * n_words + word[at], return_inverse=True, return_counts=True)
        keep = often[which] >= TIMES
        # Segments that lose nothing are stable; only parts of the others are counted again.
        first = np.flatnonzero(_breaks(at, segment))
        stable = np.repeat(np.logical_and.reduceat(keep, first), np.diff(np.append(first, len(at))))
        done.append(at[stable])
        at, segment = at[keep & ~stable], segment[keep & ~stable]
        new = _breaks(at, segment)
        segment = np.cumsum(new) - 1
        if len(at):
            large = np.bincount(segment) >= LEAST
            at, segment = at[large[segment]], segment[large[segment]]
    return np.sort(np.concatenate(done)) if done else at


def runs_in(word: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all maximal runs, none over a change of ``owner``; in no set order."""
    none = np.zeros(0, np.int64)
    found = [(none, none, none)]
    at = split_by_frequency(word, owner)
    if not len(at):
        return found[0]
    number = np.cumsum(_breaks(at, owner[at])) - 1
    size = np.bincount(number)[number]
    at, number, size = at[size >= LEAST], number[size >= LEAST], size[size >= LEAST]
    name = np.unique(number * (int(word.max()) + 1) + word[at], return_inverse=True)[1] if len(at) else none
    low = 1
    while len(at):
        end = np.append(np.flatnonzero(number[1:] != number[:-1]) + 1, len(at))
        end = np.repeat(end, np.diff(np.append(0, end)))
        whole = np.flatnonzero(np.arange(len(at)) + 2 * low <= end)  # windows of two halves inside the segment
        pair = np.unique(name[whole] * (len(at) + 1) + name[whole + low], return_inverse=True)[1]
        order = np.argsort(pair, kind="stable")
        apart = np.zeros(len(at), np.int64)  # words to the next equal window; names differ between segments
        same = pair[order[1:]] == pair[order[:-1]]
        apart[whole[order[:-1][same]]] = (whole[order[1:]] - whole[order[:-1]])[same]
        new = np.ones(len(at), bool)
        new[1:] = (apart[1:] != apart[:-1]) | (number[1:] != number[:-1])
        first = np.flatnonzero(new)
        windows, period = np.diff(np.append(first, len(at))), apart[first]
        length = windows + 2 * low - 1 + period
        good = (period >= low) & (period < 2 * low) & (length >= np.maximum(LEAST, TIMES * period))
        found.append((at[first[good]], length[good], period[good]))
        # The next octave needs longer segments; windows are named on from the halves.
        longer = np.full(len(at), -1, np.int64)
        longer[whole] = pair
        low *= 2
        keep = np.bincount(number)[number] >= TIMES * low
        at, number, name = at[keep], number[keep], longer[keep]
    return tuple(np.concatenate(x) for x in zip(*found))


def find_runs(docs: DataFrame, *, text: str = "text", rewrite: Callable[[list, object], list] | None = None, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``: the words joined by one space,
    without those that a run contains after its first period. ``rewrite`` may change the words of a row, given with the row's ``key``, first."""
    own = [c for c in docs.columns if c.lower() not in RESULT]
    schema = T.StructType([docs.schema[c] for c in own] + [
        T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in
                                                                                               ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType())])

    def part(rows: pa.RecordBatch) -> tuple:
        lists = [[] if t is None else t.encode().split() for t in rows.column(text).to_pylist()]
        if rewrite is not None:
            lists = [rewrite(w, k) for w, k in zip(lists, rows.column(key).to_pylist())]
        count = np.array([len(w) for w in lists], np.int64)
        first = np.append(0, np.cumsum(count))
        flat = [w for words in lists for w in words]
        word = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        start, length, period = runs_in(word, np.repeat(np.arange(len(lists)), count))
        order = np.lexsort((period, start))
        start, length, period = start[order], length[order], period[order]
        edge = np.bincount(start + period, minlength=len(flat) + 1) - np.bincount(start + length, minlength=len(flat) + 1)
        drop = np.cumsum(edge) > 0
        row = np.searchsorted(first, start, "right") - 1
        bounds = np.searchsorted(row, np.arange(len(lists) + 1))
        runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(start - first[row]), pa.array(length), pa.array(period)], ["start", "length", "period"]))
        texts = [b" ".join(words) if a == b else b" ".join([w for w, gone in zip(words, drop[f:f + len(words)]) if not gone])
                 for words, f, a, b in zip(lists, first, bounds, bounds[1:])]
        return pa.array(count), runs, pa.array(texts, pa.binary()).cast(pa.string())

    def map_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch, text):
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([rows.column(c) for c in own] + list(part(rows)), names=own + list(RESULT))

    return docs.mapInArrow(map_batches, schema)


def looped(words: list, doc_id: object) -> list:
    """The words of the contract's query: one text in ten is made periodic from a word on, both given by the id. A null id changes nothing."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op11(docs: DataFrame) -> DataFrame:
    """The digest of every document: its runs, its run of greatest exponent, and hashes of both outputs."""
    found = find_runs(docs.select("doc_id", "text"), rewrite=looped)
    # Runs come by start, then period, so a later one wins only by a greater exponent.
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "_best.start", "_best.length", "_best.period",
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
                 CASE WHEN (a & 1) = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
             xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                             lambda a, c: xor(a >> 8, tab[CAST((xor(a, c) & 255) + 1 AS BIGINT)])), 4294967295) AS h FROM documents, crc),
s AS (SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a FROM d),
v AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM s),
w AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[CAST(i + 1 AS BIGINT)]
             ELSE ws[CAST(a + (i - a) % p + 1 AS BIGINT)] END) ELSE ws END AS ws FROM v),
t AS (SELECT rid, n, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM w),
e AS (SELECT x.rid, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
g AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS g FROM e),
m AS (SELECT rid, min(i) AS s, count(*) + q AS l, q FROM g GROUP BY rid, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT * FROM m QUALIFY q = min(q) OVER (PARTITION BY rid, s, l)),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY rid ORDER BY l / q DESC, s, q) = 1),
c AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM r GROUP BY rid),
x AS (SELECT DISTINCT rid, unnest(range(s + q, s + l)) AS i FROM r),
k AS (SELECT t.rid, string_agg(word, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN x ON t.rid = x.rid AND t.i = x.i GROUP BY t.rid)
SELECT w.doc_id, coalesce(c.n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period, 1000 * b.l // b.q AS exponent_milli,
       sha256(coalesce(c.runs, '')) AS runs_sha256, sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM w LEFT JOIN c ON w.rid = c.rid LEFT JOIN b ON w.rid = b.rid LEFT JOIN k ON w.rid = k.rid
"""
