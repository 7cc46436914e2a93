"""Benchmark decontamination with the CGK embedding.

Symbols are words, folded to lower case and without punctuation around them. A random walk reads a string: at step j it puts out the symbol
under the pointer and moves on if a random bit of (j, symbol) says so. Strings at a small edit distance fall into step again after an
edit and so differ in few of the put-out symbols. Bit-sampling LSH takes ``SAMPLED`` of the steps as a key. The windows are as long as the shortest
item needs; longer items have a window at each of their words, so that an edit spoils only those near it. Repetitions with other random bits
are added until a window with ``edits`` edits is found with the wanted recall. Every candidate is verified by the exact edit distance in
words between the whole item and the best place in the document.

Items of fewer than ``EXACT`` words hold too few windows for that: at the bound of similarity most of theirs are spoilt. With at most e edits
one of e + 1 pieces of an item is whole in the document, so these are looked up by the pieces and none is missed.

Every word of every document starts a window; nothing is sampled. The items come in blocks of ``block`` items, which bounds what is broadcast. Items and documents without words match nothing.
Repeated rows are reported each. A null doc_id is reported as null. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import Prefix, mixed, pieces, row_key, sized, words

STEPS = 18
SAMPLED = 6
#: Words below which items are found by whole pieces.
EXACT = 40
FOUND = "doc_id long, item_id long, start long, distance long, similarity double"

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def repetitions(recall: float, edits: int, window: int) -> int:
    """Tables needed so that a window of ``window`` words with ``edits`` edits is found with probability ``recall`` or more.

    Each edit disturbs about three put-out symbols before the walks are in step again."""
    hit = max(0.0, 1 - 3 * edits / (2 * window)) ** SAMPLED
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(hit, 0.999))))


def folded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit symbol for each word and per row the number of its first word (and the total)."""
    raw, s, e, first = words(column)
    raw = raw.copy()
    if len(raw) > 1:  # capital letters of Latin-1 in UTF-8
        tail = raw[1:]
        tail[(raw[:-1] == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)] += 0x20
    s, e = s.copy(), e.copy()
    for _ in range(4):
        e -= (e > s + 1) & _PUNCT[raw[e - 1]]
    s += (e > s + 1) & _PUNCT[raw[np.minimum(s, max(len(raw) - 1, 0))]] if len(raw) else 0
    return Prefix(raw)(s, e), first


def walks(symbols: np.ndarray, rep: int) -> tuple[np.ndarray, np.ndarray]:
    """For every start: the LSH key of the walk and the number of words it has read."""
    rng = np.random.default_rng(1000 + rep)
    taken = set(np.sort(rng.choice(STEPS, SAMPLED, replace=False)).tolist())
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(STEPS + 1, np.uint64)])
    bits = mixed(padded ^ np.uint64(0xC2B2AE3D27D4EB4F * (2 * rep + 1) & (2**64 - 1)))
    at = np.arange(n, dtype=np.int64)
    key = np.zeros(n, np.uint64)
    one = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(STEPS):
            here = bits[at]
            if j in taken:
                key = key * np.uint64(0x9E3779B97F4A7C15) + here
            at += ((here >> np.uint64(j)) & one).astype(np.int64)
    return key ^ (key >> np.uint64(29)), at - np.arange(n) + 1


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least number of word edits that turn ``item`` into a part of ``text``, and where that part ends."""
    step = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, w in enumerate(item):
        down = row + 1
        down[1:] = np.minimum(down[1:], row[:-1] + (text != w))
        row = np.minimum.accumulate(down - step) + step
    end = int(np.argmin(row))
    return int(row[end]), end


def allowed(words: int, similarity: float) -> int:
    """Edits that an item of so many words may have."""
    return int(words * (1 - similarity) + 1e-9)


def runs(symbols: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from every start."""
    rows = max(0, len(symbols) - size + 1)
    out = np.zeros(rows, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * np.uint64(0x9FB21C651E98DF25) + symbols[k:k + rows]
    return mixed(out)


def _pieces_of(items: list[tuple[int, np.ndarray]], similarity: float) -> dict[int, tuple]:
    """By their size: hashes of the pieces of short items in order, the items and where in them the pieces are."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    for k, (_, sym) in enumerate(items):
        if 0 < len(sym) < EXACT:
            parts = allowed(len(sym), similarity) + 1
            cut = [len(sym) * i // parts for i in range(parts + 1)]
            for a, b in zip(cut[:-1], cut[1:]):
                found.setdefault(b - a, []).append((int(runs(sym[a:b], b - a)[0]), k, a))
    out = {}
    for size, rows in found.items():
        rows.sort()
        keys, owner, shift = zip(*rows)
        out[size] = np.array(keys, np.uint64), np.array(owner, np.int64), np.array(shift, np.int64)
    return out


def _search(items: list[tuple[int, np.ndarray]], reps: int, similarity: float):
    """The task that finds items in documents. ``items`` are bounded by the block."""
    tables = []
    for rep in range(reps):
        keys, owner, shift = [], [], []
        for k, (_, sym) in enumerate(items):
            if len(sym) < EXACT:
                continue
            key, read = walks(sym, rep)
            inside = np.flatnonzero(np.arange(len(sym)) + read <= len(sym))
            keys.append(key[inside])
            owner.append(np.full(len(inside), k))
            shift.append(inside)
        keys, owner, shift = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((keys, np.uint64), (owner, np.int64), (shift, np.int64)))
        order = np.argsort(keys, kind="stable")
        tables.append((keys[order], owner[order], shift[order]))
    walked = any(len(keys) for keys, _, _ in tables)
    pieced = _pieces_of(items, similarity)

    listed = [sym.tolist() for _, sym in items]

    def run(batches):
        searched = [(lambda sym, rep=rep: walks(sym, rep)[0], *table) for rep, table in enumerate(tables)] if walked else []
        searched += [(lambda sym, size=size: runs(sym, size), *table) for size, table in pieced.items()]
        bit = np.zeros((len(searched), 1 << 20), bool)
        for nth, (_, keys, _, _) in enumerate(searched):
            bit[nth, (keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                sym, first = folded(batch.column("text")[lo:hi])
                found = set()
                for nth, (hashed, keys, owner, shift) in enumerate(searched):
                    key = hashed(sym)
                    maybe = np.flatnonzero(bit[nth, (key & np.uint64((1 << 20) - 1)).astype(np.int64)])
                    a, b = np.searchsorted(keys, key[maybe], "left"), np.searchsorted(keys, key[maybe], "right")
                    for p, i, j in zip(maybe[a < b].tolist(), a[a < b].tolist(), b[a < b].tolist()):
                        found.update((p - int(shift[t]), p, int(owner[t])) for t in range(i, j))
                best: dict[tuple[int, int], tuple] = {}
                seen = set()
                for at, p, k in sorted(found):
                    row = int(np.searchsorted(first, p, "right")) - 1
                    item = items[k][1]
                    if (row, k, at) in seen:
                        continue
                    seen.add((row, k, at))
                    if best.get((row, k), (1,))[0] == 0:
                        continue
                    most = allowed(len(item), similarity)
                    slack = most + 1
                    x, y = max(int(first[row]), at - slack), min(int(first[row + 1]), at + len(item) + slack)
                    # An item of which too few words are there at all is farther away than the bound.
                    there = set(sym[x:y].tolist())
                    if sum(w in there for w in listed[k]) < len(item) - most:
                        continue
                    d, end = distance(item, sym[x:y])
                    if d <= most and d < best.get((row, k), (1 << 30,))[0]:
                        best[row, k] = (d, max(0, x + end - len(item) - int(first[row])))
                if best:
                    ids = batch.column("doc_id")[lo:hi].to_pylist()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[
                        (ids[r], items[k][0], s, d, 1 - d / len(items[k][1])) for (r, k), (d, s) in sorted(best.items())]),
                        (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))], names=["doc_id", "item_id", "start", "distance", "similarity"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, *, similarity: float = 0.8, recall: float = 0.95, edits: int = 1, block: int = 20_000) -> DataFrame:
    """(doc_id, item_id, start, distance, similarity) of every item found in a document, ``start`` being the number of the word."""
    docs, out = docs.select("doc_id", "text"), None
    reps = repetitions(recall, edits, STEPS // 2 + 6)
    blocks = max(1, -(-benchmark.count() // block))
    for b in range(blocks):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select("item_id", "text").toArrow()
        items = []
        for chunk in part.to_batches():
            sym, first = folded(chunk.column("text"))
            items += [(i, sym[x:y]) for i, x, y in zip(chunk.column("item_id").to_pylist(), first[:-1].tolist(), first[1:].tolist())]
        found = docs.mapInArrow(_search(items, reps, similarity), FOUND)
        out = found if out is None else out.unionByName(found)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without documents that hold a benchmark item."""
    found = sized(leaks(docs.select(row_key(docs).alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("_key")).distinct())
    return docs.join(found, row_key(docs) == F.col("_key"), "left_anti")


def op7(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark)
