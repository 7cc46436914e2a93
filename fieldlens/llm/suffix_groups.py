"""Exact removal of long repeated byte strings, with suffix groups found by linear grouping construction.

Texts are cut at anchors that depend on content alone: of the k-grams in every ``length``-byte window the one of the smallest hash. Equal windows
therefore have equal anchors at equal places. In each batch of texts the suffixes of the string of anchors are sorted by grouping: suffixes
are grouped by their Lyndon prefixes, groups are processed in descending order with pointers to the previous smaller suffix, and then every group's
order is emitted without renaming. Suffixes of one first anchor are neighbours there, and each such group sends one row with its size; the
groups of all batches meet in a Spark aggregate. Only anchors of groups with two members or more can lie in a repeated window.

Every window belongs to one anchor and is told by its distance from it. Of each anchor the windows at the first and the last distance and at each
multiple of ``CELL`` are compared, and between them the part that all windows of a cell share. Between two repeated windows the others cover nothing
new; in other cells whose shared part is repeated, every window is compared. Strings are compared by 64-bit hashes. No step joins a group with
itself, groups are counted and never gathered, and texts are not moved as long as what is told about them is small.

Null and empty texts, and texts shorter than ``length``, lose nothing. Repeated rows of at least ``length`` bytes lose everything. Extra columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import Prefix, mixed, pieces, sized, stored, utf8

CELL = 100
#: Bytes of texts that a task looks at together; its arrays of windows are about 130 times as large.
PIECE = 1 << 20


def grouped_suffixes(s: list[int]) -> list[int]:
    """The suffix array of a string of numbers whose last is the only smallest."""
    n = len(s)
    # Groups hold suffixes that share a prefix of the group's length. They form a list from the highest to the lowest.
    group = [0] * n
    member: list[list[int]] = []
    length, below, above, done = [], [], [], []
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(s):
        by_symbol.setdefault(c, []).append(i)
    for c in sorted(by_symbol):
        g = len(member)
        member.append(by_symbol[c])
        length.append(1)
        done.append(False)
        below.append(g - 1)
        above.append(g + 1)
        for i in by_symbol[c]:
            group[i] = g
    above[-1] = -1
    prev = [-1] * n
    g = len(member) - 1
    while g >= 0:
        done[g] = True
        items = [i for i in member[g] if group[i] == g]
        for i in items:
            p, path = i - 1, []
            while p >= 0 and done[group[p]]:
                path.append(p)
                p = prev[p] if group[p] != g else p - 1
            for q in path:  # pointers of processed suffixes are shortened as they are used
                if group[q] != g:
                    prev[q] = p
            prev[i] = p
        size = length[g]
        if len(items) == 1:  # the most frequent case: one suffix extends the one before it, if that is smaller and directly in front
            p = prev[items[0]]
            if p >= 0 and p + length[group[p]] == items[0]:
                old, m = group[p], len(member)
                member.append([p])
                length.append(length[old] + size)
                done.append(False)
                below.append(old)
                above.append(above[old])
                if above[old] >= 0:
                    below[above[old]] = m
                above[old] = m
                group[p] = m
            g = below[g]
            continue
        # Runs of the group's prefix behind a smaller suffix: how many copies follow it directly.
        run: dict[int, int] = {}
        inside = set(items)
        for i in items:
            p = prev[i]
            if p >= 0 and p + length[group[p]] == i:
                k, at = 0, i
                while at in inside and prev[at] == p:
                    k, at = k + 1, at + size
                run[p] = k
        # Those with more copies rank higher. Each new group goes directly above the group that its members leave.
        new: dict[tuple[int, int], list[int]] = {}
        for p, k in run.items():
            new.setdefault((k, group[p]), []).append(p)
        for k, old in sorted(new, reverse=True):
            moved = new[k, old]
            m = len(member)
            member.append(moved)
            length.append(length[old] + k * size)
            done.append(False)
            below.append(old)
            above.append(above[old])
            if above[old] >= 0:
                below[above[old]] = m
            above[old] = m
            for p in moved:
                group[p] = m
        g = below[g]
    order = [0]
    while above[order[-1]] >= 0:
        order.append(above[order[-1]])
    free, total = {}, 0
    for g in order:
        free[g] = total
        total += sum(1 for i in member[g] if group[i] == g)
    smaller = _previous_smaller(group, {g: k for k, g in enumerate(order)})
    out, placed = [-1] * n, [False] * n
    out[0], placed[n - 1] = n - 1, True
    free[group[n - 1]] += 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            out[free[group[j]]] = j
            free[group[j]] += 1
            placed[j] = True
            j = smaller[j]
    return out


def _previous_smaller(group: list[int], rank: dict[int, int]) -> list[int]:
    """The last suffix before each that is of a lower group."""
    out, stack = [-1] * len(group), []
    for i, g in enumerate(group):
        while stack and rank[group[stack[-1]]] >= rank[g]:
            stack.pop()
        out[i] = stack[-1] if stack else -1
        stack.append(i)
    return out


class Anchors:
    """Of the texts of one batch: anchors, the first and last start of the windows that each stands for, its text, and hashes of any span."""

    def __init__(self, column: pa.Array, length: int):
        self.gram = length // 4
        width = length - self.gram + 1
        self.raw, self.at = utf8(column)
        self.hash = Prefix(self.raw)
        n = len(self.raw)
        size = np.maximum(np.diff(self.at) - length + 1, 0)
        starts = np.repeat(self.at[:-1] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        if not len(starts):
            self.anchor = self.low = self.high = self.row = np.zeros(0, np.int64)
            return
        count = n - self.gram + 1
        bits = np.uint64(31)  # a batch of texts has fewer bytes than 2**31
        low = (np.uint64(1) << bits) - np.uint64(1)
        # Of equal k-grams the last one counts; the low bits hold the place.
        padded = np.full(-(-count // width) * width, np.uint64(2**64 - 1))
        key = padded[:count]
        key[:] = self.hash.windows(self.gram)
        key &= ~low
        key |= low - np.arange(count, dtype=np.uint64)
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = count - width + 1
        least = np.minimum(behind[:windows], ahead[width - 1:width - 1 + windows])[starts]
        # Keys hold the place, so windows of one key share their anchor.
        new = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        self.anchor, self.low = (low - (least[new] & low)).astype(np.int64), starts[new]
        self.high = np.concatenate([starts[new[1:] - 1], starts[-1:]])
        self.row = np.searchsorted(self.at, self.anchor, side="right") - 1

    def prints(self) -> np.ndarray:
        return self.hash(self.anchor, self.anchor + self.gram)


def _counted(length: int):
    """Anchors' fingerprints with their number in the batch, one row for each group of neighbouring suffixes."""
    def run(batches):
        for batch in batches:
            for lo, hi in pieces(batch, "text", PIECE):
                a = Anchors(batch.column("text")[lo:hi], length)
                if not len(a.anchor):
                    continue
                prints = a.prints()
                names, symbol, times = np.unique(prints, return_inverse=True, return_counts=True)
                # A suffix that begins with an anchor found once is a group of its own, and no comparison of others goes beyond that anchor:
                # of neighbouring ones in a text only the first enters the string.
                once = times[symbol] == 1
                kept = np.ones(len(symbol), bool)
                kept[1:] = ~(once[1:] & once[:-1] & (a.row[1:] == a.row[:-1]))
                left, row = symbol[kept], a.row[kept]
                # A number of its own ends every text, the smallest of all the whole string.
                breaks = np.flatnonzero(np.concatenate([row[1:] != row[:-1], [True]]))
                ends = len(breaks)
                string = np.insert(left + ends, breaks + 1, np.arange(ends - 1, -1, -1)).tolist()
                order = grouped_suffixes(string)
                first = np.array(string)[order]
                first = first[first >= ends] - ends
                cut = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
                found = np.concatenate([first[cut], symbol[~kept]])
                n = np.concatenate([np.diff(np.append(cut, len(first))), np.ones(len(found) - len(cut), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(names[found].view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    return run


ANCHORED = "key long, h long, at int, near int, far int, tests array<long>"


def points(a: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances at which an anchor's windows are compared: per anchor the number of cells between them, and all (anchor, distance) in order."""
    near, far = a.anchor - a.high, a.anchor - a.low
    inner = np.maximum((far - 1) // CELL - near // CELL, 0)  # multiples of the cell strictly between
    cells = np.where(far > near, inner + 1, 0)
    who = np.repeat(np.arange(len(near)), cells + 1)
    k = np.arange(len(who)) - np.repeat(np.cumsum(cells + 1) - cells - 1, cells + 1)
    at = np.where(k == 0, near[who], np.where(k == cells[who], far[who], (near[who] // CELL + k) * CELL))
    return cells, who, at


def _anchored(length: int):
    """Every anchor with the hashes of its compared windows, then of the shared parts of its cells."""
    def run(batches):
        for batch in batches:
            for lo, hi in pieces(batch, "text", PIECE):
                a = Anchors(batch.column("text")[lo:hi], length)
                if not len(a.anchor):
                    continue
                cells, who, o = points(a)
                start = a.anchor[who] - o
                window = a.hash(start, start + length)
                last = np.cumsum(cells + 1) - 1
                inner = np.ones(len(who), bool)
                inner[last[cells > 0]] = False  # an anchor of a single window has a part too
                parts = np.maximum(cells, 1)
                part = o[inner] // CELL
                start = a.anchor[who[inner]] - part * CELL
                shared = mixed(a.hash(start, start + length - CELL + 1) + part.astype(np.uint64) * np.uint64(0x1F123BB5))
                # Per anchor the windows, then the parts.
                before = np.cumsum(cells + 1 + parts) - (cells + 1 + parts)
                rank = np.arange(len(who)) - (np.cumsum(cells + 1) - cells - 1)[who]
                place = np.concatenate([before[who] + rank, (before + cells + 1)[who[inner]] + rank[inner]])
                tests = np.empty(len(place), np.int64)
                tests[place] = np.concatenate([window, shared]).view(np.int64)
                bounds = np.concatenate([[0], np.cumsum(cells + 1 + parts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(a.prints().view(np.int64)), batch.column("h")[lo:hi].take(pa.array(a.row)), pa.array((a.anchor - a.at[a.row]).astype(np.int32)),
                    pa.array((a.anchor - a.high).astype(np.int32)), pa.array((a.anchor - a.low).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(tests))], names=["key", "h", "at", "near", "far", "tests"])

    return run


def _fine(length: int):
    """The windows of doubtful cells."""
    def run(batches):
        for batch in batches:
            for lo, hi in pieces(batch, "text", PIECE):
                raw, at = utf8(batch.column("text")[lo:hi])
                row, first, last = _listed(batch.column("cells")[lo:hi])
                size = last - first + 1
                start = np.repeat(first, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                row = np.repeat(row, size)
                base = at[row]
                yield pa.RecordBatch.from_arrays([pa.array(Prefix(raw)(base + start, base + start + length).view(np.int64)), batch.column("h")[lo:hi].take(pa.array(row)),
                                                  pa.array(start.astype(np.int32))], names=["key", "h", "start"])

    return run


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and second field of all pairs in a column of lists."""
    size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    x, y = (f.to_numpy(zero_copy_only=False).astype(np.int64) for f in column.flatten().flatten())
    return np.repeat(np.arange(len(column)), size), x, y


def joined(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each row in order, overlapping and touching ones joined."""
    order = np.lexsort((a, row))
    row, a = row[order], a[order]
    reach = np.maximum.accumulate(row << 32 | b[order])  # how far the spans of a row go up to each one
    new = np.concatenate([[True], (row << 32 | a)[1:] > reach[:-1]]) if len(row) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[:len(first)] - 1
    return row[first], a[first], reach[last] & 0xFFFFFFFF


def _merged(batches):
    """Spans of each text, overlapping and touching ones joined."""
    for batch in batches:
        row, a, b = joined(*_listed(batch.column("spans")))
        bounds = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["a", "b"])
        yield pa.RecordBatch.from_arrays([batch.column("h"), pa.ListArray.from_arrays(pa.array(bounds), spans)], names=["h", "spans"])


def _removed(length: int):
    def run(batches):
        for batch in batches:
            for lo, hi in pieces(batch, "text", PIECE):
                out = []
                for text, spans, copied in zip(batch.column("text")[lo:hi].to_pylist(), batch.column("spans")[lo:hi].to_pylist(), batch.column("copied")[lo:hi].to_pylist()):
                    raw = text.encode()
                    gone = [(0, len(raw))] if copied else [(s["a"], s["b"]) for s in spans]
                    at, kept = 0, hashlib.sha256()
                    for x, y in gone:
                        kept.update(raw[at:x])
                        at = y
                    kept.update(raw[at:])
                    out.append((len(raw), sum(y - x for x, y in gone), len(gone), kept.hexdigest()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[lo:hi], *[pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def repeated(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(h, spans) of the texts with repeated strings, and (h) of texts that are there more than once. ``docs`` has (text, h)."""
    docs = docs.filter(F.octet_length("text") >= length).select("h", "text")
    copied = sized(docs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"))
    often = docs.mapInArrow(_counted(length), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    # Read twice below, so written once.
    anchored = stored(docs.mapInArrow(_anchored(length), ANCHORED).join(often, "key", "left_semi").drop("key"), "tests")
    tested = anchored.select("h", "at", "near", "far", (F.size("tests") - 1).alias("t"), F.posexplode("tests").alias("p", "key"))
    twice = tested.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    met = tested.join(twice, "key", "left_semi").groupBy("h", "at", "near", "far", "t").agg(F.collect_set(F.struct("p", "key")).alias("hits"))
    m = F.shiftright("t", 1)
    met = stored(met.select("h", "at", "near", "far", m.cast("int").alias("m"), F.col("hits.p").alias("ps"), F.col("hits.key").alias("ks")), "anchors")
    alone = met.join(copied, "h", "left_anti")

    def distance(k):
        return F.when(k == 0, F.col("near")).when(k >= F.col("m"), F.col("far")).otherwise((F.floor(F.col("near") / CELL).cast("int") + k) * CELL)

    full = F.size(F.filter("ps", lambda p: p <= F.col("m"))) == F.col("m") + 1
    found = F.when(full, F.array(F.struct((F.col("at") - F.col("far")).cast("int").alias("a"), (F.col("at") - F.col("near") + length).cast("int").alias("b")))).otherwise(
        F.transform(F.filter("ps", lambda p: p <= F.col("m")), lambda p: F.struct((F.col("at") - distance(p)).cast("int").alias("a"), (F.col("at") - distance(p) + length).cast("int").alias("b"))))
    sides = alone.select("h", F.explode(found).alias("s")).select("h", "s.a", "s.b")
    # A cell is looked into where its shared part is repeated and not both of its windows are, in all texts that have the part.
    cells = met.select("h", "at", "near", "far", "m", "ps", F.explode(F.filter(F.arrays_zip("ps", "ks"), lambda x: x["ps"] > F.col("m"))).alias("x")).select(
        "h", "at", "near", "far", "m", "ps", (F.col("x.ps") - F.col("m") - 1).alias("c"), F.col("x.ks").alias("part"))
    doubtful = ~(F.array_contains("ps", F.col("c")) & F.array_contains("ps", F.col("c") + 1))
    asked = cells.filter(doubtful).join(copied, "h", "left_anti").select("part").distinct()
    close = cells.join(asked, "part", "left_semi").select("h", F.struct(
        (F.col("at") - distance(F.col("c") + 1) + (F.col("c") + 1 < F.col("m")).cast("int")).cast("int").alias("first"),
        (F.col("at") - distance(F.col("c"))).cast("int").alias("last")).alias("cell"))
    close = sized(close.filter("cell.first <= cell.last").groupBy("h").agg(F.collect_set("cell").alias("cells")), 300_000)
    # They also meet the windows that were compared at first, which need not be in such cells.
    fine = docs.join(close, "h").select("text", "h", "cells").mapInArrow(_fine(length), "key long, h long, start int")
    windows = met.select("h", F.explode(F.arrays_zip("ps", "ks")).alias("x"), "m").filter(F.col("x.ps") <= F.col("m")).select(F.col("x.ks").alias("key"))
    seen = fine.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    known = windows.distinct().withColumn("n", F.lit(2).cast("long"))
    again = seen.unionByName(known).groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    single = fine.join(again, "key", "left_semi").join(copied, "h", "left_anti").select("h", F.col("start").alias("a"), (F.col("start") + length).alias("b"))
    spans = sides.unionByName(single).groupBy("h").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    return spans.mapInArrow(_merged, "h long, spans array<struct<a:int,b:int>>"), copied


def remove_repeats(docs: DataFrame, *, length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of (doc_id, text)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    spans, copied = repeated(docs, length)
    none = F.array().cast("array<struct<a:int,b:int>>")
    told = sized(copied.select("h", none.alias("spans"), F.lit(True).alias("copied")).unionByName(spans.withColumn("copied", F.lit(False))), 500_000)
    found = docs.join(told, "h", "left")
    cut = found.filter("copied is not null").select("doc_id", "text", "spans", "copied").mapInArrow(
        _removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    zero = F.lit(0).cast("long")
    whole = found.filter("copied is null").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                                                  F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    return cut.unionByName(whole)


def op6(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs)
