"""Packing documents into training sequences with a grouping genetic algorithm on islands.

Documents are encoded, ended and, only where longer than a sequence, cut into full pieces and a rest. Full pieces are sequences already.
The others are dealt by a hash into groups of bounded size; each group evolves on several islands, one task each. A solution is a list of
bins. Crossover injects whole well-filled bins of one parent into the other, drops the bins that held their documents, and places displaced
documents best-fit. Elites migrate to the next island between epochs. Poorly filled bins of all groups are dissolved and packed again in
other groups of the same size, level by level, until a level saves less than one bin in ``SAVED`` or no packing can need fewer bins.

Null texts are empty documents of one end token. Repeated rows are packed once each. An empty table gives no rows. Only the id and the text
column are read, so other columns can't clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import pieces, saved
from fieldlens.llm.tokens import encoder

#: Bins of a level of which repacking has to save one for the next level to be tried.
SAVED = 1000
PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, file: str, capacity: int, end: int) -> DataFrame:
    """One row per piece of each document with its place in the document's ids and their checksum."""
    tail = end.to_bytes(4, "little")

    def run(batches):
        enc = encoder(file)
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                ids = batch.column("doc_id")[lo:hi].to_pylist()
                rows = []
                for doc, raw in zip(ids, enc.encode([t or "" for t in batch.column("text")[lo:hi].to_pylist()])):
                    raw += tail
                    for k, at in enumerate(range(0, len(raw), capacity * 4)):
                        part = raw[at:at + capacity * 4]
                        rows.append((0, doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    made = docs.select("doc_id", "text").mapInArrow(run, PIECES)
    return saved(made.withColumn("uid", F.monotonically_increasing_id()))


class Solution:
    """Bins of item numbers and their fill."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity, self.bins, self.fill, self.room = sizes, capacity, [], [], []

    def add_bin(self, items: list[int]) -> None:
        self.bins.append(items)
        self.fill.append(sum(self.sizes[i] for i in items))
        insort(self.room, (self.capacity - self.fill[-1], len(self.bins) - 1))

    def best_fit(self, items) -> "Solution":
        for i in items:
            size = self.sizes[i]
            at = bisect_left(self.room, (size, -1))
            if at == len(self.room):
                self.add_bin([i])
            else:
                left, b = self.room.pop(at)
                self.bins[b].append(i)
                self.fill[b] += size
                insort(self.room, (left - size, b))
        return self

    def worth(self) -> tuple[int, float]:
        return -len(self.bins), sum(f * f for f in self.fill)


def crossed(a: Solution, b: Solution, rng: np.random.Generator) -> Solution:
    """A child of ``a`` with well-filled bins of ``b`` injected whole."""
    full = sorted(range(len(b.bins)), key=lambda k: -b.fill[k])[:max(1, len(b.bins) * 3 // 4)]
    taken = [k for k in full if rng.random() < 0.5] or full[:1]
    inside = {i for k in taken for i in b.bins[k]}
    child, displaced = Solution(a.sizes, a.capacity), []
    for k in taken:
        child.add_bin(list(b.bins[k]))
    for items in a.bins:
        if inside.isdisjoint(items):
            child.add_bin(list(items))
        else:
            displaced += [i for i in items if i not in inside]
    return child.best_fit(sorted(displaced, key=lambda i: -a.sizes[i]))


def evolved(sizes: list[int], capacity: int, seed: int, elites: list[list[list[int]]], population: int, generations: int) -> list[Solution]:
    """Solutions of one island, best first. It stops once no packing can need fewer bins."""
    rng = np.random.default_rng(seed)
    least = -(-sum(sizes) // capacity)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    pool = []
    for bins in elites:
        s = Solution(sizes, capacity)
        for items in bins:
            s.add_bin(items)
        pool.append(s)
    if not pool:
        pool.append(Solution(sizes, capacity).best_fit(order))
    while len(pool) < population and -pool[0].worth()[0] > least:
        near = np.argsort(-np.array(sizes) * rng.uniform(0.7, 1.0, len(sizes)), kind="stable").tolist()
        pool.append(Solution(sizes, capacity).best_fit(near))
    pool.sort(key=Solution.worth, reverse=True)
    for _ in range(generations):
        if len(pool[0].bins) <= least:
            break
        a, b = (pool[int(rng.integers(len(pool)) * rng.random())] for _ in range(2))
        pool = sorted([*pool, crossed(a, b, rng), crossed(b, a, rng)], key=Solution.worth, reverse=True)[:population]
    return pool


STATE = "grp long, island int, elite int, uid long, length long, bin int, offset long, fill long"


def _island(capacity: int, population: int, generations: int, keep: int, epoch: int):
    def run(key, pdf):
        grp, island = int(key[0]), int(key[1])
        base = pdf[["uid", "length"]].drop_duplicates("uid").sort_values("uid", kind="stable")
        uids, sizes = base["uid"].tolist(), base["length"].tolist()
        number = {u: i for i, u in enumerate(uids)}
        elites = []
        for _, rows in pdf[pdf["bin"] >= 0].groupby(["source", "elite"]):
            bins: dict[int, list[int]] = {}
            for u, b in zip(rows["uid"], rows["bin"]):
                bins.setdefault(b, []).append(number[u])
            elites.append(list(bins.values()))
        best = evolved(sizes, capacity, zlib.crc32(f"{grp} {island} {epoch}".encode()), elites, population, generations)[:keep]
        out = []
        for e, s in enumerate(best):
            for b, items in enumerate(s.bins):
                at = 0
                for i in items:
                    out.append((grp, island, e, uids[i], sizes[i], b, at, s.fill[b]))
                    at += sizes[i]
        import pandas as pd

        return pd.DataFrame(out, columns=["grp", "island", "elite", "uid", "length", "bin", "offset", "fill"])

    return run


def pack(items: DataFrame, capacity: int, *, group_size: int = 2048, islands: int = 2, epochs: int = 2, population: int = 4,
         generations: int = 6) -> DataFrame:
    """(uid, sequence_id, offset) of every (uid, length) row with 0 < length <= capacity. ``group_size`` is the expected size of a group."""
    whole = items.filter(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, level, done, poor, before = items.filter(F.col("length") < capacity).select("uid", "length"), 0, [], None, None
    while True:
        count, total, large = rest.agg(F.count(F.lit(1)), F.sum("length"), F.count_if(F.col("length") * 2 > capacity)).first()
        groups = -(-count // group_size)
        if groups == 0:
            break
        least = max(-(-total // capacity), large)
        dealt = rest.select(F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(groups)).alias("grp"), "uid", "length",
                            F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                            F.lit(0).alias("source"), F.lit(0).alias("elite"), F.lit(-1).alias("bin"))
        for epoch in range(epochs):
            state = dealt.groupBy("grp", "island").applyInPandas(_island(capacity, population, generations, 2, epoch), STATE)
            if epoch < epochs - 1:  # elites stay and visit the next island
                dealt = state.select("grp", "uid", "length", "elite", "bin", F.col("island").alias("source"),
                                     F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(islands)))).alias("island"))
        state = saved(state.filter("elite = 0"))
        best = (state.groupBy("grp", "island").agg((F.max("bin") + 1).alias("bins")).groupBy("grp")
                .agg(F.min_by("island", F.struct("bins", "island")).alias("island")))
        best = state.join(best, ["grp", "island"]).select("uid", "length", "fill", "offset", (
            F.lit(level) * (1 << 56) + F.col("grp") * (1 << 20) + F.col("bin")).cast("long").alias("sequence_id"))
        bins = best.filter("offset = 0").count()
        if before is not None and bins > before:  # the level before packed these in fewer
            done.append(poor)
            break
        good = F.col("fill") * 100 >= 97 * capacity
        last = groups == 1 or bins <= least or before is not None and (before - bins) * SAVED < before
        done.append(best if last else best.filter(good))
        if last:
            break
        poor = saved(best.filter(~good))
        rest, before, level = poor.select("uid", "length"), poor.filter("offset = 0").count(), level + 1
    out = whole
    for part in done:
        out = out.unionByName(part.select("uid", "sequence_id", "offset"))
    return out


def op9(docs: DataFrame, capacity: int = 4096, file: str = "word_bpe_49k.json", end: int = 1) -> DataFrame:
    made = cut_pieces(docs, file, capacity, end)
    return made.join(pack(made, capacity), "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
