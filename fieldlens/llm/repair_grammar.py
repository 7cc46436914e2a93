"""Token ids of documents in files compressed by Re-Pair grammars, with random access.

Documents go to ranges of ascending doc_id; each range is written as blocks of about ``BLOCK`` ids. In a block, Re-Pair replaces the most
frequent pair of neighbouring symbols by a new nonterminal, over and over until no pair occurs twice; pairs never cross a document's end. Pairs
that can't change each other's counts are replaced together. A block row holds the rules, the expansion length of every nonterminal, the
remaining sequence, and per document its id, its number of ids and of remaining symbols, so that any document is decoded alone.

Null and empty texts are documents of the end id alone. Ties in doc_id are written in the order of their text. Rows with a null doc_id
come first. Other columns are not read. An empty table gives no blocks and no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldlens.llm.common import pieces, shared_folder
from fieldlens.llm.tokens import encoder, strung

BLOCK = 2_000_000
VOCABULARY = 50_257
BLOCKS = ("shard int, block int, n_ids long, doc_ids array<long>, counts array<int>, symbols array<int>, left array<int>, right array<int>, "
          "expansion array<int>, sequence binary")


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.n = np.empty(0, kind), 0

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]

    def add(self, more: np.ndarray):
        n = self.n + len(more)
        if n > len(self.room):
            self.room = np.concatenate([self.all, np.empty(max(n - self.n, self.n // 2), self.room.dtype)])
        self.room[self.n:n] = more
        self.n = n


def _sorted(x: np.ndarray, y: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs as ascending numbers, and where each stood; equal ones stay in order."""
    place, sign = len(x).bit_length(), symbols.bit_length()
    key = x.astype(np.int64)
    key <<= sign
    key |= y
    if place + 2 * sign > 63:
        order = np.argsort(key, kind="stable")
        return key[order], order
    # Places in the lower bits: numbers alone are sorted faster than places by numbers.
    key <<= place
    key |= np.arange(len(key))
    key.sort()
    order = key & ((1 << place) - 1)
    key >>= place
    return key, order


class _Pairs:
    """A block as a linked list of symbols, and the pairs that occur twice or more with their places.

    The count of a pair only falls once its symbols are made, so what occurs once is forgotten. The count of a symbol with itself is an upper
    bound until the pair's turn comes, as neighbours in a run overlap.
    """

    def __init__(self, ids: np.ndarray, counts: np.ndarray, first: int):
        self.n, self.symbols, self.ends = len(ids), first, np.cumsum(counts, dtype=np.int64)
        # What belongs to a place lies side by side in memory. Place n stands for a document's end on either side; it opens no pair.
        self.seq, self.after, self.before, self.pair = np.empty((self.n + 1, 4), np.int32).T
        self.seq[:-1], self.seq[-1], self.pair[:] = ids, 0, -1
        self.after[:], self.before[:] = np.arange(1, self.n + 2), np.arange(-1, self.n)
        self.after[self.ends - 1] = self.before[self.ends - counts] = self.n
        self.left, self.right, self.count, self.size, self.where, self.equal = (_Grown(np.int32) for _ in range(6))
        self.start = _Grown(np.int64)
        self.opens, self.closes = (np.empty(first + self.n // 2 + 1, np.int32) for _ in range(2))
        self._add(np.flatnonzero(self.after[:self.n] < self.n))

    def _add(self, at: np.ndarray):
        """Take in the pairs that stand at these places, if twice or more."""
        if not len(at):
            return
        key, order = _sorted(self.seq[at], self.seq[self.after[at]], self.symbols)
        size = np.diff(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])))
        del key
        often = size > 1
        at, size = at[order[np.repeat(often, size)]], size[often]
        head, known = np.cumsum(size) - size, self.count.n
        self.pair[at] = np.repeat(np.arange(known, known + len(size), dtype=np.int32), size)
        x, y = self.seq[at[head]], self.seq[self.after[at[head]]]
        self.equal.add(known + np.flatnonzero(x == y))
        self.start.add(head + self.where.n)
        for grown, more in (self.left, x), (self.right, y), (self.count, size), (self.size, size), (self.where, at):
            grown.add(more)

    def best(self, some: np.ndarray) -> np.ndarray:
        """Those of ``some``, which has the most frequent pairs, that Re-Pair replaces next: down to the first count where two may overlap.

        They leave each other's counts alone. A pair that a new symbol forms takes over places of a pair that overlapped, which isn't among
        them and so isn't more frequent than they are.
        """
        count = self.count.room[some]
        # Equal counts come in an order by chance, so that of a chain of them a share is replaced at once.
        order = np.argsort(count.astype(np.int64) << 32 | some * 2654435761 & 0xFFFFFFFF)[::-1]
        some, count = some[order], count[order]
        x, y, rank = self.left.room[some], self.right.room[some], np.arange(len(some), dtype=np.int32)
        # Its most frequent pair tells whether a symbol opens pairs, closes them or stands by itself.
        opens, closes = self.opens, self.closes
        opens[y] = closes[x] = len(some)
        opens[x[::-1]] = rank[::-1]
        closes[y[::-1]] = rank[::-1]
        fit = np.where(x == y, (opens[x] == rank) & (closes[x] == rank), (opens[x] < closes[x]) & (closes[y] < opens[y]))
        if not fit.all():
            fit &= count >= count[fit.argmin()]
        return some[fit]

    def _fall(self, at: np.ndarray) -> np.ndarray:
        """The pairs at these places are gone. Returns which of them had occurred twice or more."""
        pair = self.pair[at].astype(np.int64)
        known = pair >= 0
        np.subtract.at(self.count.room, pair[known], np.int32(1))
        self.pair[at] = -1
        return known

    def _apart(self, chosen: np.ndarray, at: np.ndarray, rule: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """In a run of one symbol every other place.

        Pairs wait for their turn that are rarer than their bound and the other chosen ones, or than what may follow a new symbol in a run: itself
        or the symbol left over.
        """
        equal = self.left.room[chosen] == self.right.room[chosen]
        if not equal.any():
            return chosen, at, rule
        place = np.flatnonzero(equal[rule])
        run, number, opens = at[place], np.arange(len(place)), np.ones(len(place), bool)
        opens[1:] = self.after[run[:-1]] != run[1:]
        whole = np.ones(len(at), bool)
        whole[place] = (number - np.maximum.accumulate(np.where(opens, number, 0))) % 2 == 0
        runs = np.bincount(rule[~whole], minlength=1).max()
        at, rule = at[whole], rule[whole]
        count, bound = np.bincount(rule, minlength=len(chosen)), self.count.room[chosen]
        self.count.room[chosen] = count
        order = np.argsort(-count, kind="stable")
        order = order[count[order] >= max(bound.min(), runs)]
        turn = np.full(len(chosen), -1)
        turn[order] = np.arange(len(order))
        rule = turn[rule]
        return chosen[order], at[rule >= 0], rule[rule >= 0]

    def replace(self, chosen: np.ndarray) -> np.ndarray:
        """A new symbol for each of these pairs, which can't overlap, at all their places. Returns those replaced, in order of the symbols."""
        size = self.size.room[chosen]
        # Places as 64-bit numbers, by which numpy looks up faster.
        at, rule = strung(self.where.all, self.start.room[chosen], size).astype(np.int64), np.repeat(np.arange(len(chosen)), size)
        still = self.pair[at] == chosen[rule]
        at, rule = at[still], rule[still]
        chosen, at, rule = self._apart(chosen, at, rule)
        bounds = self.count.room[self.equal.all]
        gone, near = self.after[at].astype(np.int64), self.before[at].astype(np.int64)
        far = self.after[gone]
        # What a new symbol forms with its neighbours is no more frequent than what the old ones formed. Two that stand together are one pair.
        fresh = [at[self._fall(gone)], near[self._fall(near)]]
        self.count.room[self.equal.all] = bounds
        self.count.room[chosen] = 0
        self.pair[at] = -1
        self.seq[at], self.seq[gone] = self.symbols + rule, -1
        self.after[at], self.before[far] = far, at
        self.symbols += len(chosen)
        self._add(np.concatenate(fresh))
        return chosen


def compress(ids: np.ndarray, counts: np.ndarray, *, first: int = VOCABULARY, rounds: int | None = None, pairs: int | None = None):
    """(sequence, symbols per document, left, right, expansion lengths of the nonterminals).

    Goes on until no pair occurs twice, unless a caller asks for no more than ``rounds`` times ``pairs`` rules.
    """
    block = _Pairs(ids, counts, first)
    more = len(ids) if rounds is None or pairs is None else rounds * pairs
    none = np.zeros(0, np.int32)
    left, right, size = [none], [none], np.ones(first + len(ids) // 2 + 1, np.int32)
    least, live = len(ids), none
    while more > 0:
        live = live[block.count.room[live] >= least]
        if not len(live):
            # Only pairs near the most frequent one are looked at, until there are none.
            most = int(block.count.all.max(initial=0))
            if most < 2:
                break
            least = max(min(least, most) * 7 // 8, 2)
            live = np.flatnonzero(block.count.all >= least)
        known, begin = block.count.n, block.symbols
        done = block.replace(block.best(live)[:more])
        left.append(block.left.room[done])
        right.append(block.right.room[done])
        size[begin:block.symbols] = size[left[-1]] + size[right[-1]]
        more -= len(done)
        live = np.concatenate([live, np.arange(known, block.count.n)])
    stays = block.seq[:-1] >= 0
    bounds = np.concatenate([[0], np.cumsum(stays)])[np.concatenate([[0], block.ends])]
    return block.seq[:-1][stays], np.diff(bounds).astype(np.int32), np.concatenate(left), np.concatenate(right), size[first:block.symbols]


def expand(sequence: np.ndarray, left: np.ndarray, right: np.ndarray, expansion: np.ndarray, first: int = VOCABULARY) -> np.ndarray:
    """The ids of a sequence of terminals and nonterminals."""
    height = [0] * first
    for x, y in zip(left.tolist(), right.tolist()):
        height.append(1 + max(height[x], height[y]))
    height = np.array(height[first:], np.int32)
    order = np.argsort(height, kind="stable")
    # Terminals stand for themselves in front of what the rules stand for, the flattest rules first, so that those of one height are filled at once.
    length = np.concatenate([np.ones(first, np.int64), expansion])
    begin, ends = np.arange(len(length)), first + np.concatenate([[0], np.cumsum(expansion[order], dtype=np.int64)])
    begin[first + order] = ends[:-1]
    flat = np.zeros(int(ends[-1]), np.int32)
    flat[:first] = np.arange(first)
    edges = np.flatnonzero(np.diff(height[order], prepend=0, append=-1)).tolist()
    for lo, hi in zip(edges, edges[1:]):
        parts = np.stack([left[order[lo:hi]], right[order[lo:hi]]], 1).ravel()
        flat[ends[lo]:ends[hi]] = strung(flat, begin[parts], length[parts])
    return strung(flat, begin[sequence], length[sequence])


def _writer(file: str, end: int):
    def run(batches):
        from pyspark import TaskContext

        enc, shard, block = encoder(file), TaskContext.get().partitionId(), 0
        docs, raws, sizes, held = [], [], [], 0

        def row():
            counts = np.concatenate(sizes).astype(np.int32)
            seq, symbols, left, right, size = compress(np.concatenate(raws), counts)
            values = [[shard], [block], [int(counts.sum())], [docs], [counts], [symbols], [left], [right], [size], [seq.astype("<i4").tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names=[
                "shard", "block", "n_ids", "doc_ids", "counts", "symbols", "left", "right", "expansion", "sequence"])

        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                docs += batch.column("doc_id")[lo:hi].to_pylist()
                ids, n = enc.listed(batch.column("text")[lo:hi])
                raws.append(np.insert(ids, np.cumsum(n), end))
                sizes.append(n + 1)
                held += len(raws[-1])
                if held >= BLOCK:
                    yield row()
                    block += 1
                    docs, raws, sizes, held = [], [], [], 0
        if docs:
            yield row()

    return run


def write(docs: DataFrame, path: str, *, file: str = "byte_bpe_50k.json", end: int = 2) -> None:
    """Write ``docs`` (doc_id, text) as blocks in ascending doc_id order."""
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(_writer(file, end), BLOCKS).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, place, doc_id, n_tokens, ids_crc32) of every document in the files, decoded."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                get = {n: batch.column(n)[k] for n in ("doc_ids", "counts", "symbols", "left", "right", "expansion")}
                get = {n: v.values.to_numpy(zero_copy_only=False) if n != "doc_ids" else v.as_py() for n, v in get.items()}
                seq = np.frombuffer(batch.column("sequence")[k].as_buffer(), "<i4")
                raw = expand(seq, get["left"], get["right"], get["expansion"]).astype("<u4").tobytes()
                ends = np.cumsum(get["counts"], dtype=np.int64) * 4
                crc = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
                n = len(crc)
                before = ends // 4 - get["counts"]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("shard")[k].as_py()] * n, pa.int32()),
                                                  pa.array([batch.column("block")[k].as_py()] * n, pa.int32()), pa.array(before, pa.int64()),
                                                  pa.array(get["doc_ids"], pa.int64()), pa.array(get["counts"], pa.int64()), pa.array(crc, pa.int64())],
                                                 names=["shard", "block", "before", "doc_id", "n_tokens", "ids_crc32"])

    return spark.read.parquet(path).mapInArrow(run, "shard int, block int, before long, doc_id long, n_tokens long, ids_crc32 long")


def op5(docs: DataFrame) -> DataFrame:
    """Digest of the ids read back. One small row per block numbers the blocks; a block holds millions of ids."""
    spark = docs.sparkSession
    write(docs, path := shared_folder(spark, "ids"))
    blocks = spark.read.parquet(path).select("shard", "block", "n_ids")
    per_shard = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = per_shard.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("s0"))
    blocks = blocks.select("shard", "block", (F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")).alias("b0"))
    starts = blocks.join(shards, "shard").select("shard", "block", (F.col("s0") + F.col("b0")).alias("base"))
    return read(spark, path).join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
