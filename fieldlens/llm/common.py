"""Small helpers of the corpus operators: tables, shared checkpoint folder, vectorised words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder of the session, so that later jobs reread it and lost executors don't matter."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            folder = tempfile.mkdtemp(prefix="checkpoint-")  # only where the cluster names no shared folder, as in tests
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: Rows of ids, or of ids with a short list, up to which a side of a join is broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written once, and marked for a broadcast if it was counted to have at most ``rows`` rows."""
    df = saved(df)
    return F.broadcast(df) if df.count() <= rows else df


def row_key(docs: DataFrame):
    """A 64-bit key of a row's id and text, by which stages decide per row whatever ids repeat or are null; equal rows share it."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array, nulls as empty, and the offsets of its rows."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds, data = column.buffers()[1:]
    at = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, at - at[0] if len(column) else np.zeros(1, np.int64)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


#: Powers of a base that a process keeps; longer tables are made for one text and forgotten.
_KEPT = 4 << 20
_TABLES: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """Powers 0 to n."""
    table = _TABLES.get(base)
    if table is None or len(table) <= n:
        table = np.full(max(n, 1 << 20) + 1, np.uint64(base))
        table[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(table, out=table)
        if len(table) <= _KEPT + 1:
            _TABLES[base] = table
    return table[:n + 1]


BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)


class Prefix:
    """Polynomial hashes modulo 2**64 of any span of a byte array, from prefix sums."""

    def __init__(self, raw: np.ndarray):
        self.back = _powers(len(raw), INVERSE)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        inner = self.sums[1:]
        np.take(_BYTE, raw, out=inner)
        inner *= _powers(len(raw), BASE)[:-1]
        np.cumsum(inner, out=inner)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * _ODD)

    def windows(self, width: int, step: int = 1 << 15) -> np.ndarray:
        """Hashes of all spans of one width; ``step`` of them at a time stay in a core's memory."""
        out = np.empty(max(len(self.sums) - width, 0), np.uint64)
        with np.errstate(over="ignore"):
            size = np.uint64(width) * _ODD
            for lo in range(0, len(out), step):
                hi = min(lo + step, len(out))
                out[lo:hi] = mixed((self.sums[lo + width:hi + width] - self.sums[lo:hi]) * self.back[lo:hi] + size)
        return out


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all rows, with A-Z in lower case: the bytes, where words start and end, and per row the number of its first word (and the total)."""
    raw, at = utf8(column)
    raw = _LOWER[raw]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _WORD[raw]
    cut = at[1:-1]
    start = inside[1:-1] & ~inside[:-2]
    start[cut[cut < len(raw)]] |= inside[1:-1][cut[cut < len(raw)]]
    end = inside[1:-1] & ~inside[2:]
    last = cut[cut > 0] - 1
    end[last] |= inside[1:-1][last]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return raw, s, e, np.searchsorted(s, at)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and per row the number of its first word (and the total)."""
    raw, s, e, first = words(column)
    return Prefix(raw)(s, e), first


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Slices of a batch with at most ``most`` bytes of text, a longer row alone: (first row, last row)."""
    sizes = pc.binary_length(batch.column(column).cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if len(sizes) > start:
        yield start, len(sizes)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder of the session."""
    import uuid

    saved_to = spark.sparkContext.getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", None) or saved_to
    if base is None:
        saved(spark.range(0))  # sets the session's folder
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read back."""
    df.write.parquet(path := shared_folder(df.sparkSession, name))
    return df.sparkSession.read.parquet(path)
