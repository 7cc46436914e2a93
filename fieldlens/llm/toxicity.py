"""Toxicity of texts: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Method: a text is the set of its character n-grams (``SIZES`` code points, lower case, inside words, with the blank before and after; other ASCII
than letters and digits counts as a blank), hashed to ``BUCKETS`` buckets. Over all labelled texts the number of texts of either class that hold
a bucket gives its ratio r = log((p + 1) / (P + 2)) - log((n + 1) / (N + 2)), where P and N are the texts of the class. The ``FEATURES`` buckets
in ``SUPPORT`` or more texts that tell the classes apart best (chi-square) are the features, each with the value r where present; a logistic regression over them is fitted
on at most ``LABELLED`` texts, half of them of either class, weighted to the classes' true shares.

Spread: tasks count into arrays of ``BUCKETS`` entries, pack them by range of buckets, and the ranges are summed where they meet, so what is shuffled
does not grow with the texts of a task. Only ``FEATURES`` rows reach the driver, and one task fits the bounded sample. Scoring is one pass over
whole texts without a shuffle; a text of any length is read in blocks.

Labels: null labels and ids match nothing; several labels of one id count as toxic if one is. With no or one class labelled every text gets the same
score, (P + 1) / (P + N + 2). Null and empty texts have no features and get the score of the bias. Rows are scored one by one, so copies score
alike. Other columns pass through ``score`` unless they are called ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import pieces, sized

SIZES = (3, 4, 5, 6)
BITS = 22
BUCKETS = 1 << BITS
RANGE = 1 << 14
FEATURES = 4_096
#: A feature is in at least this many labelled texts.
SUPPORT = 6
#: Bound of the texts that the regression is fitted on; the counts behind the ratios cover all labelled texts.
LABELLED = 8_000
#: Code points that are hashed at once.
BLOCK = 1 << 20
PENALTY = 1e-5
STEPS = 600

_PLAIN = np.arange(128, dtype=np.uint32)
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 32
_FACTOR, _ODD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """Buckets of the features in ascending order, what each adds to the log-odds, and the log-odds of a text without features."""

    bias: float
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of the texts, a blank before and behind each, and the row of each; one long text alone comes in blocks that overlap by an n-gram."""
    if len(texts) == 1:
        padded = f" {texts[0] or ''} "
        parts = [[padded[at:at + BLOCK + max(SIZES) - 1].lower()] for at in range(0, len(padded), BLOCK)]
    else:
        parts = [[f" {t.lower()} " if t else "" for t in texts]]
    for part in parts:
        code = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
        low = code < 128
        yield np.where(low, _PLAIN[np.where(low, code, 0)], code), np.repeat(np.arange(len(part)), [len(t) for t in part])


def _hits(codes: np.ndarray, rows: np.ndarray, lookup: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bucket of all n-grams; with ``lookup``, row and feature of those whose bucket is one."""
    blank = codes == 32
    with np.errstate(over="ignore"):
        value = codes[:-1].astype(np.uint64) * _FACTOR + codes[1:]
        inside = np.ones(len(codes) - 1, bool)  # no blank between first and last character
        for n in range(3, max(SIZES) + 1):
            inside = inside[:len(codes) - n + 1] & ~blank[n - 2:-1]
            value = value[:len(codes) - n + 1] * _FACTOR + codes[n - 1:]
            if not len(value):
                return
            if n in SIZES:
                bucket = ((value * _ODD) >> np.uint64(64 - BITS)).astype(np.int32)
                if lookup is None:
                    yield rows[1:len(value) + 1][inside], bucket[inside]
                else:
                    found = lookup[bucket]
                    at = np.flatnonzero(inside & (found >= 0))
                    yield rows[at + 1], found[at]


def features_of(texts: list[str | None], lookup: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket), or (row, feature) with a ``lookup`` of features by bucket, in ascending order."""
    seen = np.zeros(0, np.int64)
    for codes, rows in _blocks(texts):
        keys = [r * BUCKETS + b for r, b in _hits(codes, rows, lookup)] if len(codes) > 2 else []
        seen = np.unique(np.concatenate([seen, *keys]))
    return seen // BUCKETS, seen % BUCKETS


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for a, b in pieces(batch, "text", BLOCK):
        yield batch.slice(a, b - a)


def _counts(train: DataFrame) -> DataFrame:
    """Per feature candidate the texts of either class that hold it: (bucket, toxic, clean)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for part in _slices(batch):
                y = part.column("toxic").to_numpy(zero_copy_only=False)
                row, bucket = features_of(part.column("text").to_pylist())
                for kind in (0, 1):
                    total[kind] += np.bincount(bucket[y[row] == kind], minlength=BUCKETS).astype(np.int32)
        pack = zstandard.ZstdCompressor().compress
        used = [k for k in range(BUCKETS // RANGE) if total[:, k * RANGE:(k + 1) * RANGE].any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(
            [pack(np.ascontiguousarray(total[:, k * RANGE:(k + 1) * RANGE]).tobytes()) for k in used], pa.binary())], ["part", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k, data in zip(batch.column("part").to_pylist(), batch.column("data")):
                counts = np.frombuffer(unpack(data.as_py()), np.int32).reshape(2, RANGE)
                total[k] = total[k] + counts if k in total else counts.astype(np.int64)
        for k, counts in total.items():
            often = np.flatnonzero(counts.sum(0) >= SUPPORT)
            yield pa.RecordBatch.from_arrays([pa.array(often + k * RANGE), pa.array(counts[1, often]), pa.array(counts[0, often])],
                                             ["bucket", "toxic", "clean"])

    parts = train.select("text", "toxic").mapInArrow(count, "part int, data binary")
    return parts.repartition("part").mapInArrow(add, "bucket long, toxic long, clean long")


def _sample(train: DataFrame, count: dict[int, int], lookup: np.ndarray, labelled: int) -> DataFrame:
    """Labelled texts as their features: at most half of ``labelled`` distinct texts of each class, those of smallest hash."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                row, feature = features_of(part.column("text").to_pylist(), lookup)
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
                data = [feature[a:b].astype(np.int16).tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("toxic"), pa.array(data, pa.binary())], ["key", "toxic", "data"])

    keyed = train.select("text", "toxic", F.xxhash64("text", F.lit(12)).alias("key"))
    out = []
    for kind, n in count.items():
        # Equal texts share a hash, so the few of smallest hash are looked for among twice the share that is needed.
        share = min(1.0, (labelled // 2 * 2 + 200) / max(n, 1))
        few = keyed.filter(F.col("toxic") == kind)
        if share < 1:
            few = few.filter(F.col("key") <= int(share * 2 ** 64) - 2 ** 63)
        rows = few.mapInArrow(extract, "key long, toxic int, data binary").dropDuplicates(["key"])
        out.append(rows.orderBy("key").limit(labelled // 2))
    return out[0].unionByName(out[1])


def fitted(x: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, share: float) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic regression over features scaled by ``ratio``; ``share`` is that of class 1 among all labelled texts.

    Accelerated gradient descent on the mean loss, classes weighted to their shares, with a penalty on the weights before scaling."""
    size = np.array([len(v) for v in x])
    feature = np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(x)), size)
    cost = np.where(y == 1, share / max((y == 1).sum(), 1), (1 - share) / max((y == 0).sum(), 1))

    def margins(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, (w[:-1] * ratio)[feature], len(x)) + w[-1]

    def back(g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(feature, g[row], len(ratio)) * ratio, g.sum())

    w = np.ones(len(ratio) + 1)
    for _ in range(15):  # the largest curvature, by power iteration
        w = back(cost * margins(w / np.linalg.norm(w)))
    step = 1 / (0.3 * np.linalg.norm(w) + PENALTY)
    w = ahead = np.append(np.zeros(len(ratio)), np.log(share / (1 - share)))
    for k in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(margins(ahead), -40, 40)))
        new = ahead - step * (back(cost * (p - y)) + PENALTY * np.append(ahead[:-1], 0))
        w, ahead = new, new + k / (k + 3) * (new - w)
    return float(w[-1]), w[:-1] * ratio


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", labelled: int = LABELLED) -> Model:
    """A model of ``label`` (above 0 is toxic) learnt from the rows of ``docs`` that have one."""
    known = labels.filter(f"`{label}` is not null and `{key}` is not null").groupBy(F.col(f"`{key}`").alias("_id")) \
        .agg(F.max((F.col(f"`{label}`") > 0).cast("int")).alias("toxic"))
    rows = docs.select(F.col(f"`{key}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    train = rows.join(sized(known), "_id")
    count = {0: 0, 1: 0} | {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    if not count[0] or not count[1]:
        share = (count[1] + 1) / (count[0] + count[1] + 2)
        return Model(float(np.log(share / (1 - share))))
    p, n = F.col("toxic") + 0.0, F.col("clean") + 0.0
    a, b, both = F.lit(float(count[1])), F.lit(float(count[0])), float(count[0] + count[1])
    apart = F.pow(p * (b - n) - n * (a - p), F.lit(2.0)) * both / (a * b * (p + n) * F.greatest(both - p - n, F.lit(0.5)))
    best = _counts(train).orderBy(apart.desc(), "bucket").limit(FEATURES).toPandas().sort_values("bucket")
    bucket = best["bucket"].to_numpy(np.int64)
    ratio = np.log((best["toxic"].to_numpy() + 1) / (count[1] + 2)) - np.log((best["clean"].to_numpy() + 1) / (count[0] + 2))
    lookup = _lookup(bucket)
    share = count[1] / both

    def regress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((k, y, d) for batch in batches for k, y, d in zip(*(c.to_pylist() for c in batch.columns)))
        bias, weights = fitted([np.frombuffer(d, np.int16) for _, _, d in rows], np.array([y for _, y, _ in rows]), ratio, share)
        yield pa.RecordBatch.from_arrays([pa.array([bias]), pa.array([weights.tobytes()], pa.binary())], ["bias", "weights"])

    sample = _sample(train, count, lookup, labelled).repartition(1)
    bias, weights = sample.mapInArrow(regress, "bias double, weights binary").collect()[0]
    return Model(bias, bucket, np.frombuffer(weights, np.float64).copy())


def _lookup(buckets: np.ndarray) -> np.ndarray:
    """Number of the feature of a bucket, -1 for others."""
    out = np.full(BUCKETS, -1, np.int16)
    out[buckets] = np.arange(len(buckets))
    return out


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, from 0 to 1, of every row."""
    own = [c for c in docs.columns if c.lower() != "score"]

    def map_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup(model.buckets)
        for batch in batches:
            for a, b in pieces(batch, text, BLOCK):
                part = batch.slice(a, b - a)
                row, feature = features_of(part.column(text).to_pylist(), lookup)
                odds = np.bincount(row, model.weights[feature], part.num_rows) + model.bias
                yield pa.RecordBatch.from_arrays([part.column(c) for c in own] + [pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], names=[*own, "score"])

    return docs.mapInArrow(map_batches, T.StructType([docs.schema[c] for c in own] + [T.StructField("score", T.DoubleType())]))


def op12(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document, learnt from the labels of ids outside the held-out third."""
    third = lambda c: F.crc32(c.cast("string").cast("binary")) % 3
    model = fit(docs, labels.filter(third(F.col("doc_id")) != 1))
    return score(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(third(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                                                             (F.col("score") >= 0.7).cast("int").alias("predicted"))
