"""Token counts of texts of any length by overlap resynchronisation.

Short texts are encoded whole. A huge text is cut into chunks that overlap; the chunks are dealt over the cluster and each is encoded by
itself, with the offsets of the tokens in its two overlaps. Neighbours are spliced at the first boundary that both of them have and that is
proven stable: a blank behind a non-blank, where no pre-token and so no merge can cross. Texts with a chunk border where no such boundary is
found go round again with wider overlaps and chunks, in the end as one chunk.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted one by one. Other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import pieces, saved
from fieldlens.llm.tokens import encoder

CHUNK = 32_768
OVERLAP = 512
PART = "uid long, part int, parts int, total long, head array<struct<pos:long,before:long>>, tail array<struct<pos:long,before:long>>"


def _whole(file: str):
    def run(batches):
        enc = encoder(file)
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                counts = [len(x) // 4 for x in enc.encode([t or "" for t in batch.column("text")[lo:hi].to_pylist()])]
                yield pa.RecordBatch.from_arrays([batch.column("uid")[lo:hi], pa.array(counts, pa.int64())], names=["uid", "n_tokens"])

    return run


def _chunks(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist()):
                starts = range(0, max(1, len(text) - overlap), chunk)
                for k, at in enumerate(starts):
                    end = at + chunk + overlap if k + 1 < len(starts) else len(text)
                    yield pa.RecordBatch.from_pylist([{"uid": uid, "part": k, "parts": len(starts), "at": at, "text": text[at:end]}], schema=pa.schema(
                        [("uid", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("at", pa.int64()), ("text", pa.string())]))

    return run


def _boundaries(enc, text: str, lo: int, hi: int, base: int) -> list[tuple[int, int]]:
    """Stable boundaries of a chunk within lo..hi: place in the document and the chunk's tokens before it.

    The overlap is encoded with offsets from the nearest stable boundary on, and only token starts count."""
    cuts = [c for c in range(max(lo, 1), min(hi, len(text))) if text[c] == " " and not text[c - 1].isspace() and text[c - 1] != ">"]
    if not cuts:
        return []
    before = len(enc.encode([text[:cuts[0]]])[0]) // 4
    got = enc.library.encode(text[cuts[0]:hi], add_special_tokens=False)
    starts = [a + cuts[0] for a, _ in got.offsets]
    out, k = [], 0
    for c in cuts:
        while k < len(starts) and starts[k] < c:
            k += 1
        out.append((base + c, before + k))
    return out


def _encoded(file: str, overlap: int):
    def run(batches):
        enc = encoder(file)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, first, last = r["text"], r["part"] == 0, r["part"] == r["parts"] - 1
                head = [] if first else _boundaries(enc, text, 0, overlap, r["at"])
                tail = [] if last else _boundaries(enc, text, len(text) - overlap, len(text), r["at"])
                rows.append({"uid": r["uid"], "part": r["part"], "parts": r["parts"], "total": len(enc.encode([text])[0]) // 4,
                             "head": [{"pos": p, "before": n} for p, n in head], "tail": [{"pos": p, "before": n} for p, n in tail]})
            if rows:
                at = pa.list_(pa.struct([("pos", pa.int64()), ("before", pa.int64())]))
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("uid", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()),
                                                                         ("total", pa.int64()), ("head", at), ("tail", at)]))

    return run


def spliced(parts: DataFrame) -> DataFrame:
    """(uid, n_tokens), null where two neighbours have no boundary in common. The rows of a text are its chunks, a few numbers each."""
    here = parts.select("uid", "part", "parts", "total", "tail")
    after = parts.select("uid", (F.col("part") - 1).alias("part"), "head")
    both = here.join(after, ["uid", "part"], "left")
    hit = F.get(F.filter("tail", lambda t: F.exists("head", lambda h: h["pos"] == t["pos"])), F.lit(0))
    both = both.select("uid", "part", "parts", "total", "head", hit.alias("hit"))
    # Tokens up to the splice count for this chunk, those before the same place in the next chunk are taken off there.
    left = F.when(F.col("part") == F.col("parts") - 1, F.col("total")).otherwise(F.col("hit.before"))
    off = F.when(F.col("part") == F.col("parts") - 1, F.lit(0).cast("long")).otherwise(
        F.get(F.filter("head", lambda h: h["pos"] == F.col("hit.pos")), F.lit(0))["before"])
    return both.select("uid", (left - off).alias("n")).groupBy("uid").agg(
        F.when(F.count("n") == F.count(F.lit(1)), F.sum("n")).alias("n_tokens"))


def count_tokens(docs: DataFrame, file: str, *, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(uid, n_tokens) of rows (uid, text); uid must be unique."""
    docs = docs.select("uid", "text")
    short = F.coalesce(F.length("text"), F.lit(0)) <= chunk
    out = docs.filter(short).mapInArrow(_whole(file), "uid long, n_tokens long")
    todo = docs.filter(~short)
    while True:
        cut = todo.mapInArrow(_chunks(chunk, overlap), "uid long, part int, parts int, at long, text string")
        parts = cut.repartition(F.col("uid"), F.col("part")).mapInArrow(_encoded(file, overlap), PART)
        got = saved(spliced(parts))
        out = out.unionByName(got.filter("n_tokens is not null"))
        missed = got.filter("n_tokens is null")
        if missed.isEmpty():
            return out
        todo = todo.join(missed.select("uid"), "uid", "left_semi")
        chunk, overlap = chunk * 8, overlap * 32


def op4(docs: DataFrame, file: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """Counts per document. The row number stands for the document inside, as ids may repeat or be null."""
    rows = docs.select("doc_id", "text")
    whole = F.coalesce(F.length("text"), F.lit(0)) <= CHUNK
    short = rows.filter(whole).mapInArrow(_rows(file), "doc_id long, n_bytes long, n_tokens long")
    large = saved(rows.filter(~whole).select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"))
    long = large.select("uid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes")).join(count_tokens(large.filter(F.length("text") > CHUNK), file), "uid")
    return short.unionByName(long.select("doc_id", "n_bytes", "n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)


def _rows(file: str):
    def run(batches):
        enc = encoder(file)
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                texts = [t or "" for t in batch.column("text")[lo:hi].to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[lo:hi], pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([len(x) // 4 for x in enc.encode(texts)], pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run
