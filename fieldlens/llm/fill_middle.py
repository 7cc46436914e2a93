"""Fill-in-middle transformation over seekable compressed frames.

Method: ``store`` keeps a text as independent zstandard frames of at most ``FRAME`` bytes, cut where a line begins (inside a line only if it is
longer than a frame), each with the number of lines and code points before it. ``fill_in_middle`` finds both cuts in those counts and opens only
the frames that hold a cut; all others go into the output as they are, still compressed, between the marks. The output is a list of frames, which
put together are one valid zstandard stream; digests and the restored text stream it frame by frame.

Lines are the units: ``[^\\n]*\\n|[^\\n]+``. The cuts come from a hash of seed and id, so they are the same in every run. A text stays plain if it is
empty, holds a mark, or is not drawn at ``rate`` percent. Null texts are empty; a null id is hashed as an empty one. Rows are judged one by one, so
repeated ids and rows do not matter; nothing is shuffled, and a task holds one text at a time. Other columns pass through unless they bear the name
of a result column, which wins.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fieldlens.llm.common import stored

FRAME = 64 << 10
#: Bytes of results that a task gathers before it hands them on.
BATCH = 4 << 20
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
ORDER = {"psm": "PSM", "spm": "SPM"}

STORE = T.StructType([T.StructField("n", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("marked", T.BooleanType()),
                      T.StructField("frames", T.ArrayType(T.StructType([
                          T.StructField("units", T.LongType()), T.StructField("chars", T.LongType()), T.StructField("opens", T.BooleanType()),
                          T.StructField("data", T.BinaryType())])))])
OUTPUT = T.StructType([T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                       T.StructField("middle_chars", T.LongType()), T.StructField("output", T.ArrayType(T.BinaryType()))])
DIGEST = T.StructType([T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType())])


def _mapped(df: DataFrame, inputs: tuple[str, ...], result: T.StructType, make, keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``inputs``, and the columns of ``result`` that ``make`` gives for the inputs of a row: values, and their size in bytes."""
    own = [c for c in df.columns if c in keep or c.lower() not in {x.lower() for x in (*inputs, *result.names)}]
    schema = T.StructType([df.schema[c] for c in own] + list(result))
    from pyspark.sql.pandas.types import to_arrow_schema

    types = [f.type for f in to_arrow_schema(T.StructType(list(result)))]

    def map_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, start, held, size = [batch.column(c) for c in inputs], 0, [], 0
            for i in range(batch.num_rows):
                values, n = make(*[c[i].as_py() for c in columns])
                held.append(values)
                size += n
                if size >= BATCH or i + 1 == batch.num_rows:
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in own] + [pa.array(v, t) for v, t in zip(zip(*held), types)],
                                                     names=own + result.names)
                    start, held, size = i + 1, [], 0

    return df.mapInArrow(map_batches, schema)


def frames_of(text: str, most: int = FRAME) -> list[dict]:
    """The frames of a text of any length; none if it is empty."""
    raw, pack = text.encode(), zstandard.ZstdCompressor().compress
    if len(raw) <= most:
        return [{"units": 0, "chars": 0, "opens": True, "data": pack(raw)}] if raw else []
    data = np.frombuffer(raw, np.uint8)
    starts = np.append(0, np.flatnonzero(data[:-1] == 10) + 1)  # of the lines
    out, at, chars = [], 0, 0
    while at < len(raw):
        end = min(at + most, len(raw))
        if end < len(raw):
            line = int(starts[np.searchsorted(starts, end, "right") - 1])
            if line > at:
                end = line
            while data[end] & 0xC0 == 0x80:  # never inside a code point
                end -= 1
        units = int(np.searchsorted(starts, at))
        out.append({"units": units, "chars": chars, "opens": at == 0 or raw[at - 1] == 10, "data": pack(raw[at:end])})
        chars += int(np.count_nonzero(data[at:end] & 0xC0 != 0x80))
        at = end
    return out


def n_units(text: str) -> int:
    return text.count("\n") + (text != "" and text[-1] != "\n")


def store(docs: DataFrame, *, text: str = "text", frame: int = FRAME) -> DataFrame:
    """``docs`` without their text, which is kept as ``frames`` with cumulative counts, its number of lines ``n`` and ``n_chars``; ``marked`` is
    true if a mark occurs in it."""
    if frame < 4:
        raise ValueError("a frame holds at least one code point of four bytes")

    def make(t):
        t = t or ""
        frames = frames_of(t, frame)
        return (n_units(t), len(t), any(m.decode() in t for m in MARKS.values()), frames), sum(len(f["data"]) for f in frames) + 64

    return _mapped(docs, (text,), STORE, make)


def _place(frames: list[dict], n: int, chars: int, unit: int, opened: dict[int, bytes]) -> tuple[int, int, int]:
    """Frame, byte in it, and code points before the beginning of a line; ``opened`` keeps the frames that had to be read."""
    if unit >= n:
        return len(frames), 0, chars
    if unit == 0:
        return 0, 0, 0
    k = bisect_right(frames, unit, key=lambda f: f["units"]) - 1
    f = frames[k]
    skip = unit - f["units"] + (not f["opens"])  # line ends to pass in this frame
    if skip == 0:
        return k, 0, f["chars"]
    if k not in opened:
        opened[k] = zstandard.ZstdDecompressor().decompress(f["data"])
    at = int(np.flatnonzero(np.frombuffer(opened[k], np.uint8) == 10)[skip - 1]) + 1
    return k, at, f["chars"] + len(opened[k][:at].decode())


def _between(frames: list[dict], a: tuple, b: tuple, opened: dict[int, bytes]) -> list[bytes]:
    """Compressed frames of the text from place to place; only frames with a cut are packed anew."""
    pack = zstandard.ZstdCompressor().compress
    (fa, oa, _), (fb, ob, _) = a, b
    if fa == fb:
        return [pack(opened[fa][oa:ob])] if ob > oa else []
    head = [pack(opened[fa][oa:])] if oa else [frames[fa]["data"]]
    return head + [f["data"] for f in frames[fa + 1:fb]] + ([pack(opened[fb][:ob])] if ob else [])


def transformed(doc_id: object, n: int, chars: int, marked: bool, frames: list[dict], *, seed: int, rate: int, spm: int) -> tuple:
    """Form, code points of prefix and middle, and output frames of one stored text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not frames or marked or h3 % 100 >= rate:
        return n, "plain", None, None, [f["data"] for f in frames]
    form = "spm" if h4 % 100 < spm else "psm"
    opened: dict[int, bytes] = {}
    places = [_place(frames, n, chars, u, opened) for u in (0, *sorted((h1 % (n + 1), h2 % (n + 1))), n)]
    part = {name: _between(frames, a, b, opened) for name, a, b in zip("PMS", places, places[1:])}
    pack = zstandard.ZstdCompressor().compress
    output = [blob for name in ORDER[form] for blob in (pack(MARKS[name]), *part[name])]
    return n, form, places[1][2], places[2][2] - places[1][2], output


def fill_in_middle(stored_texts: DataFrame, *, key: str = "doc_id", seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """Rows of ``store`` with ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``, the frames of the transformed text.

    ``rate`` percent of the texts are transformed, ``spm`` percent of those with the suffix first."""
    def make(doc_id, n, chars, marked, frames):
        values = transformed(doc_id, n, chars, marked, frames, seed=seed, rate=rate, spm=spm)
        return values, sum(map(len, values[-1])) + 64

    return _mapped(stored_texts, (key, *STORE.names), OUTPUT, make, keep=(key,))


def opened_frames(output: list[bytes]) -> Iterator[bytes]:
    """The transformed text, frame by frame."""
    unpack = zstandard.ZstdDecompressor()
    return map(unpack.decompress, output)


def restored(output: list[bytes], form: str) -> Iterator[bytes]:
    """The original text, frame by frame, from output and form alone: one pass finds the marks, each part is then read in its order."""
    if form == "plain":
        yield from opened_frames(output)
        return
    names, ends, tail, total, marks = ORDER[form], [], b"", 0, []
    for data in opened_frames(output):
        view, base = tail + data, total - len(tail)
        while len(marks) < 3:
            after = marks[-1] + 3 - base if marks else 0
            found = view.find(MARKS[names[len(marks)]], max(after, 0))
            if found < 0:
                break
            marks.append(base + found)
        total += len(data)
        ends.append(total)
        tail = view[-2:]
    bounds = dict(zip(names, zip([m + 3 for m in marks], [*marks[1:], total])))
    for name in "PMS":
        a, b = bounds[name]
        for k in range(bisect_right(ends, a), len(output)):
            begin = ends[k - 1] if k else 0
            if begin >= b:
                break
            data = zstandard.ZstdDecompressor().decompress(output[k])
            yield data[max(a - begin, 0):b - begin]


def digests(transformed_texts: DataFrame) -> DataFrame:
    """Rows of ``fill_in_middle`` with hashes of the output and of the text restored from it instead of the output itself."""
    def make(output, form):
        values = []
        for chunks in (opened_frames(output), restored(output, form)):
            h = hashlib.sha256()
            for data in chunks:
                h.update(data)
            values.append(h.hexdigest())
        return tuple(values), 128

    return _mapped(transformed_texts, ("output", "form"), DIGEST, make, keep=("form",))


def texts(transformed_texts: DataFrame) -> DataFrame:
    """Rows of ``fill_in_middle`` with the transformed text as a string, ``text``, instead of frames."""
    def make(output):
        data = b"".join(opened_frames(output)).decode()
        return (data,), len(data)

    return _mapped(transformed_texts, ("output",), T.StructType([T.StructField("text", T.StringType())]), make)


def op13(docs: DataFrame) -> DataFrame:
    """The digest of every document, from frames written to the shared folder and read again."""
    kept = stored(store(docs.select("doc_id", "text")), "frames")
    return digests(fill_in_middle(kept)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM h),
p AS (SELECT doc_id, n, t, array_to_string(list_slice(u, 1, a), '') AS pre, array_to_string(list_slice(u, a + 1, b), '') AS mid,
             array_to_string(list_slice(u, b + 1, n), '') AS suf,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
