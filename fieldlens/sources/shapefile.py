"""Shapefile reading by ranges of records: the index gives the place of every record, the table has records of one width.

The files of a folder are listed without their content; each file becomes as many ranges as its size asks for, and a task opens the three files
of its range at the right places. Contents that are in memory anyway (members of archives, file systems that only Spark reads) are decoded whole.
Both decode with numpy and Arrow, column by column; the projection is inverted with columns.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.align import unique_names
from fieldlens.sources.listing import base_name, extension, folder_of

PARTS = ("shp", "dbf", "prj", "cpg")
ROW_SCHEMA = ("_path string, _source string, _file_date date, _row_src long, attributes map<string,string>, "
              "geom struct<gtype:string,parts:array<array<struct<x:double,y:double>>>>, _crs_assumed boolean, "
              "utm_zone int, utm_south boolean, crs_unknown boolean, error string")
_XY = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_GEOM = pa.struct([("gtype", pa.string()), ("parts", pa.list_(pa.list_(_XY)))])
_ROWS = pa.schema([("_path", pa.string()), ("_source", pa.string()), ("_file_date", pa.date32()), ("_row_src", pa.int64()),
                   ("attributes", pa.map_(pa.string(), pa.string())), ("geom", _GEOM), ("_crs_assumed", pa.bool_()), ("utm_zone", pa.int32()),
                   ("utm_south", pa.bool_()), ("crs_unknown", pa.bool_()), ("error", pa.string())])
#: Bytes of geometry or table that one task reads.
RANGE = 16 << 20

# Shape type codes of the format (with z or m variants) and their geometry.
POINTS, LINES, POLYGONS, MULTIPOINTS = (1, 11, 21), (3, 13, 23), (5, 15, 25), (8, 18, 28)


def record_places(shp: bytes) -> np.ndarray:
    """Where the records begin, by walking over a whole file without index."""
    out, at = [], 100
    while at + 8 <= len(shp):
        out.append(at)
        at += 8 + 2 * struct.unpack_from(">i", shp, at + 4)[0]
    return np.array(out, np.int64)


def decode_shapes(shp: bytes, at: np.ndarray) -> pa.Array:
    """Geometry (type and 2D parts) of the records that begin at ``at``; unknown and empty shapes have no parts."""
    if not len(at):
        return pa.array([], _GEOM)
    # Views that start at every byte, as records need not be aligned.
    view = lambda t, n: np.ndarray((max(len(shp) - n + 1, 0),), t, shp, strides=(1,))
    i4, f8 = view("<i4", 4), view("<f8", 8)
    size = 2 * view(">i4", 4)[at + 4].astype(np.int64)
    if (at + 8 + size).max() > len(shp):
        raise ValueError("record beyond the end of the file")
    kind = np.zeros(len(at), np.int32)
    kind[size >= 4] = i4[at[size >= 4] + 8]
    point, multi, line, polygon = (np.isin(kind, k) for k in (POINTS, MULTIPOINTS, LINES, POLYGONS))
    path = line | polygon
    n_points = point.astype(np.int64)
    n_points[path], n_points[multi] = i4[at[path] + 48], i4[at[multi] + 44]
    n_parts = np.where(multi, n_points, point)
    n_parts[path] = i4[at[path] + 44]
    first = at + np.where(point, 12, 48) + np.where(path, 4 + 4 * n_parts, 0)
    base = np.append(0, np.cumsum(n_points))
    inside = lambda n: np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(first, n_points) + 16 * inside(n_points)
    x, y = f8[place], f8[place + 8]
    owner, j = np.repeat(np.arange(len(at)), n_parts), inside(n_parts)
    start = np.where(multi[owner], j, 0)
    listed = path[owner]
    start[listed] = i4[at[owner[listed]] + 52 + 4 * j[listed]]
    rings = np.append(base[owner] + start, base[-1])
    # Outer rings of a polygon record run clockwise.
    ring = np.repeat(np.arange(len(owner)), np.diff(rings))
    same = ring[1:] == ring[:-1]
    turn = np.bincount(ring[1:][same], ((x[1:] - x[:-1]) * (y[1:] + y[:-1]))[same], len(owner))
    outer = np.bincount(owner[turn > 0], minlength=len(at))
    kinds = np.select([point, multi, line & (n_parts <= 1), line, polygon & (outer <= 1), polygon],
                      ["Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon"], "Point")
    points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], fields=list(_XY))
    parts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_parts)), pa.int32()), pa.ListArray.from_arrays(pa.array(rings, pa.int32()), points))
    return pa.StructArray.from_arrays([pa.array(kinds.tolist(), pa.string()), parts], fields=list(_GEOM))


def table_fields(head: bytes) -> tuple[int, int, int, list[tuple[bytes, str, int]]]:
    """Number of rows, length of the header, width of a row, and (name, kind, size) of the fields of a DBF table."""
    n_rows, header, width = struct.unpack_from("<iHH", head, 4)
    fields, at = [], 32
    while head[at] != 0x0D:
        fields.append((head[at:at + 11].split(b"\0")[0], chr(head[at + 11]), head[at + 16]))
        at += 32
    return n_rows, header, width, fields


def is_latin(data: bytes) -> bool:
    """True if names or values are not UTF-8, which makes the whole file Latin-1."""
    try:
        return "\ufffd" in data.decode("utf-8")
    except UnicodeDecodeError:
        return True


def _cells(rows: bytes, width: int, fields: list) -> Iterator[np.ndarray]:
    """Per field the bytes of all rows, fixed in width."""
    grid = np.frombuffer(rows, np.uint8)[:len(rows) // width * width].reshape(-1, width)
    at = 1
    for _, _, size in fields:
        yield np.ascontiguousarray(grid[:, at:at + size])
        at += size


def latin_range(rows: bytes, width: int, fields: list) -> bool:
    """``is_latin`` of the values of some rows; a blank between values keeps bytes of two cells apart."""
    return any(is_latin(np.insert(cells, size, 32, axis=1).tobytes()) for cells, (_, _, size) in zip(_cells(rows, width, fields), fields))


def decode_cells(rows: bytes, width: int, fields: list, latin: bool) -> list[pa.Array]:
    """Text of every field: trimmed, null if empty, all stars or an unknown truth value; dates as yyyy-mm-dd."""
    out = []
    for cells, (_, kind, size) in zip(_cells(rows, width, fields), fields):
        if latin:
            text = pa.array(np.frombuffer(cells.astype("<u4").tobytes(), f"<U{size}").tolist() if size else [""] * len(cells), pa.string())
        else:
            text = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(cells), [None, pa.py_buffer(cells.tobytes())]).cast(pa.binary()).cast(pa.string()) \
                if size else pa.array([""] * len(cells))
        text = pc.replace_substring(text, "\0", "")
        text = pc.utf8_trim_whitespace(text) if kind in "NFLD" else pc.utf8_rtrim_whitespace(text)
        text = pc.if_else(pc.match_substring_regex(text, r"^\**$"), None, text)
        if kind == "L":
            text = pc.if_else(pc.equal(text, "?"), None, pc.if_else(pc.is_in(text, pa.array(list("YyTt"))), "True", pc.if_else(pc.is_valid(text), "False", None)))
        if kind == "D":
            text = pc.if_else(pc.equal(pc.utf8_length(text), 8), pc.binary_join_element_wise(
                *(pc.utf8_slice_codeunits(text, a, b) for a, b in ((0, 4), (4, 6), (6, 8))), "-"), text)
        out.append(text)
    return out


def projection(prj: str | None) -> tuple[bool, int | None, bool, bool]:
    """(assumed, UTM zone, southern, unknown) from projection text: WGS84 and UTM on WGS84 are supported."""
    if not prj or not prj.strip():
        return True, None, False, False
    if prj.lstrip().upper().startswith("GEOGCS"):
        return False, None, False, not re.search(r"WGS[_ ]?(19)?84", prj, re.I)
    m = re.search(r"UTM[_ ]zone[_ ](\d+)\s*([NS])", prj, re.I)
    if m and re.search(r"WGS[_ ]?(19)?84", prj, re.I):
        return False, int(m.group(1)), m.group(2).upper() == "S", False
    return False, None, False, True


def _batch(path: str, day, first: int, n: int, shapes: pa.Array, fields: list, cells: list[pa.Array], latin: bool, prj: str | None) -> pa.RecordBatch:
    """Rows numbered from ``first``; the side that is shorter is filled with nulls, so that no record is lost."""
    names = unique_names([f[0].decode("latin-1" if latin else "utf-8") for f in fields])
    pad = lambda a: pa.concat_arrays([a, pa.nulls(n - len(a), a.type)])
    k = len(names)
    values = pa.concat_arrays([pad(c) for c in cells]).take(pa.array((np.arange(k) * n + np.arange(n)[:, None]).ravel())) if k and n else pa.array([], pa.string())
    maps = pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(names * n, pa.string()), values)
    assumed, zone, south, unknown = projection(prj)
    same = [path, path.rsplit("/", 1)[-1], day]
    columns = [pa.array([v] * n, f.type) for v, f in zip(same, _ROWS)] + [pa.array(np.arange(first, first + n)), maps, pad(shapes)]
    columns += [pa.array([v] * n, f.type) for v, f in zip((assumed, zone, south, unknown, None), list(_ROWS)[6:])]
    return pa.RecordBatch.from_arrays(columns, schema=_ROWS)


def _failed(path: str, day, e: Exception) -> pa.RecordBatch:
    row = [path, path.rsplit("/", 1)[-1], day, 0, None, None, False, None, False, False, f"Lecture impossible : {type(e).__name__}"]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ROWS)], schema=_ROWS)


def _decode_whole(group: pa.Table) -> pa.Table:
    part = {r["ext"]: r for r in group.select(["ext", "path", "content", "file_date"]).to_pylist()}
    if "shp" not in part:
        return pa.Table.from_batches([], _ROWS)
    path, shp, day = (part["shp"][c] for c in ("path", "content", "file_date"))
    try:
        shapes = decode_shapes(shp, record_places(shp))
        n, fields, cells, latin = 0, [], [], False
        if "dbf" in part:
            dbf = part["dbf"]["content"]
            n, header, width, fields = table_fields(dbf)
            rows = dbf[header:header + n * width]
            if len(rows) < n * width:
                raise ValueError("table cut short")
            latin = latin_range(rows, width, fields) or any(is_latin(f[0]) for f in fields)
            cells = decode_cells(rows, width, fields, latin)
        prj = part["prj"]["content"].decode("latin-1") if "prj" in part else None
        return pa.Table.from_batches([_batch(path, day, 1, max(n, len(shapes)), shapes, fields, cells, latin, prj)])
    except Exception as e:
        return pa.Table.from_batches([_failed(path, day, e)])


def _parts(files: DataFrame, extensions: tuple[str, ...] = PARTS) -> DataFrame:
    return files.withColumns({"ext": extension(F.col("path")), "dir": folder_of(F.col("path")),
                              "stem": F.lower(F.regexp_replace(base_name(F.col("path")), r"\.[^.]*$", ""))}).filter(F.col("ext").isin(*extensions))


def decode_groups(files: DataFrame) -> DataFrame:
    """Rows of all shapefiles among (path, content, file_date); an unreadable file gives one error row."""
    # a group is the handful of parts of one shapefile
    return _parts(files).select("dir", "stem", "ext", "path", "content", "file_date").groupBy("dir", "stem").applyInArrow(_decode_whole, ROW_SCHEMA)


def _located(path: str) -> tuple:
    """File system and name on it of ``file:/x``, ``/x`` or any other address that Arrow knows; names are taken as they are."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    scheme = re.match(r"^([a-zA-Z][\w+.-]*://[^/]*)(/.*)$", local)
    if scheme is None:
        return fs.LocalFileSystem(), local
    system, base = fs.FileSystem.from_uri(scheme[1] + "/")
    return system, base.rstrip("/") + scheme[2]


def _open(path: str):
    system, name = _located(path)
    return system.open_input_file(name)


def _slice(path: str, start: int, end: int | None = None) -> bytes:
    with _open(path) as f:
        return f.read_at((f.size() if end is None else end) - start, start)


def _table_head(path: str) -> tuple[int, int, int, list]:
    head = _slice(path, 0, 32)
    return table_fields(_slice(path, 0, struct.unpack_from("<H", head, 8)[0]))


def decode_ranges(files: DataFrame, most: int = RANGE) -> DataFrame:
    """Rows of shapefiles given as (shp, shp_size, shx, shx_size, dbf, prj, file_date), read in ranges of about ``most`` bytes.

    A file is Latin-1 as soon as one value of any range is no UTF-8, so the tables are looked through first. A range that can't be read gives one
    error row."""
    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                shapes, rows, width, error = (r["shx_size"] - 100) // 8, 0, 1, None
                try:
                    rows, _, width, _ = _table_head(r["dbf"]) if r["dbf"] else (0, 0, 1, [])
                except Exception as e:
                    error = f"Lecture impossible : {type(e).__name__}"
                n = max(shapes, rows)
                step = max(1, most * n // max(r["shp_size"], rows * width, 1))
                starts = [0] if error else list(range(0, max(n, 1), step))
                yield pa.RecordBatch.from_arrays([pa.array([r["shp"]] * len(starts)), pa.array(starts, pa.int64()), pa.array([min(a + step, n) for a in starts], pa.int64()),
                                                  pa.array([shapes] * len(starts), pa.int64()), pa.array([error] * len(starts), pa.string())],
                                                 ["shp", "first", "end", "shapes", "failed"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                latin = False
                if r["dbf"] and not r["failed"]:
                    n, header, width, fields = _table_head(r["dbf"])
                    a, b = (min(r[c], n) for c in ("first", "end"))
                    latin = any(is_latin(f[0]) for f in fields) or latin_range(_slice(r["dbf"], header + a * width, header + b * width), width, fields)
                yield pa.RecordBatch.from_arrays([pa.array([r["shp"]]), pa.array([latin])], ["shp", "latin"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                try:
                    if r["failed"]:
                        raise ValueError(r["failed"])
                    yield _read_range(r)
                except Exception as e:
                    yield _failed(r["shp"], r["file_date"], e)

    # One row per range from here on; a task takes some of them.
    ranges = files.join(files.select("shp", "shp_size", "shx_size", "dbf").mapInArrow(plan, "shp string, first long, end long, shapes long, failed string"), "shp") \
        .repartition("shp", "first")
    latin = ranges.select("shp", "dbf", "first", "end", "failed").mapInArrow(look, "shp string, latin boolean").groupBy("shp").agg(F.bool_or("latin").alias("latin"))
    return ranges.join(latin, "shp").mapInArrow(read, ROW_SCHEMA)


def _read_range(r: dict) -> pa.RecordBatch:
    first, end, n_shapes = r["first"], r["end"], max(min(r["end"], r["shapes"]) - r["first"], 0)
    shapes, fields, cells = pa.array([], _GEOM), [], []
    if n_shapes:
        index = np.frombuffer(_slice(r["shx"], 100 + 8 * first, 100 + 8 * (first + n_shapes)), ">i4").astype(np.int64).reshape(-1, 2) * 2
        begin = int(index[:, 0].min())
        shapes = decode_shapes(_slice(r["shp"], begin, int((index.sum(1) + 8).max())), index[:, 0] - begin)
    if r["dbf"]:
        n, header, width, fields = _table_head(r["dbf"])
        rows = _slice(r["dbf"], header + min(first, n) * width, header + min(end, n) * width)
        if len(rows) < (min(end, n) - min(first, n)) * width:
            raise ValueError("table cut short")
        cells = decode_cells(rows, width, fields, r["latin"])
    prj = _slice(r["prj"], 0).decode("latin-1") if r["prj"] else None
    return _batch(r["shp"], r["file_date"], first + 1, end - first, shapes, fields, cells, r["latin"], prj)


def to_wgs84(rows: DataFrame) -> DataFrame:
    """UTM coordinates to longitude and latitude, in columns; other rows unchanged."""
    from fieldlens.functions.geo import GEOMETRY, utm_to_lonlat
    g, zone = F.col("geom"), F.col("utm_zone")
    moved = F.struct(g["gtype"].alias("gtype"), F.transform(g["parts"], lambda part: F.transform(
        part, lambda p: utm_to_lonlat(p["x"], p["y"], zone, F.col("utm_south")))).alias("parts")).cast(GEOMETRY)
    return rows.withColumn("geom", F.when(zone.isNotNull(), moved).otherwise(g)).drop("utm_zone", "utm_south")


def _names(extensions: tuple[str, ...]) -> str:
    return "{" + ",".join("*." + "".join(f"[{c}{c.upper()}]" for c in e) for e in extensions) + "}"


def read_shapefiles(spark: SparkSession, folder: str, most: int = RANGE) -> DataFrame:
    """Features of all shapefiles below a folder. Files with an index are read in ranges; those without one, and all where Arrow does not know the
    file system, are read whole."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", _names((*PARTS, "shx"))).load(folder) \
        .withColumn("file_date", F.to_date("modificationTime"))
    try:
        _located(folder)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return to_wgs84(decode_groups(files)).withColumn("_fmt", F.lit("shp"))
    of = lambda e, c: F.max(F.when(F.col("ext") == e, F.col(c)))
    groups = _parts(files, (*PARTS, "shx")).groupBy("dir", "stem").agg(
        of("shp", "path").alias("shp"), of("shp", "length").alias("shp_size"), of("shx", "path").alias("shx"), of("shx", "length").alias("shx_size"),
        of("dbf", "path").alias("dbf"), of("prj", "path").alias("prj"), of("shp", "file_date").alias("file_date")).filter("shp is not null")
    whole = _parts(files).join(groups.filter("shx is null").select("dir", "stem"), ["dir", "stem"], "left_semi")
    rows = decode_ranges(groups.filter("shx is not null").drop("dir", "stem"), most).unionByName(decode_groups(whole.select("path", "content", "file_date")))
    return to_wgs84(rows).withColumn("_fmt", F.lit("shp"))
