"""Ranges of records against a plain record-by-record decoder, for every kind of shape."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from fieldlens.sources import shapefile


def _polyline(kind, parts):
    n = sum(map(len, parts))
    starts = [sum(map(len, parts[:i])) for i in range(len(parts))]
    return struct.pack("<i4d2i", kind, 0, 0, 0, 0, len(parts), n) + struct.pack(f"<{len(parts)}i", *starts) + b"".join(struct.pack("<2d", *p) for q in parts for p in q)


def _shape(rng, i):
    spot = lambda: (rng.uniform(8, 16), rng.uniform(2, 6))
    kind = i % 7
    if kind == 0:
        p = spot()
        return struct.pack("<i2d", 1, *p), ("Point", [[p]])
    if kind == 1:
        p = spot()
        return struct.pack("<i4d", 11, *p, 5.0, 6.0), ("Point", [[p]])
    if kind == 2:
        parts = [[spot() for _ in range(rng.randint(2, 5))] for _ in range(rng.randint(1, 3))]
        return _polyline(3, parts), ("LineString" if len(parts) == 1 else "MultiLineString", parts)
    if kind in (3, 4):
        rings = []
        for k in range(1 if kind == 3 else 3):
            x, y = spot()
            ring = [(x, y), (x, y + 1), (x + 1, y + 1), (x + 1, y), (x, y)]
            rings.append(ring if k < 2 else ring[::-1])  # the third is a hole
        return _polyline(5, rings), ("Polygon" if kind == 3 else "MultiPolygon", rings)
    if kind == 5:
        points = [spot() for _ in range(rng.randint(1, 4))]
        return struct.pack("<i4di", 8, 0, 0, 0, 0, len(points)) + b"".join(struct.pack("<2d", *p) for p in points), ("MultiPoint", [[p] for p in points])
    return struct.pack("<i", 0), ("Point", [])


def _write(folder, stem, n_shapes, n_rows, text="plain", seed=1):
    rng = random.Random(seed)
    shp, shx, want = b"", b"", []
    for i in range(n_shapes):
        body, geometry = _shape(rng, i)
        shx += struct.pack(">2i", (100 + len(shp)) // 2, len(body) // 2)
        shp += struct.pack(">2i", i + 1, len(body) // 2) + body
        want.append(geometry)
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(shp)) // 2) + bytes(72)
    fields = [(b"nom", b"C", 12), (b"nom", b"C", 3), (b"val", b"N", 8), (b"jour", b"D", 8), (b"oui", b"L", 1)]
    rows, cells = b"", []
    for i in range(n_rows):
        value = text if i == n_rows - 1 else f"r{i}"
        encoded = value.encode("latin-1" if text == "Gar\xe9" else "utf-8")
        raw = [encoded.ljust(12), b"***" if i % 3 else b"   ", b"%8.2f" % i, b"2024%02d%02d" % (i % 12 + 1, i % 28 + 1), b"TF?y "[i % 5:i % 5 + 1]]
        rows += b" " + b"".join(raw)
        cells.append({"nom": value, "nom.1": None, "val": f"{i:.2f}", "jour": f"2024-{i % 12 + 1:02d}-{i % 28 + 1:02d}", "oui": ["True", "False", None, "True", None][i % 5]})
    table = b"".join(n.ljust(11, b"\0") + k + bytes(4) + bytes([s]) + bytes(15) for n, k, s in fields)
    dbf = struct.pack("<4BiHH", 3, 24, 1, 1, n_rows, 32 + len(table) + 1, 33) + bytes(20) + table + b"\r" + rows
    for ext, data in (("shp", head + shp), ("shx", head + shx), ("dbf", dbf), ("prj", b'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]]')):
        (folder / f"{stem}.{ext}").write_bytes(data)
    none = dict.fromkeys(cells[0]) if cells else {}
    return [(i + 1, cells[i] if i < n_rows else none, want[i] if i < n_shapes else None) for i in range(max(n_shapes, n_rows))]


def _got(rows):
    geometry = lambda g: g and (g.gtype, [[(p.x, p.y) for p in part] for part in g.parts])
    return sorted(((r["_row_src"], r["attributes"], geometry(r["geom"])) for r in rows), key=lambda r: r[0])


@pytest.mark.parametrize("most", [1, 700, 1 << 20])
def test_any_ranges_give_the_same_rows(spark, tmp_path, most):
    want = {"many": _write(tmp_path, "many", 60, 60, "é €"), "latin [1]": _write(tmp_path, "latin [1]", 21, 21, "Gar\xe9", 2), "short 100%": _write(tmp_path, "short 100%", 9, 14),
            "long": _write(tmp_path, "long", 14, 9), "none": _write(tmp_path, "none", 0, 0)}
    rows = shapefile.read_shapefiles(spark, str(tmp_path), most).collect()
    assert {r["error"] for r in rows} == {None} and not any(r["_crs_assumed"] or r["crs_unknown"] for r in rows)
    for stem, expected in want.items():
        assert _got([r for r in rows if r["_source"] == f"{stem}.shp"]) == expected, stem


def test_whole_contents_and_broken_files(spark, tmp_path):
    want = _write(tmp_path, "a", 30, 30)
    (tmp_path / "a.shx").unlink()
    _write(tmp_path, "cut", 12, 12)
    (tmp_path / "cut.shp").write_bytes((tmp_path / "cut.shp").read_bytes()[:400])
    _write(tmp_path, "bad", 3, 3)
    (tmp_path / "bad.dbf").write_bytes(b"no table")
    rows = shapefile.read_shapefiles(spark, str(tmp_path)).collect()
    assert _got([r for r in rows if r["_source"] == "a.shp"]) == want
    assert {(r["_source"], r["error"].split(" :")[0]) for r in rows if r["error"]} == {("cut.shp", "Lecture impossible"), ("bad.shp", "Lecture impossible")}
    files = spark.read.format("binaryFile").load(str(tmp_path / "a.*")).select("path", "content", F.current_date().alias("file_date"))
    assert _got(shapefile.to_wgs84(shapefile.decode_groups(files)).collect()) == want
