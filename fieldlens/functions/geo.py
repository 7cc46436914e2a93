"""Geometry as a struct column and the measures the checks need.

A geometry is ``struct<gtype: string, parts: array<array<struct<x: double, y: double>>>>``: one part per
point or line, one part per ring for polygons. A missing geometry is null, an unreadable one has no parts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOMETRY = "struct<gtype:string,parts:array<array<struct<x:double,y:double>>>>"

# WGS84 axis and flattening, UTM scale and false easting.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_E0 = 500000.0


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def geometry(gtype: str, parts: Column) -> Column:
    return F.struct(F.lit(gtype).alias("gtype"), parts.alias("parts")).cast(GEOMETRY)


def point(x: Column, y: Column) -> Column:
    """Point geometry; empty when a coordinate is missing."""
    parts = F.when(x.isNotNull() & y.isNotNull(), F.array(F.array(xy(x, y)))).otherwise(F.array())
    return geometry("Point", parts)


def line(vertices: Column) -> Column:
    return geometry("LineString", F.array(vertices))


def is_empty(g: Column) -> Column:
    return g.isNull() | (F.size(F.flatten(g["parts"])) == 0)


def single_type(g: Column) -> Column:
    """Upper-case type with MULTI removed."""
    return F.replace(F.upper(g["gtype"]), F.lit("MULTI"), F.lit(""))


def first_point(g: Column) -> Column:
    return F.get(F.get(g["parts"], F.lit(0)), F.lit(0))


def _segments(part: Column) -> Column:
    """Consecutive vertex pairs of one part."""
    rest = F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0)))
    head = F.slice(part, 1, F.greatest(F.size(part) - 1, F.lit(0)))
    return F.arrays_zip(head.alias("a"), rest.alias("b"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _planar_length(s: Column) -> Column:
    return F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"])


def _cross(s: Column) -> Column:
    return s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]


def centroid(g: Column) -> Column:
    """Centroid in the units of the coordinates: mean of points, length- or area-weighted otherwise."""
    vertices = F.flatten(g["parts"])
    segments = F.flatten(F.transform(g["parts"], _segments))
    n = F.size(vertices)
    mean = F.struct((_sum(F.transform(vertices, lambda p: p["x"])) / n).alias("x"),
                    (_sum(F.transform(vertices, lambda p: p["y"])) / n).alias("y"))
    length = _sum(F.transform(segments, _planar_length))
    along = F.struct(
        (_sum(F.transform(segments, lambda s: _planar_length(s) * (s["a"]["x"] + s["b"]["x"]) / 2)) / length).alias("x"),
        (_sum(F.transform(segments, lambda s: _planar_length(s) * (s["a"]["y"] + s["b"]["y"]) / 2)) / length).alias("y"))
    area2 = _sum(F.transform(segments, _cross))
    surface = F.struct(
        (_sum(F.transform(segments, lambda s: _cross(s) * (s["a"]["x"] + s["b"]["x"]))) / (3 * area2)).alias("x"),
        (_sum(F.transform(segments, lambda s: _cross(s) * (s["a"]["y"] + s["b"]["y"]))) / (3 * area2)).alias("y"))
    kind = single_type(g)
    return F.when(is_empty(g), None).when(g["gtype"] == "Point", first_point(g)) \
        .when((kind == "POLYGON") & (area2 != 0), surface) \
        .when((kind != "POINT") & (length > 0), along).otherwise(mean)


def bounds(g: Column) -> Column:
    p = F.flatten(g["parts"])
    xs, ys = F.transform(p, lambda v: v["x"]), F.transform(p, lambda v: v["y"])
    box = F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                   F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))
    return F.when(~is_empty(g), box)


def _orient(a: Column, b: Column, c: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))


def _crossing(s: Column, t: Column) -> Column:
    """Two segments meet in a point that is not just their shared ring vertex."""
    apart = (F.greatest(s["a"]["x"], s["b"]["x"]) < F.least(t["a"]["x"], t["b"]["x"])) \
        | (F.greatest(t["a"]["x"], t["b"]["x"]) < F.least(s["a"]["x"], s["b"]["x"])) \
        | (F.greatest(s["a"]["y"], s["b"]["y"]) < F.least(t["a"]["y"], t["b"]["y"])) \
        | (F.greatest(t["a"]["y"], t["b"]["y"]) < F.least(s["a"]["y"], s["b"]["y"]))
    return ~apart & (_orient(s["a"], s["b"], t["a"]) * _orient(s["a"], s["b"], t["b"]) <= 0) \
        & (_orient(t["a"], t["b"], s["a"]) * _orient(t["a"], t["b"], s["b"]) <= 0)


def _ring_valid(ring: Column) -> Column:
    closed = (F.size(ring) >= 4) & (F.get(ring, F.lit(0)) == F.element_at(ring, -1))
    seg = F.filter(_segments(ring), lambda s: s["a"] != s["b"])
    n = F.size(seg)
    clash = F.exists(F.transform(seg, lambda s, i: F.exists(
        F.slice(seg, i + 3, F.greatest(n - i - 2, F.lit(0))),
        lambda t: _crossing(s, t) & ~((i == 0) & (t["b"] == s["a"])))), lambda hit: hit)
    return F.coalesce(closed & (n >= 3) & ~clash, F.lit(False))


def is_valid(g: Column) -> Column:
    """Lines need two distinct points, rings must be closed and must not cross themselves."""
    line_ok = F.forall(g["parts"], lambda p: F.size(F.array_distinct(p)) >= 2)
    ring_ok = F.forall(g["parts"], _ring_valid)
    kind = single_type(g)
    return F.when(is_empty(g) | (kind == "POINT"), F.lit(True)) \
        .when(kind == "POLYGON", ring_ok).when(kind == "LINESTRING", line_ok).otherwise(F.lit(True))


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def _series():
    """Krüger series to the fourth order in the third flattening."""
    n = WGS84_F / (2 - WGS84_F)
    radius = WGS84_A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    alpha = (n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180,
             13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440,
             61 * n ** 3 / 240 - 103 * n ** 4 / 140,
             49561 * n ** 4 / 161280)
    return 2 * math.sqrt(n) / (1 + n), radius, alpha


def _conformal(lon: Column, lat: Column, zone) -> tuple[Column, Column]:
    q, _, _ = _series()
    phi = F.radians(lat)
    lam = F.radians(lon - (F.lit(6 * zone - 183) if isinstance(zone, int) else 6 * zone - 183))
    t = F.sinh(F.atanh(F.sin(phi)) - q * F.atanh(q * F.sin(phi)))
    return F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))


def _metric(xi: Column, eta: Column) -> tuple[Column, Column]:
    _, radius, alpha = _series()
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return UTM_E0 + UTM_K0 * radius * east, UTM_K0 * radius * north


def with_utm(df: DataFrame, lon: str, lat: str, zone, east: str = "_e", north: str = "_n") -> DataFrame:
    """Add UTM metres of a lon/lat pair; the intermediate terms are columns so each is computed once."""
    xi, eta = _conformal(F.col(lon), F.col(lat), zone)
    df = df.withColumns({"_xi": xi, "_eta": eta})
    e, n = _metric(F.col("_xi"), F.col("_eta"))
    return df.withColumns({east: e, north: n}).drop("_xi", "_eta")


def length_m(g: Column, zone) -> Column:
    """Length of a line geometry in UTM metres."""
    def measured(part):
        conformal = F.transform(part, lambda p: F.struct(*(
            c.alias(k) for c, k in zip(_conformal(p["x"], p["y"], zone), ("xi", "eta")))))
        metric = F.transform(conformal, lambda p: F.struct(*(
            c.alias(k) for c, k in zip(_metric(p["xi"], p["eta"]), ("x", "y")))))
        return _sum(F.transform(_segments(metric), _planar_length))
    return F.when(~is_empty(g), _sum(F.transform(g["parts"], measured)))


def common_zone(df: DataFrame, lon: str = "_cx", lat: str = "_cy") -> int:
    """UTM zone of the middle of the data's extent (one aggregate row comes back)."""
    row = df.agg(((F.min(lon) + F.max(lon)) / 2).alias("mid")).first()
    return 31 if row["mid"] is None else int(math.floor((row["mid"] + 180) / 6)) + 1


def map_view(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Total bounds, centre and zoom for a first look at a layer."""
    b = df.select(bounds(F.col(geom)).alias("b")).filter("b is not null")
    box = b.agg(F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"),
                F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax"))
    return box.select("*", ((F.col("xmin") + F.col("xmax")) / 2).alias("lon"),
                      ((F.col("ymin") + F.col("ymax")) / 2).alias("lat"),
                      F.when(F.col("xmax") - F.col("xmin") > 0.5, 7).otherwise(11).alias("zoom"))


def swap_if_outside(g: Column, box: tuple[float, float, float, float]) -> Column:
    """Exchange lon and lat of a point that lies outside the box and would lie inside after the exchange."""
    xmin, ymin, xmax, ymax = box
    p = first_point(g)

    def inside(x, y):
        return x.between(xmin, xmax) & y.between(ymin, ymax)

    swapped = geometry("Point", F.array(F.array(xy(p["y"], p["x"]))))
    return F.when((g["gtype"] == "Point") & ~is_empty(g) & ~inside(p["x"], p["y"]) & inside(p["y"], p["x"]),
                  swapped).otherwise(g)


def merge_lines(g: Column) -> Column:
    """Join consecutive parts of a multi-line where one ends on the start of the next, in stored order."""
    start = F.array().cast("array<array<struct<x:double,y:double>>>")

    def add(done, part):
        last = F.element_at(done, -1)
        joined = F.array_append(F.slice(done, 1, F.size(done) - 1),
                                F.concat(last, F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0)))))
        return F.when(F.size(done) == 0, F.array(part)) \
            .when(F.element_at(last, -1) == F.get(part, F.lit(0)), joined) \
            .otherwise(F.array_append(done, part))

    parts = F.aggregate(g["parts"], start, add)
    merged = F.struct(F.when(F.size(parts) > 1, "MultiLineString").otherwise("LineString").alias("gtype"),
                      parts.alias("parts")).cast(GEOMETRY)
    return F.when(g["gtype"] == "MultiLineString", merged).otherwise(g)


def unwrap_single(g: Column) -> Column:
    """A multi-point of one point becomes that point."""
    return F.when((g["gtype"] == "MultiPoint") & (F.size(g["parts"]) == 1),
                  F.struct(F.lit("Point").alias("gtype"), g["parts"].alias("parts")).cast(GEOMETRY)).otherwise(g)


def keep_parts_of(expected: str, members: Column) -> Column:
    """Reduce a collection (array of geometries) to its parts of the expected type."""
    kept = F.filter(members, lambda m: m["gtype"] == expected)
    kind = F.when(F.size(kept) == 1, F.lit(expected)).otherwise(F.lit("Multi" + expected))
    return F.when(F.size(kept) > 0, F.struct(
        kind.alias("gtype"), F.flatten(F.transform(kept, lambda m: m["parts"])).alias("parts")).cast(GEOMETRY))


def _pair_text(p: Column) -> Column:
    return F.format_string("%.7f,%.7f,0", p["x"], p["y"])


def _path_text(part: Column) -> Column:
    return F.array_join(F.transform(part, _pair_text), " ")


def kml_geometry(g: Column) -> Column:
    """KML element of a geometry; several parts are wrapped in a MultiGeometry."""
    kind = single_type(g)

    def ring(part, tag):
        return F.concat(F.lit(f"<{tag}><LinearRing><coordinates>"), _path_text(part),
                        F.lit(f"</coordinates></LinearRing></{tag}>"))

    def one(part):
        spot = F.concat(F.lit("<Point><coordinates>"), _pair_text(F.get(part, F.lit(0))), F.lit("</coordinates></Point>"))
        path = F.concat(F.lit("<LineString><tessellate>1</tessellate><coordinates>"), _path_text(part),
                        F.lit("</coordinates></LineString>"))
        return F.when(kind == "POINT", spot).otherwise(path)

    holes = F.array_join(F.transform(F.slice(g["parts"], 2, F.greatest(F.size(g["parts"]) - 1, F.lit(0))),
                                     lambda p: ring(p, "innerBoundaryIs")), "")
    polygon = F.concat(F.lit("<Polygon>"), ring(F.get(g["parts"], F.lit(0)), "outerBoundaryIs"), holes,
                       F.lit("</Polygon>"))
    body = F.array_join(F.transform(g["parts"], one), "")
    many = F.concat(F.lit("<MultiGeometry>"), body, F.lit("</MultiGeometry>"))
    return F.when(kind == "POLYGON", polygon).when(F.size(g["parts"]) > 1, many).otherwise(body)


def wkt(g: Column) -> Column:
    """Well-known text; null for an empty geometry."""
    def pairs(part):
        return F.array_join(F.transform(part, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", ")

    inner = F.transform(g["parts"], lambda p: F.concat(F.lit("("), pairs(p), F.lit(")")))
    simple = g["gtype"].isin("Point", "LineString")
    body = F.when(simple, F.get(inner, F.lit(0))) \
        .when(g["gtype"] == "MultiPolygon", F.concat(
            F.lit("("), F.array_join(F.transform(inner, lambda r: F.concat(F.lit("("), r, F.lit(")"))), ", "), F.lit(")"))) \
        .otherwise(F.concat(F.lit("("), F.array_join(inner, ", "), F.lit(")")))
    return F.when(~is_empty(g), F.concat(F.upper(g["gtype"]), F.lit(" "), body))


def display_path(g: Column) -> Column:
    """First part of a geometry as ``[[lon, lat], …]`` for a map."""
    return F.transform(F.get(g["parts"], F.lit(0)), lambda p: F.array(p["x"], p["y"]))


def parse_coordinates(text: Column) -> Column:
    """KML coordinate text to vertices; blanks around commas are tolerated, altitude is dropped.

    Null when any token is not a coordinate pair, as one bad token makes the geometry unreadable.
    """
    tokens = F.filter(F.split(F.regexp_replace(F.trim(text), r"\s*,\s*", ","), r"\s+"), lambda t: t != "")
    pairs = F.transform(tokens, lambda t: F.struct(
        F.get(F.split(t, ","), F.lit(0)).try_cast("double").alias("x"),
        F.get(F.split(t, ","), F.lit(1)).try_cast("double").alias("y")))
    good = F.forall(pairs, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    return F.when(good & (F.size(pairs) > 0), pairs)


def utm_to_lonlat(east: Column, north: Column, zone: Column, south: Column) -> Column:
    """Inverse of the UTM projection (Krüger series) as ``struct<x: lon, y: lat>``."""
    q, radius, _ = _series()
    n = WGS84_F / (2 - WGS84_F)
    beta = (n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96 - n ** 4 / 360,
            n ** 2 / 48 + n ** 3 / 15 - 437 * n ** 4 / 1440,
            17 * n ** 3 / 480 - 37 * n ** 4 / 840,
            4397 * n ** 4 / 161280)
    delta = (2 * n - 2 * n ** 2 / 3 - 2 * n ** 3 + 116 * n ** 4 / 45,
             7 * n ** 2 / 3 - 8 * n ** 3 / 5 - 227 * n ** 4 / 45,
             56 * n ** 3 / 15 - 136 * n ** 4 / 35,
             4279 * n ** 4 / 630)
    xi = (north - F.when(south, 10000000.0).otherwise(0.0)) / (UTM_K0 * radius)
    eta = (east - UTM_E0) / (UTM_K0 * radius)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))) + 6 * zone - 183
    return F.struct(lon.alias("x"), F.degrees(lat).alias("y"))
