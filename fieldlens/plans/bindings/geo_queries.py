"""Geometry and distance operators on positions derived from customers, suppliers and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.operators import spatial
from fieldlens.operators.repair import explode_parts
from fieldlens.plans import layer_qa_second as second
from fieldlens.plans.bindings.registry import derived, position, query, sql_utm

_CX, _CY = position("c_custkey")
_SX, _SY = position("s_suppkey")
CUSTOMERS = f"SELECT c_custkey AS k, {_CX} AS x, {_CY} AS y FROM customer"
SUPPLIERS = f"SELECT s_suppkey AS k, {_SX} AS x, {_SY} AS y FROM supplier"
# dense positions: clusters a few metres wide, and one position that holds a third of the orders
CLUSTER = """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 11.0 ELSE 10 + (o_custkey % 50) * 0.001 + (o_orderkey % 7) * 0.00001 END AS x,
 CASE WHEN o_orderkey % 3 = 0 THEN 5.0 ELSE 4 + (o_custkey % 40) * 0.001 + (o_orderkey % 5) * 0.00001 END AS y FROM orders"""
# a line of three vertices per order, some only metres long
LINES = """SELECT o_orderkey AS k, 10 + (o_custkey % 100) * 0.01 AS x0, 4 + (o_custkey % 70) * 0.01 AS y0,
 CASE WHEN o_orderkey % 9 = 0 THEN 0.00001 ELSE 0.001 * (1 + o_orderkey % 5) END AS dx FROM orders"""


def points(spark, sf, sql, name):
    return derived(spark, sf, sql, name).withColumn("geom", geo.point(F.col("x"), F.col("y")))


def lines(spark, sf):
    x, y, d = F.col("x0"), F.col("y0"), F.col("dx")
    path = F.array(geo.xy(x, y), geo.xy(x + d, y), geo.xy(x + d, y + d))
    return derived(spark, sf, LINES, "orders").withColumn("geom", geo.line(path))


def metric(spark, sf, sql, name):
    return geo.with_utm(derived(spark, sf, sql, name).filter("x is not null"), "x", "y", 33)


@query("utm_metres", f"SELECT k, round(e, 3) AS e, round(n, 3) AS n FROM {sql_utm('(' + CUSTOMERS + ')', 'x', 'y', 33)} WHERE x IS NOT NULL")
def utm_metres(spark, sf):
    return metric(spark, sf, CUSTOMERS, "customer").select("k", F.round("_e", 3).alias("e"), F.round("_n", 3).alias("n"))


@query("geometry_measures", f"""SELECT k, round((x0 + x0 + dx) / 4 + (x0 + dx) / 2, 7) AS cx, round(y0 / 2 + (y0 + y0 + dx) / 4, 7) AS cy, round(x0 + dx, 6) AS xmax, round(y0, 6) AS ymin,
 'LINESTRING' AS kind, false AS vide FROM ({LINES})""")
def geometry_measures(spark, sf):
    g = F.col("geom")
    c, b = geo.centroid(g), geo.bounds(g)
    return lines(spark, sf).select("k", F.round(c["x"], 7).alias("cx"), F.round(c["y"], 7).alias("cy"), F.round(b["xmax"], 6).alias("xmax"),
                                   F.round(b["ymin"], 6).alias("ymin"), geo.single_type(g).alias("kind"), geo.is_empty(g).alias("vide"))


_LEN = f"""SELECT k, sqrt((e2-e1)*(e2-e1) + (n2-n1)*(n2-n1)) + sqrt((e3-e2)*(e3-e2) + (n3-n2)*(n3-n2)) AS m FROM
 (SELECT a.k, a.e AS e1, a.n AS n1, b.e AS e2, b.n AS n2, c.e AS e3, c.n AS n3
  FROM {sql_utm(f"(SELECT k, x0 AS px, y0 AS py FROM ({LINES}))", 'px', 'py', 33)} a
  JOIN {sql_utm(f"(SELECT k, x0 + dx AS px, y0 AS py FROM ({LINES}))", 'px', 'py', 33)} b USING (k)
  JOIN {sql_utm(f"(SELECT k, x0 + dx AS px, y0 + dx AS py FROM ({LINES}))", 'px', 'py', 33)} c USING (k))"""


@query("line_lengths", f"SELECT k, round(m, 2) AS longueur_m, m < 5 AS courte FROM ({_LEN})")
def line_lengths(spark, sf):
    m = geo.length_m(F.col("geom"), 33)
    return lines(spark, sf).select("k", F.round(m, 2).alias("longueur_m"), (m < 5).alias("courte"))


@query("positions_outside", f"SELECT k, x = 0 AND y = 0 AS zero FROM ({CUSTOMERS}) WHERE x < 8.3 OR x > 16.3 OR y < 1.6 OR y > 13.2")
def positions_outside(spark, sf):
    xmin, ymin, xmax, ymax = second.BOX
    b = geo.bounds(F.col("geom"))
    outside = (b["xmax"] < xmin) | (b["xmin"] > xmax) | (b["ymax"] < ymin) | (b["ymin"] > ymax)
    return points(spark, sf, CUSTOMERS, "customer").filter(outside).select("k", ((b["xmin"] == 0) & (b["ymin"] == 0)).alias("zero"))


_IN = "x BETWEEN 8.3 AND 16.3 AND y BETWEEN 1.6 AND 13.2"
_SWIN = "y BETWEEN 8.3 AND 16.3 AND x BETWEEN 1.6 AND 13.2"


@query("swapped_positions_repaired", f"SELECT k, CASE WHEN NOT ({_IN}) AND {_SWIN} THEN y ELSE x END AS x, CASE WHEN NOT ({_IN}) AND {_SWIN} THEN x ELSE y END AS y FROM ({CUSTOMERS}) WHERE x IS NOT NULL")
def swapped_positions_repaired(spark, sf):
    p = geo.first_point(geo.swap_if_outside(F.col("geom"), second.BOX))
    return points(spark, sf, CUSTOMERS, "customer").filter("x is not null").select("k", p["x"].alias("x"), p["y"].alias("y"))


@query("parts_exploded", f"SELECT k, i AS part, 'Point' AS gtype, x + i AS x FROM ({SUPPLIERS}), (SELECT unnest([0, 1, 2]) AS i) WHERE x IS NOT NULL AND (k % 2 = 1 OR i = 0)")
def parts_exploded(spark, sf):
    x, y = F.col("x"), F.col("y")
    many = F.struct(F.lit("MultiPoint").alias("gtype"), F.array(*[F.array(geo.xy(x + i, y)) for i in range(3)]).alias("parts")).cast(geo.GEOMETRY)
    rows = points(spark, sf, SUPPLIERS, "supplier").filter("x is not null").withColumn("geom", F.when(F.col("k") % 2 == 1, many).otherwise(F.col("geom")))
    out = explode_parts(rows)
    return out.select("k", F.col("_part").alias("part"), F.col("geom.gtype").alias("gtype"), geo.first_point(F.col("geom"))["x"].alias("x"))


@query("lines_merged", "SELECT k, CASE WHEN k % 2 = 0 THEN 'LineString' ELSE 'MultiLineString' END AS gtype, CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END AS parts, CASE WHEN k % 2 = 0 THEN 3 ELSE 4 END AS sommets FROM (" + LINES + ")")
def lines_merged(spark, sf):
    x, y, d = F.col("x0"), F.col("y0"), F.col("dx")
    gap = F.when(F.col("k") % 2 == 0, 0.0).otherwise(1.0)
    parts = F.array(F.array(geo.xy(x, y), geo.xy(x + d, y)), F.array(geo.xy(x + d + gap, y), geo.xy(x + d, y + d)))
    many = F.struct(F.lit("MultiLineString").alias("gtype"), parts.alias("parts")).cast(geo.GEOMETRY)
    g = F.col("g")
    return derived(spark, sf, LINES, "orders").select("k", geo.merge_lines(many).alias("g")).select(
        "k", g["gtype"].alias("gtype"), F.size(g["parts"]).alias("parts"), F.size(F.flatten(g["parts"])).alias("sommets"))


@query("ring_validity", "SELECT k, k % 3 = 0 AS valide FROM (" + LINES + ")")
def ring_validity(spark, sf):
    x, y, d = F.col("x0"), F.col("y0"), F.col("dx")
    a, b, c, e = geo.xy(x, y), geo.xy(x + d, y), geo.xy(x + d, y + d), geo.xy(x, y + d)
    ring = F.when(F.col("k") % 3 == 0, F.array(a, b, c, e, a)).when(F.col("k") % 3 == 1, F.array(a, c, b, e, a)).otherwise(F.array(a, b, c, e))
    g = geo.geometry("Polygon", F.array(ring))
    return derived(spark, sf, LINES, "orders").select("k", g.alias("g")).select("k", geo.is_valid(F.col("g")).alias("valide"))


@query("map_view", f"SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax, (min(x) + max(x)) / 2 AS lon, (min(y) + max(y)) / 2 AS lat, 7 AS zoom FROM ({CUSTOMERS})")
def map_view(spark, sf):
    return geo.map_view(points(spark, sf, CUSTOMERS, "customer"))


_POS = f"(SELECT e, n, count(*) AS w, min(k) AS lo, max(k) AS hi FROM {sql_utm('(' + CLUSTER + ')', 'x', 'y', 33)} GROUP BY e, n)"
_REACH = f"""SELECT a.e, a.n, sum(b.w) - 1 AS c, min(b.lo) AS lo, max(b.hi) AS hi FROM {_POS} a JOIN {_POS} b
 ON b.e BETWEEN a.e - 3 AND a.e + 3 AND (a.e - b.e) * (a.e - b.e) + (a.n - b.n) * (a.n - b.n) <= 9 GROUP BY a.e, a.n"""


@query("neighbours_counted", f"""SELECT p.k, CAST(c AS BIGINT) AS n_near, CASE WHEN p.k = lo THEN hi ELSE lo END AS partner
 FROM {sql_utm('(' + CLUSTER + ')', 'x', 'y', 33)} p JOIN ({_REACH}) r ON p.e = r.e AND p.n = r.n WHERE c > 0""")
def neighbours_counted(spark, sf):
    near = spatial.neighbours(metric(spark, sf, CLUSTER, "orders"), 3.0, ["k"], "k")
    return near.select("k", "n_near", "partner")


@query("no_neighbour", f"""SELECT a.k FROM {sql_utm('(' + CUSTOMERS + ')', 'x', 'y', 33)} a WHERE a.x IS NOT NULL AND NOT EXISTS (
 SELECT 1 FROM {sql_utm('(' + SUPPLIERS + ')', 'x', 'y', 33)} b WHERE b.x IS NOT NULL AND (a.e - b.e) * (a.e - b.e) + (a.n - b.n) * (a.n - b.n) <= 4e8)""")
def no_neighbour(spark, sf):
    return spatial.without_neighbour(metric(spark, sf, CUSTOMERS, "customer"), metric(spark, sf, SUPPLIERS, "supplier"), 20000.0).select("k")


_NEAREST = f"""SELECT a.k, min(sqrt((a.e - b.e) * (a.e - b.e) + (a.n - b.n) * (a.n - b.n))) AS d FROM {sql_utm('(' + CUSTOMERS + ')', 'x', 'y', 33)} a,
 {sql_utm('(' + SUPPLIERS + ')', 'x', 'y', 33)} b WHERE a.x IS NOT NULL AND b.x IS NOT NULL GROUP BY a.k"""


@query("nearest_distances", f"SELECT k, round(d, 2) AS distance_m FROM ({_NEAREST})")
def nearest_distances(spark, sf):
    near = spatial.nearest_distance(metric(spark, sf, CUSTOMERS, "customer"), metric(spark, sf, SUPPLIERS, "supplier"))
    return near.select("k", F.round("distance_m", 2).alias("distance_m"))
