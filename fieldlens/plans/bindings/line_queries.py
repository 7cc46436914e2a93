"""Second pack and repair on lines, polygons and multiple choices derived from customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.operators import repair
from fieldlens.plans import layer_qa_second as second
from fieldlens.plans.bindings.registry import dealt_out, derived, query
from fieldlens.sources.dictionary import Layer, Variable

SERVICES = ("Eau potable", "Électricité", "Latrines", "Aucun service")
# A line layer under the name of one that has rules, whose other columns are missing.
ROADS = Layer("Reseau_Routier_Pistes", "LineString", "id_troncon", None, (
    Variable("id_troncon", "Identifiant", level="E"), Variable("type_surface", "Revêtement", level="W", values=("Terre", "Sable", "Bitume")),
    Variable("categorie_voie", "Catégorie"), Variable("services", "Services", type="multiselect", values=SERVICES)))
LINES = """SELECT c_custkey AS _rid, c_custkey % 8 AS g, concat('ZONE', CAST(1 + c_nationkey % 5 AS STRING)) AS zone, concat('ZONE', CAST(1 + c_nationkey % 5 AS STRING), 'RE', CAST(c_custkey + 1 AS STRING)) AS id_troncon,
 CASE WHEN c_custkey % 3 = 0 THEN 'Terre' WHEN c_custkey % 3 = 1 THEN 'bitume' END AS type_surface, CASE WHEN c_custkey % 2 = 0 THEN 'Route Régionale' ELSE 'Piste' END AS categorie_voie,
 CASE WHEN c_custkey % 6 = 0 THEN 'Eau potable; Latrines' WHEN c_custkey % 6 = 1 THEN 'Aucun service' WHEN c_custkey % 6 = 2 THEN 'Latrines | Aucun service' WHEN c_custkey % 6 = 3 THEN 'Aucun service, Gaz' END AS services,
 10.0 + (c_custkey % 4000) * 0.001 AS x, 3.0 + (c_custkey % 3001) * 0.002 AS y FROM customer"""


def shaped(df):
    """Geometry by kind ``g``: 0 point, 1 two parts, 2 short, 3 outside, 4 one place only, 5 none, 6 two touching parts, 7 a plain line."""
    at = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    g, line = F.col("g"), lambda *points: F.array(*points)
    parts = F.when(g == 0, F.array(line(at(0, 0)))).when(g == 1, F.array(line(at(0, 0), at(0.01, 0)), line(at(0.05, 0), at(0.05, 0.01)))) \
        .when(g == 2, F.array(line(at(0, 0), at(0.00001, 0)))).when(g == 3, F.array(line(at(20, 0), at(20.01, 0)))) \
        .when(g == 4, F.array(line(at(0, 0), at(0, 0)))).when(g == 5, F.array().cast("array<array<struct<x:double,y:double>>>")) \
        .when(g == 6, F.array(line(at(0, 0), at(0.01, 0)), line(at(0.01, 0), at(0.01, 0.01)))).otherwise(F.array(line(at(0, 0), at(0.01, 0))))
    kind = F.when(g == 0, "Point").when(g.isin(1, 6), "MultiLineString").otherwise("LineString")
    return df.withColumn("geom", F.struct(kind.alias("gtype"), parts.alias("parts")).cast(geo.GEOMETRY)).drop("g", "x", "y")


_ISSUES = f"""SELECT _rid, 'geometry' AS field, 'GEOM_NULL' AS rule, 'ERROR' AS severity FROM ({LINES}) WHERE g = 5
 UNION ALL SELECT _rid, 'geometry', 'GEOM_TYPE', 'ERROR' FROM ({LINES}) WHERE g IN (0, 1, 6) UNION ALL SELECT _rid, 'geometry', 'GEOM_INVALID', 'ERROR' FROM ({LINES}) WHERE g = 4
 UNION ALL SELECT _rid, 'geometry', 'GEOM_BBOX', 'ERROR' FROM ({LINES}) WHERE g = 3 UNION ALL SELECT _rid, 'geometry', 'LINE_SHORT', 'WARNING' FROM ({LINES}) WHERE g IN (0, 2, 4)
 UNION ALL SELECT _rid, 'type_surface', 'REQ_MISSING', 'WARNING' FROM ({LINES}) WHERE type_surface IS NULL UNION ALL SELECT _rid, 'type_surface', 'DOM_CASE', 'WARNING' FROM ({LINES}) WHERE type_surface = 'bitume'
 UNION ALL SELECT _rid, 'services', 'MULTI_EXCL', 'WARNING' FROM ({LINES}) WHERE _rid % 6 IN (2, 3) UNION ALL SELECT _rid, 'services', 'DOM_INVALID', 'ERROR' FROM ({LINES}) WHERE _rid % 6 = 3
 UNION ALL SELECT _rid, '', 'L_SURF', 'WARNING' FROM ({LINES}) WHERE type_surface = 'Terre' AND categorie_voie = 'Route Régionale'
 UNION ALL SELECT NULL, '', r, 'INFO' FROM (VALUES ('L_CRIT1'), ('L_CRIT2'), ('L_PRAT')) v(r)"""


@query("second_pack_lines", _ISSUES)
def second_pack_lines(spark, sf):
    """All issues of a line layer but gaps; rules whose columns are missing are told once each."""
    out = second.check_layer_second(shaped(dealt_out(derived(spark, sf, LINES, "customer"))), ROADS)
    return out.filter("rule <> 'ID_GAP'").select("_rid", "field", "rule", "severity")


_FOUND = """SELECT concat('L', CAST(l_linenumber % 2 AS STRING)) AS layer, l_orderkey AS _rid, concat('R', CAST(l_partkey % 7 AS STRING)) AS rule, l_suppkey % 3 AS _seq,
 CASE WHEN l_partkey % 9 = 0 THEN 'ERROR' WHEN l_partkey % 9 < 5 THEN 'WARNING' ELSE 'INFO' END AS severity FROM lineitem"""


@query("issue_order_second", f"""SELECT row_number() OVER (ORDER BY layer, CASE severity WHEN 'ERROR' THEN 0 WHEN 'WARNING' THEN 1 ELSE 2 END, rule) AS place, layer, rule, severity FROM (SELECT DISTINCT layer, rule, severity FROM ({_FOUND}))""")
def issue_order_second(spark, sf):
    """The order of the issue table: the first place of each layer, severity and rule in it. Rows are numbered as they come out."""
    listed = second.ordered_issues_second(derived(spark, sf, _FOUND, "lineitem"))
    placed = listed.select("layer", "rule", "severity", F.monotonically_increasing_id().alias("at")).groupBy("layer", "rule", "severity").agg(F.min("at").alias("at"))
    first = placed.agg(F.array_sort(F.collect_list(F.struct("at", "layer", "rule", "severity"))).alias("all"))  # one entry per rule and layer
    return first.select(F.posexplode("all").alias("i", "r")).select((F.col("i") + 1).cast("long").alias("place"), "r.layer", "r.rule", "r.severity")


_PARTS = f"""SELECT _rid, unnest(range(CASE WHEN g = 1 THEN 2 ELSE 1 END)) AS part, g, zone, id_troncon, type_surface, services, x, y FROM ({LINES}) WHERE g <> 5"""


@query("repaired_lines", f"""SELECT row_number() OVER (ORDER BY _rid, part) - 1 AS _rid, id_troncon AS id_orig, CASE WHEN part = 1 THEN NULL ELSE id_troncon END AS kept_id, CASE WHEN g = 0 THEN 'Point' ELSE 'LineString' END AS gtype,
 CASE WHEN type_surface = 'bitume' THEN 'Bitume' ELSE type_surface END AS type_surface, CASE _rid % 6 WHEN 0 THEN 'Eau potable; Latrines' WHEN 1 THEN 'Aucun service' WHEN 2 THEN 'Latrines; Aucun service' WHEN 3 THEN 'Aucun service; Gaz' END AS services,
 CASE WHEN g = 6 THEN 3 WHEN g = 0 THEN 1 ELSE 2 END AS points FROM ({_PARTS})""")
def repaired_lines(spark, sf):
    """Lines merged, split and renumbered; the second part of a row gets a new identifier."""
    done = repair.repair_layers({ROADS.name: shaped(dealt_out(derived(spark, sf, LINES, "customer")))}, {ROADS.name: ROADS})[ROADS.name].rows
    return done.select("_rid", "id_orig", F.when(F.col("id_troncon") == F.col("id_orig"), F.col("id_troncon")).alias("kept_id"), F.col("geom.gtype").alias("gtype"),
                       "type_surface", "services", F.size(F.flatten("geom.parts")).alias("points"))


@query("repair_counts", f"""SELECT 'Reseau_Routier_Pistes' AS couche, mesure, nombre FROM (SELECT 'recues' AS mesure, count(*) AS nombre FROM ({LINES}) UNION ALL SELECT 'sans_geometrie', count(*) FROM ({LINES}) WHERE g = 5
 UNION ALL SELECT 'valeurs_normalisees', count(*) FILTER (type_surface = 'bitume') + count(*) FILTER (_rid % 6 IN (2, 3)) FROM ({_PARTS}) UNION ALL SELECT 'identifiants_changes', count(*) FROM ({_PARTS}) WHERE part = 1
 UNION ALL SELECT 'renumerotations', count(*) FROM ({_PARTS}) WHERE part = 1 UNION ALL SELECT 'doublons_stricts', 0 UNION ALL SELECT 'conservees', count(*) FROM ({_PARTS}))""")
def repair_counts(spark, sf):
    return repair.repair_layers({ROADS.name: shaped(dealt_out(derived(spark, sf, LINES, "customer")))}, {ROADS.name: ROADS})[ROADS.name].counts


# A triangle, a square with a bow tie, or an L of three squares, at a place given by the customer.
_PLACE = "SELECT c_custkey AS k, c_custkey % 4 AS g, 9.0 + (c_custkey % 600) * 0.01 AS x, 2.0 + (c_custkey % 900) * 0.01 AS y FROM customer"


@query("polygon_measures", f"""SELECT k, 'Polygon' AS gtype, g <> 1 AS valide, round(x + CASE g WHEN 0 THEN 1 WHEN 2 THEN 0.833333333333333 WHEN 3 THEN 1 END, 6)::DOUBLE AS cx,
 round(y + CASE g WHEN 0 THEN 1 WHEN 2 THEN 0.833333333333333 WHEN 3 THEN 1 END, 6)::DOUBLE AS cy FROM ({_PLACE})""")
def polygon_measures(spark, sf):
    rows = derived(spark, sf, _PLACE, "customer")
    at = lambda *ps: F.array(*[F.struct((F.col("x") + a).alias("x"), (F.col("y") + b).alias("y")) for a, b in ps])
    ring = F.when(F.col("g") == 0, at((0, 0), (3, 0), (0, 3), (0, 0))).when(F.col("g") == 1, at((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))) \
        .when(F.col("g") == 2, at((0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0))).otherwise(at((0, 0), (2, 0), (2, 2), (0, 2), (0, 0)))
    df = rows.withColumn("geom", F.struct(F.lit("Polygon").alias("gtype"), F.array(ring).alias("parts")).cast(geo.GEOMETRY))
    c = F.when(F.col("g") != 1, geo.centroid(F.col("geom")))
    return df.select("k", F.col("geom.gtype").alias("gtype"), geo.is_valid(F.col("geom")).alias("valide"), F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"))
