"""Operators between layers, summaries and splits of the second pack, repair of a layer, layer views, free and close list values."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.functions import text as tx
from fieldlens.operators import repair, report
from fieldlens.plans import layer_qa_second as second
from fieldlens.plans.bindings.registry import derived, query, table
from fieldlens.sources.dictionary import Layer, Variable

# Stations stand 0.01 degrees apart. Every third has a facility about 111 m away, every third one about 555 m away, the others a level crossing.
_SPOT = "9 + (c_custkey % 100) * 0.01 AS x, 3 + CAST(floor(c_custkey / 100) AS BIGINT) * 0.01 AS y"
_STATIONS = f"SELECT c_custkey AS _rid, concat('ZONE', CAST(c_nationkey AS STRING)) AS zone, c_name AS id_fichegare, {_SPOT} FROM customer"
_FACILITIES = """SELECT c_custkey AS _rid, concat('ZONE', CAST(c_nationkey AS STRING)) AS zone, concat('I', c_name) AS id_infra,
 CASE WHEN c_custkey % 3 = 2 THEN 'Passage à niveau' ELSE 'Quai' END AS type_infra,
 9 + (c_custkey % 100) * 0.01 + CASE WHEN c_custkey % 3 = 0 THEN 0.001 WHEN c_custkey % 3 = 1 THEN 0.005 ELSE 0.0 END AS x,
 3 + CAST(floor(c_custkey / 100) AS BIGINT) * 0.01 AS y FROM customer"""
_WORKS = """SELECT c_custkey AS _rid, concat('ZONE', CAST(c_nationkey AS STRING)) AS zone, concat('O', c_name) AS id_ouvrage,
 CASE WHEN c_custkey % 4 = 0 THEN '< 2 km' WHEN c_custkey % 4 = 1 THEN '5–10 km' WHEN c_custkey % 4 = 2 THEN 'inconnu' ELSE '2–5 km' END AS distance_gare_proche,
 9 + (c_custkey % 100) * 0.01 + 0.002 AS x, 3 + CAST(floor(c_custkey / 100) AS BIGINT) * 0.01 AS y FROM customer"""
_CLASSES = ("< 2 km", "2–5 km", "5–10 km", "> 10 km")
_LAYERS = {"Ouvrage_franchissement": Layer("Ouvrage_franchissement", "Point", "id_ouvrage", None, (
    Variable("id_ouvrage"), Variable("distance_gare_proche", values=_CLASSES)))}


def _placed(spark, sf, sql):
    return derived(spark, sf, sql, "customer").withColumn("geom", geo.point(F.col("x"), F.col("y")))


def _cross(spark, sf):
    return second.cross_layer_issues({"Gares": _placed(spark, sf, _STATIONS), "Infrastructures_Ferroviaires": _placed(spark, sf, _FACILITIES),
                                      "Ouvrage_franchissement": _placed(spark, sf, _WORKS)}, _LAYERS)


_LONE = "Aucune fiche correspondante dans {} à moins de 300 m (formulaires A et I à remplir sur les mêmes gares)"
_ZONE = "concat('ZONE', CAST(c_nationkey AS VARCHAR))"


@query("cross_layer_issues", f"""SELECT 'Gares' AS layer, c_custkey AS _rid, {_ZONE} AS zone, c_name AS id, 'geometry' AS field, 'XL_GARE' AS rule, 'WARNING' AS severity,
 '{_LONE.format("Infrastructures_Ferroviaires")}' AS message FROM customer WHERE c_custkey % 3 <> 0
 UNION ALL SELECT 'Infrastructures_Ferroviaires', c_custkey, {_ZONE}, concat('I', c_name), 'geometry', 'XL_GARE', 'WARNING', '{_LONE.format("Gares")}' FROM customer WHERE c_custkey % 3 = 1
 UNION ALL SELECT 'Ouvrage_franchissement', c_custkey, {_ZONE}, concat('O', c_name), 'distance_gare_proche', 'XL_DIST', 'WARNING',
  concat('Distance déclarée « ', CASE WHEN c_custkey % 4 = 1 THEN '5–10 km' ELSE '2–5 km' END, ' » vs ≈ ', CASE WHEN c_custkey % 3 = 0 THEN '0.1' ELSE '0.2' END,
  ' km mesurés (à vol d''oiseau) à la gare la plus proche') FROM customer WHERE c_custkey % 4 IN (1, 3)""")
def cross_layer_issues(spark, sf):
    return _cross(spark, sf).select("layer", "_rid", "zone", "id", "field", "rule", "severity", "message")


_ISSUES = """SELECT CASE WHEN o_custkey % 3 = 0 THEN 'A' ELSE 'B' END AS layer, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_custkey END AS _rid,
 CAST(NULL AS STRING) AS zone, concat('R', CAST(o_orderkey % 5 AS STRING)) AS rule,
 CASE WHEN o_orderkey % 7 = 0 THEN 'ERROR' WHEN o_orderkey % 7 IN (1, 2) THEN 'WARNING' ELSE 'INFO' END AS severity FROM orders"""
_ROWS = "SELECT CASE WHEN c_custkey % 3 = 0 THEN 'A' ELSE 'B' END AS layer, c_custkey AS _rid, concat('ZONE', CAST(c_nationkey AS STRING)) AS zone FROM customer"
_FLAGS = f"""SELECT layer, _rid, CASE WHEN bool_or(severity = 'ERROR') THEN 'ERROR' ELSE 'WARNING' END AS qa_status, string_agg(DISTINCT rule, ',' ORDER BY rule) AS qa_flags
 FROM ({_ISSUES}) WHERE _rid IS NOT NULL AND severity <> 'INFO' GROUP BY layer, _rid"""


@query("summary_second", f"""WITH f AS ({_FLAGS}), s AS (SELECT layer, count(*) AS entites, count(DISTINCT zone) AS zones FROM ({_ROWS}) GROUP BY layer),
 e AS (SELECT layer, count(*) FILTER (qa_status = 'ERROR') AS erreurs, count(*) FILTER (qa_status = 'WARNING') AS avertissements_seuls FROM f GROUP BY layer),
 l AS (SELECT layer, count(*) AS anomalies_structure FROM ({_ISSUES}) WHERE _rid IS NULL AND severity <> 'INFO' GROUP BY layer)
 SELECT layer, entites, zones, coalesce(erreurs, 0) AS erreurs, coalesce(avertissements_seuls, 0) AS avertissements_seuls, coalesce(anomalies_structure, 0) AS anomalies_structure,
 round_even(100.0 * (entites - coalesce(erreurs, 0) - coalesce(avertissements_seuls, 0)) / entites, 1) AS entites_ok_pct FROM s LEFT JOIN e USING (layer) LEFT JOIN l USING (layer)""")
def summary_second(spark, sf):
    return second.summarise_second(derived(spark, sf, _ROWS, "customer"), derived(spark, sf, _ISSUES, "orders"))


@query("quarantined_rows", f"""SELECT r._rid, f.qa_status, 'Erreur QA: ' || f.qa_flags AS reject_reason FROM ({_ROWS}) r JOIN ({_FLAGS}) f ON f.layer = 'A' AND r.layer = 'A' AND f._rid = r._rid
 WHERE f.qa_status = 'ERROR' UNION ALL SELECT r._rid, coalesce(f.qa_status, 'OK'), NULL FROM ({_ROWS}) r LEFT JOIN ({_FLAGS}) f ON f.layer = 'A' AND f._rid = r._rid
 WHERE r.layer = 'A' AND coalesce(f.qa_status, 'OK') <> 'ERROR'""")
def quarantined_rows(spark, sf):
    rows = derived(spark, sf, _ROWS, "customer").filter("layer = 'A'")
    good, bad = repair.quarantine(second.apply_status(rows, "A", derived(spark, sf, _ISSUES, "orders")))
    columns = ["_rid", "qa_status", "reject_reason"]
    return bad.select(columns).unionByName(good.withColumn("reject_reason", F.lit(None).cast("string")).select(columns))


_STRUCT = """SELECT CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS layer, concat('ZONE', CAST(c_nationkey AS STRING)) AS zone, 'fichier' AS field,
 'STRUCT' AS rule, 'WARNING' AS severity, c_name AS message FROM customer"""


@query("structural_issues", f"SELECT layer, CAST(NULL AS BIGINT) AS _rid, zone, field, rule, severity, message FROM ({_STRUCT}) WHERE layer = 'A'")
def structural_issues(spark, sf):
    return second.structural_issues(derived(spark, sf, _STRUCT, "customer"), "A").select("layer", "_rid", "zone", "field", "rule", "severity", "message")


_SIDES = "SELECT c_custkey AS k, c_name AS nom, 9 + c_nationkey * 0.1 AS x, 3 + (c_custkey % 50) * 0.05 AS y FROM customer"


@query("repaired_coordinates", f"SELECT k, round_even(x, 7) AS lon, round_even(y, 7) AS lat FROM ({_SIDES})")
def repaired_coordinates(spark, sf):
    rows = derived(spark, sf, _SIDES, "customer").withColumn("geom", geo.point(F.col("x").cast("double"), F.col("y").cast("double")))
    return repair.add_coordinates(rows, Layer("P", "Point", "k", None), 32).select("k", "lon", "lat")


@query("layer_view", """SELECT CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS statut_qa, c_name AS nom, 'f' || c_nationkey AS _path, c_custkey AS _row_src FROM customer""")
def layer_view(spark, sf):
    rows = table(spark, sf, "customer")
    path = F.concat(F.lit("f"), F.col("c_nationkey").cast("string"))
    raw = rows.select(F.col("c_name").alias("nom"), path.alias("_path"), F.col("c_custkey").alias("_row_src"), F.lit("kml").alias("_fmt"))
    status = rows.filter("c_custkey % 5 <> 0").select(path.alias("_path"), F.col("c_custkey").alias("ligne_source"), F.col("c_mktsegment").alias("statut"))
    return report.layer_view(raw, status)


@query("unquoted_cells", """SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_name END AS cell, c_custkey % 3 = 2 AS vide FROM customer""")
def unquoted_cells(spark, sf):
    cell = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(' "'), "c_name", F.lit('" '))).when(F.col("c_custkey") % 3 == 1, F.col("c_name"))
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), tx.unquote(cell).alias("cell"), cell.isNull().alias("vide"))
