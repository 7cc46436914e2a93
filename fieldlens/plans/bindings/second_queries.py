"""Second pack: identifiers, gaps, status roll-up, completeness, strict copies and repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.operators import duplicates, repair
from fieldlens.plans import layer_qa_second as second
from fieldlens.plans.bindings.registry import derived, query, table
from fieldlens.sources.dictionary import Layer, Variable

# orders as a layer: id, answers and positions of the second pack
ORDERS = Layer("Orders", "Point", "id_order", None, (
    Variable("id_order", "Identifiant", level="E"),
    Variable("priorite", "Priorité", level="W", values=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "Autre (préciser)")),
    Variable("largeur_m", "Largeur", type="double"),
    Variable("densite_couvert", "Densité", type="integer"),
    Variable("quai", "Quai", type="boolean"),
))
ROWS = """SELECT o_orderkey AS _rid, concat('ZONE', CAST(1 + o_custkey % 8 AS STRING)) AS zone,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN concat('zone', CAST(o_orderkey AS STRING)) WHEN o_orderkey % 19 = 0 THEN 'ZONE1OR7'
  WHEN o_orderkey % 23 = 0 THEN concat('ZONE1XX', CAST(o_orderkey + 1 AS STRING)) ELSE concat('ZONE', CAST(1 + o_custkey % 8 AS STRING), 'OR', CAST(o_orderkey + 1 AS STRING)) END AS id_order,
 CASE WHEN o_orderkey % 4 = 0 THEN lower(o_orderpriority) WHEN o_orderkey % 11 = 1 THEN '' WHEN o_orderkey % 29 = 2 THEN 'autre chose' ELSE o_orderpriority END AS priorite,
 CASE WHEN o_orderkey % 7 = 0 THEN '0,25' WHEN o_orderkey % 7 = 1 THEN 'large' ELSE '12.5' END AS largeur_m,
 CASE WHEN o_orderkey % 5 = 0 THEN '101' WHEN o_orderkey % 5 = 1 THEN '7.5' WHEN o_orderkey % 5 = 2 THEN 'nan' ELSE '40' END AS densite_couvert,
 CASE WHEN o_orderkey % 6 = 0 THEN 'X' WHEN o_orderkey % 6 = 1 THEN 'peut-être' ELSE 'non' END AS quai,
 CASE WHEN o_orderkey % 31 = 0 THEN 0.0 ELSE 9 + (o_orderkey % 5000) * 0.001 END AS x, CASE WHEN o_orderkey % 31 = 0 THEN 0.0 ELSE 3 + (o_orderkey % 3001) * 0.002 END AS y FROM orders"""
_OK = "regexp_matches(id_order, '^ZONE[1-9][0-9]*[A-Z]{2}[1-9][0-9]*$')"


def rows(spark, sf):
    return derived(spark, sf, ROWS, "orders").withColumn("geom", geo.point(F.col("x"), F.col("y")))


def prepared(spark, sf):
    return second.prepare(rows(spark, sf), ORDERS)


@query("id_checks_second", f"""WITH r AS (SELECT *, count(*) OVER (PARTITION BY id_order) AS c FROM ({ROWS}))
 SELECT _rid, 'ID_MISSING' AS rule FROM r WHERE id_order IS NULL UNION ALL SELECT _rid, 'ID_FORMAT' FROM r WHERE NOT {_OK}
 UNION ALL SELECT _rid, 'ID_PREFIX' FROM r WHERE {_OK} AND NOT contains(id_order, 'OR') UNION ALL SELECT _rid, 'ID_ZONE' FROM r WHERE {_OK} AND regexp_extract(id_order, '^ZONE[0-9]+', 0) <> zone
 UNION ALL SELECT _rid, 'ID_DUP' FROM r WHERE {_OK} AND c > 1""")
def id_checks_second(spark, sf):
    marked = duplicates.repeated(prepared(spark, sf), "_id", "_id_repeated")
    return second.spread(marked, ["_rid"], F.concat(*second.id_issues(ORDERS)), "seq").select("_rid", "rule")


@query("value_checks_second", f"""SELECT _rid, field, rule, severity FROM (
 SELECT _rid, 'priorite' AS field, 'REQ_MISSING' AS rule, 'WARNING' AS severity FROM ({ROWS}) WHERE priorite = ''
 UNION ALL SELECT _rid, 'priorite', 'DOM_CASE', 'WARNING' FROM ({ROWS}) WHERE upper(priorite) IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') AND priorite <> upper(priorite)
 UNION ALL SELECT _rid, 'largeur_m', 'TYPE_INVALID', 'ERROR' FROM ({ROWS}) WHERE largeur_m = 'large' UNION ALL SELECT _rid, 'largeur_m', 'RANGE', 'WARNING' FROM ({ROWS}) WHERE largeur_m = '0,25'
 UNION ALL SELECT _rid, 'densite_couvert', 'RANGE', 'ERROR' FROM ({ROWS}) WHERE densite_couvert = '101' UNION ALL SELECT _rid, 'densite_couvert', 'TYPE_DECIMAL', 'WARNING' FROM ({ROWS}) WHERE densite_couvert = '7.5'
 UNION ALL SELECT _rid, 'quai', 'TYPE_INVALID', 'ERROR' FROM ({ROWS}) WHERE quai = 'peut-être')""")
def value_checks_second(spark, sf):
    typed = second.typed_view(prepared(spark, sf), ORDERS)
    return second.spread(typed, ["_rid"], F.concat(*second.value_issues(ORDERS)), "seq").select("_rid", "field", "rule", "severity")


@query("unknown_list_values", f"SELECT _rid, 'DOM_INVALID' AS rule, '« ' || priorite || ' » absent du dictionnaire' AS message FROM ({ROWS}) WHERE priorite ILIKE '4-NOT%'")
def unknown_list_values(spark, sf):
    typed = second.typed_view(prepared(spark, sf), ORDERS)
    return second.unknown_token_issues(typed, ORDERS, ["_rid"]).select("_rid", "rule", "message")


@query("geometry_checks_second", f"SELECT _rid, 'GEOM_ZERO' AS rule FROM ({ROWS}) WHERE x = 0")
def geometry_checks_second(spark, sf):
    return second.spread(prepared(spark, sf), ["_rid"], F.concat(*second.geometry_issues(ORDERS)), "seq").select("_rid", "rule")


_NUMS = f"SELECT DISTINCT regexp_extract(id_order, '^ZONE[0-9]+', 0) AS zone, CAST(regexp_extract(id_order, 'OR([0-9]+)$', 1) AS BIGINT) AS n FROM ({ROWS}) WHERE regexp_matches(id_order, '^ZONE[1-9][0-9]*OR[1-9][0-9]*$')"


@query("id_gaps", f"""WITH n AS ({_NUMS}), m AS (SELECT zone, unnest(range(1, max(n) + 1)) AS n FROM n GROUP BY zone), g AS (SELECT * FROM m ANTI JOIN n USING (zone, n)),
 r AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY n) AS i FROM g)
 SELECT zone, count(*) AS n_missing, string_agg(CAST(n AS VARCHAR), ', ' ORDER BY n) FILTER (i <= 15) AS first_missing FROM r GROUP BY zone""")
def id_gaps(spark, sf):
    return second.id_gaps(prepared(spark, sf), ORDERS).select("zone", "n_missing", F.array_join("first_missing", ", ").alias("first_missing"))


_ISS = """SELECT l_returnflag AS layer, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey END AS _rid, concat('R', CAST(l_linenumber % 4 AS STRING)) AS rule,
 CASE WHEN l_partkey % 9 = 0 THEN 'ERROR' WHEN l_partkey % 9 < 5 THEN 'WARNING' ELSE 'INFO' END AS severity FROM lineitem"""


@query("row_flags_second", f"""SELECT layer, _rid, CASE WHEN bool_or(severity = 'ERROR') THEN 'ERROR' ELSE 'WARNING' END AS qa_status,
 string_agg(DISTINCT rule, ',' ORDER BY rule) AS qa_flags FROM ({_ISS}) WHERE _rid IS NOT NULL AND severity <> 'INFO' GROUP BY ALL""")
def row_flags_second(spark, sf):
    return second.row_flags(derived(spark, sf, _ISS, "lineitem"))


@query("status_on_rows_second", f"""SELECT s_suppkey AS _rid, coalesce(st, 'OK') AS qa_status, coalesce(fl, '') AS qa_flags FROM supplier LEFT JOIN (SELECT _rid, CASE WHEN bool_or(severity = 'ERROR') THEN 'ERROR' ELSE 'WARNING' END AS st,
 string_agg(DISTINCT rule, ',' ORDER BY rule) AS fl FROM ({_ISS}) WHERE layer = 'A' AND severity <> 'INFO' GROUP BY _rid) ON s_suppkey = _rid""")
def status_on_rows_second(spark, sf):
    base = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("_rid"))
    return second.apply_status(base, "A", derived(spark, sf, _ISS, "lineitem"))


@query("completeness", f"""SELECT 'Orders' AS couche, champ, type, round_even(100.0 * n / t, 1)::DOUBLE AS renseigne_pct FROM (
 SELECT 'id_order' AS champ, 'TEXT' AS type, count(id_order) AS n, count(*) AS t FROM ({ROWS}) UNION ALL SELECT 'priorite', 'TEXT', count(nullif(priorite, '')), count(*) FROM ({ROWS})
 UNION ALL SELECT 'largeur_m', 'DOUBLE', count(*), count(*) FROM ({ROWS}) UNION ALL SELECT 'densite_couvert', 'INTEGER', count(*) FILTER (densite_couvert <> 'nan'), count(*) FROM ({ROWS})
 UNION ALL SELECT 'quai', 'BOOLEAN', count(*), count(*) FROM ({ROWS}))""")
def completeness(spark, sf):
    return second.completeness(rows(spark, sf), ORDERS)


@query("document_copies", "SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS is_copy FROM documents")
def document_copies(spark, sf):
    return duplicates.keep_first(table(spark, sf, "documents"), ["text"], ["doc_id"]).select("doc_id", "is_copy")


@query("repeated_values", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) > 1 AS is_repeated FROM orders")
def repeated_values(spark, sf):
    return duplicates.repeated(table(spark, sf, "orders"), "o_custkey").select("o_orderkey", "is_repeated")


_HARM = f"""WITH c AS (SELECT _rid, zone AS z0, id_order, CASE WHEN regexp_matches(id_order, '^ZONE[1-9][0-9]*OR[1-9][0-9]*$') THEN id_order END AS canon FROM ({ROWS})),
 b AS (SELECT *, CASE WHEN canon IS NULL THEN true WHEN row_number() OVER (PARTITION BY canon ORDER BY _rid) > 1 THEN true ELSE regexp_extract(canon, '^ZONE[0-9]+', 0) <> z0 END AS bad FROM c),
 t AS (SELECT z0, max(CAST(regexp_extract(canon, 'OR([0-9]+)$', 1) AS BIGINT)) AS top FROM b WHERE NOT bad GROUP BY z0)
 SELECT _rid, id_order AS id_orig, CASE WHEN bad THEN z0 || 'OR' || CAST(coalesce(top, 0) + row_number() OVER (PARTITION BY z0, bad ORDER BY _rid) AS VARCHAR) ELSE canon END AS id_order, bad AS renumbered FROM b LEFT JOIN t USING (z0)"""


@query("renumbered_ids", _HARM)
def renumbered_ids(spark, sf):
    out = repair.harmonise_ids(rows(spark, sf).select("_rid", "zone", "id_order"), ORDERS)
    return out.select("_rid", "id_orig", "id_order", F.col("_renumbered").alias("renumbered"))


@query("coerced_types", f"""SELECT _rid, CASE largeur_m WHEN '0,25' THEN 0.25 WHEN '12.5' THEN 12.5 END::DOUBLE AS largeur_m, CASE densite_couvert WHEN '101' THEN 101 WHEN '7.5' THEN 8 WHEN '40' THEN 40 END::BIGINT AS densite_couvert,
 CASE quai WHEN 'X' THEN true WHEN 'non' THEN false END AS quai FROM ({ROWS})""")
def coerced_types(spark, sf):
    return repair.coerce_types(rows(spark, sf), ORDERS).select("_rid", "largeur_m", "densite_couvert", "quai")


@query("repaired_list_values", f"""SELECT _rid, CASE WHEN priorite = '' THEN NULL WHEN upper(priorite) IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN upper(priorite) ELSE priorite END AS priorite FROM ({ROWS})""")
def repaired_list_values(spark, sf):
    return repair.repair_domains(repair.clean_texts(rows(spark, sf), ORDERS), ORDERS, 0.88).select("_rid", "priorite")


@query("contiguous_row_ids", "SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS _rid FROM orders")
def contiguous_row_ids(spark, sf):
    rows_ = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("k"))
    return repair.renumber_rows(rows_.withColumn("_rid", F.lit(0)), ["o_custkey", "k"]).select("k", "_rid")


# Answers of a list: right, in other case, free, misspelt within and beyond the similarity, and in several choices.
CHOICES = Layer("Choix", "Point", "id", None, (
    Variable("segment", "Segment", values=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Autre (préciser)")),
    Variable("services", "Services", type="multiselect", values=("Eau potable", "Électricité", "Latrines", "Aucun service"))))
ANSWERS = """SELECT c_custkey AS _rid, CASE WHEN c_custkey % 9 = 0 THEN concat(c_mktsegment, 'S') WHEN c_custkey % 9 = 1 THEN lower(substring(c_mktsegment, 2, 20)) WHEN c_custkey % 9 = 2 THEN substring(c_mktsegment, 1, 4)
 WHEN c_custkey % 9 = 3 THEN 'autre: quincaillerie' WHEN c_custkey % 9 = 4 THEN lower(c_mktsegment) WHEN c_custkey % 9 = 5 THEN 'x' WHEN c_custkey % 9 = 6 THEN NULL ELSE c_mktsegment END AS segment, c_mktsegment AS seg,
 CASE WHEN c_custkey % 5 = 0 THEN 'Eau potable; Electricite' WHEN c_custkey % 5 = 1 THEN 'Eau potabel | Latrine' WHEN c_custkey % 5 = 2 THEN 'Aucun services' WHEN c_custkey % 5 = 3 THEN 'Gaz' END AS services FROM customer"""
_JUDGED = f"""SELECT _rid, 'segment' AS field, 0 AS place, segment AS token, CASE WHEN _rid % 9 IN (0, 1) THEN 'fuzzy' WHEN _rid % 9 IN (2, 5) THEN 'none' WHEN _rid % 9 = 3 THEN 'free' WHEN _rid % 9 = 4 THEN 'case' ELSE 'ok' END AS status,
 CASE WHEN _rid % 9 IN (2, 3, 5) THEN segment ELSE seg END AS value FROM ({ANSWERS}) WHERE segment IS NOT NULL
 UNION ALL SELECT _rid, 'services', place, token, status, value FROM ({ANSWERS}) JOIN (VALUES (0, 0, 'Eau potable', 'ok', 'Eau potable'), (0, 1, 'Electricite', 'case', 'Électricité'), (1, 0, 'Eau potabel', 'fuzzy', 'Eau potable'),
  (1, 1, 'Latrine', 'fuzzy', 'Latrines'), (2, 0, 'Aucun services', 'fuzzy', 'Aucun service'), (3, 0, 'Gaz', 'none', 'Gaz')) v(r, place, token, status, value) ON _rid % 5 = r"""


@query("list_values_judged", _JUDGED)
def list_values_judged(spark, sf):
    df = derived(spark, sf, ANSWERS, "customer").drop("seg")
    return second.token_statuses(df, CHOICES, ["_rid"], second.CLOSE_CUTOFF).select("_rid", "field", F.col("at").cast("int").alias("place"), "token", "status", "value")


@query("list_suggestions", f"""SELECT _rid, field, '« ' || token || ' » absent du dictionnaire' AS message, CASE WHEN status = 'fuzzy' THEN 'Proche de : ' || value ELSE '' END AS suggestion FROM ({_JUDGED}) WHERE status IN ('fuzzy', 'none')""")
def list_suggestions(spark, sf):
    df = derived(spark, sf, ANSWERS, "customer").drop("seg")
    return second.unknown_token_issues(df, CHOICES, ["_rid"]).select("_rid", "field", "message", "suggestion")
