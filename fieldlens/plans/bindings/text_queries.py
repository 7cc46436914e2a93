"""Scalar functions over the documents, pages, parts, orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions import text as tx
from fieldlens.functions import values as vl
from fieldlens.functions.steps import in_steps, spread
from fieldlens.operators import align, checks, report
from fieldlens.operators.repair import canonical_id
from fieldlens.plans.bindings.registry import (SURVEY, derived, query, sql_clean, sql_number, sql_phrase_key, sql_value_key, table)

D = "text"


@query("ascii_folding", "SELECT doc_id, strip_accents(replace(text, 'ß', '')) AS folded FROM documents")
def ascii_folding(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.ascii_fold(F.col("text")).alias("folded"))


@query("name_keys", """SELECT page_id, regexp_replace(regexp_replace(lower(strip_accents(replace(url, 'ß', ''))), '[^a-z0-9]+', '_', 'g'),
 '^_+|_+$', '', 'g') AS key FROM pages""")
def name_keys(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.name_key(F.col("url")).alias("key"))


@query("value_keys", f"SELECT doc_id, {sql_value_key("replace(text, 'ß', '')")} AS key FROM documents")
def value_keys(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.value_key(F.col("text")).alias("key"))


@query("phrase_keys", f"SELECT doc_id, {sql_phrase_key('text')} AS key FROM documents")
def phrase_keys(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.phrase_key(F.col("text")).alias("key"))


_CELLS = """SELECT c_custkey AS k, CASE WHEN c_custkey % 9 = 0 THEN ' N/A ' WHEN c_custkey % 9 = 1 THEN concat('"', c_name, '"')
 WHEN c_custkey % 9 = 2 THEN concat('  ', c_name, '   x  ') WHEN c_custkey % 9 = 3 THEN '"none"' WHEN c_custkey % 9 = 4 THEN '<null>'
 WHEN c_custkey % 9 = 5 THEN NULL WHEN c_custkey % 9 = 6 THEN 'NaT' WHEN c_custkey % 9 = 7 THEN '"' ELSE c_mktsegment END AS cell FROM customer"""


@query("cleaned_cells", f"SELECT k, {sql_clean('cell')} AS cleaned, coalesce({sql_clean('cell')}, 'vide') AS filled FROM ({_CELLS})")
def cleaned_cells(spark, sf):
    c = tx.clean_na(F.col("cell"))
    return derived(spark, sf, _CELLS, "customer").select("k", c.alias("cleaned"), F.coalesce(c, F.lit("vide")).alias("filled"))


@query("empty_cells_second", f"""SELECT k, cell IS NULL OR lower(trim(cell)) IN ('', 'nan', 'none', 'null', '<null>', 'nat', '<na>') AS is_null,
 CASE WHEN NOT (cell IS NULL OR lower(trim(cell)) IN ('', 'nan', 'none', 'null', '<null>', 'nat', '<na>')) THEN trim(regexp_replace(cell, '\\s+', ' ', 'g')) END AS cleaned
 FROM ({_CELLS})""")
def empty_cells_second(spark, sf):
    c = F.col("cell")
    return derived(spark, sf, _CELLS, "customer").select("k", tx.is_null_second(c).alias("is_null"), tx.clean_text_second(c).alias("cleaned"))


@query("clean_documents", "SELECT doc_id, nullif(trim(regexp_replace(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '\\s+', ' ', 'g')), '') AS cleaned FROM documents")
def clean_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_text_second(F.col("text")).alias("cleaned"))


@query("xml_escaped_pages", """SELECT page_id, replace(replace(replace(regexp_replace(html, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages""")
def xml_escaped_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.xml_text(F.col("html")).alias("escaped"))


_NUMBERS = """SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_orderkey % 7 = 0 THEN replace(CAST(l_extendedprice AS STRING), '.', ',')
 WHEN l_orderkey % 7 = 1 THEN concat(' ', CAST(l_quantity AS STRING), ' ') WHEN l_orderkey % 7 = 2 THEN concat('1 ', CAST(l_linenumber AS STRING), '00,5')
 WHEN l_orderkey % 7 = 3 THEN concat(CAST(l_linenumber AS STRING), 'd') WHEN l_orderkey % 7 = 4 THEN '-- ' WHEN l_orderkey % 7 = 5 THEN concat('.', CAST(l_linenumber AS STRING))
 ELSE concat('+', CAST(l_linenumber AS STRING), 'e2') END AS t FROM lineitem"""


@query("numbers_first", f"SELECT k, n, t, {sql_number('t')} AS x FROM ({_NUMBERS})")
def numbers_first(spark, sf):
    return derived(spark, sf, _NUMBERS, "lineitem").select("k", "n", "t", vl.number_first(F.col("t")).alias("x"))


@query("numbers_second", f"SELECT k, n, {sql_number('t')} AS x, {sql_number('t')} IS NULL AS bad FROM ({_NUMBERS})")
def numbers_second(spark, sf):
    c = F.col("t")
    return derived(spark, sf, _NUMBERS, "lineitem").select("k", "n", vl.number_second(c).alias("x"), vl.bad_number_second(c).alias("bad"))


@query("comparable_values", f"""SELECT k, n, {sql_number("trim(t)")} IS NOT NULL AND t NOT LIKE '1 %' AS is_number,
 CASE WHEN {sql_number("trim(t)")} IS NULL OR t LIKE '1 %' THEN {sql_value_key('t')} END AS key FROM ({_NUMBERS})""")
def comparable_values(spark, sf):
    number = tx.compose(vl.COMPARABLE_NUMBER_STEPS)(F.col("t"))
    return derived(spark, sf, _NUMBERS, "lineitem").select("k", "n", number.isNotNull().alias("is_number"),
                                                           F.when(number.isNull(), vl.comparable(F.col("t"))).alias("key"))


_WORDS = """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'OUI' WHEN o_orderkey % 11 = 1 THEN 'Vrai ' WHEN o_orderkey % 11 = 2 THEN 'x'
 WHEN o_orderkey % 11 = 3 THEN '0' WHEN o_orderkey % 11 = 4 THEN 'Faux' WHEN o_orderkey % 11 = 5 THEN NULL WHEN o_orderkey % 11 = 6 THEN 'n'
 WHEN o_orderkey % 11 = 7 THEN 'peut-être' WHEN o_orderkey % 11 = 8 THEN 'null' WHEN o_orderkey % 11 = 9 THEN 'True.' ELSE 'Y' END AS w FROM orders"""


@query("yes_no_first", f"""SELECT k, CASE WHEN {sql_value_key('w')} IN ('oui','true','vrai','1','yes','o','y','t') THEN true
 WHEN {sql_value_key('w')} IN ('non','false','faux','0','no','n','f') THEN false END AS b FROM ({_WORDS})""")
def yes_no_first(spark, sf):
    return derived(spark, sf, _WORDS, "orders").select("k", vl.bool_first(F.col("w")).alias("b"))


@query("yes_no_second", f"""SELECT k, CASE WHEN {sql_phrase_key('w')} IN ('oui','true','vrai','1','yes','o','y','t','x') THEN true
 WHEN {sql_phrase_key('w')} IN ('non','false','faux','0','no','n','f') THEN false END AS b,
 w IS NOT NULL AND lower(w) <> 'null' AND {sql_phrase_key('w')} NOT IN ('oui','true','vrai','1','yes','o','y','t','x','non','false','faux','0','no','n','f') AS bad FROM ({_WORDS})""")
def yes_no_second(spark, sf):
    c = F.col("w")
    return derived(spark, sf, _WORDS, "orders").select("k", vl.bool_second(c).alias("b"), vl.bad_bool_second(c).alias("bad"))


_CHOICES = """SELECT p_partkey AS k, CASE WHEN p_partkey % 6 = 0 THEN concat(p_type, '; ', p_brand) WHEN p_partkey % 6 = 1 THEN concat(lower(p_type), ', ', p_name)
 WHEN p_partkey % 6 = 2 THEN 'Gaz, fioul | Eau' WHEN p_partkey % 6 = 3 THEN 'gaz, FIOUL' WHEN p_partkey % 6 = 4 THEN concat(p_type, ', ', p_type) ELSE ' nan ' END AS t FROM part"""
_VALUES = ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE", "Gaz, fioul", "Eau"]
_KEYS = [tx.plain_phrase_key(v) for v in _VALUES]
_KEYLIST = ", ".join(f"'{k}'" for k in _KEYS)


@query("choices_split_second", f"""SELECT k, row_number() OVER (PARTITION BY k ORDER BY i, j) AS at, trim(u) AS token FROM (
 SELECT k, i, unnest(us) AS u, unnest(range(len(us))) AS j FROM (SELECT k, i, CASE WHEN {sql_phrase_key('p')} NOT IN ({_KEYLIST}) AND contains(p, ',')
  THEN regexp_split_to_array(p, '\\s*,\\s*') ELSE [p] END AS us FROM (SELECT k, unnest(ps) AS p, unnest(range(len(ps))) AS i FROM (
   SELECT k, CASE WHEN {sql_phrase_key('t')} IN ({_KEYLIST}) THEN [trim(t)] ELSE regexp_split_to_array(trim(t), '\\s*[;|]\\s*') END AS ps
   FROM ({_CHOICES}) WHERE trim(lower(t)) <> 'nan')))) WHERE trim(u) <> ''""")
def choices_split_second(spark, sf):
    tokens = derived(spark, sf, _CHOICES, "part").select("k", F.posexplode(tx.split_choices(F.col("t"), _KEYS)).alias("i", "token"))
    return tokens.select("k", (F.col("i") + 1).cast("long").alias("at"), "token")


_STATUS = f"""CASE WHEN tok IN ('ECONOMY','SMALL','MEDIUM','PROMO','STANDARD','LARGE','Gaz, fioul','Eau') THEN 'ok'
 WHEN {sql_phrase_key('tok')} IN ({_KEYLIST}) THEN 'case' ELSE 'none' END"""
_TOK = "SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN p_type WHEN p_partkey % 3 = 1 THEN lower(p_type) ELSE p_name END AS tok FROM part"


@query("list_match_second", f"SELECT k, tok, {_STATUS} AS status, CASE WHEN {_STATUS} = 'case' THEN upper(tok) ELSE tok END AS value FROM ({_TOK})")
def list_match_second(spark, sf):
    s = tx.domain_status(F.col("tok"), _VALUES)
    return derived(spark, sf, _TOK, "part").select("k", "tok", s["status"].alias("status"), s["value"].alias("value"))


_DATES = """SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 6 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
 WHEN o_orderkey % 6 = 1 THEN concat(lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', CAST(year(o_orderdate) AS STRING))
 WHEN o_orderkey % 6 = 2 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T23:59:59+02:00')
 WHEN o_orderkey % 6 = 3 THEN concat(CAST(day(o_orderdate) AS STRING), '.', CAST(month(o_orderdate) AS STRING), '.', CAST(year(o_orderdate) AS STRING), ' 08:30')
 WHEN o_orderkey % 6 = 4 THEN replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') ELSE 'hier' END AS t FROM orders"""


@query("dates_read", f"SELECT k, CASE WHEN k % 6 < 5 THEN d END AS jour, CASE WHEN k % 6 < 5 THEN strftime(d, '%Y-%m-%d') END AS texte FROM ({_DATES})")
def dates_read(spark, sf):
    d = F.to_date(vl.parse_date(F.col("t")))
    return derived(spark, sf, _DATES, "orders").select("k", d.alias("jour"), vl.day_text(d).alias("texte"))


@query("date_checks", "SELECT o_orderkey AS k, CASE WHEN o_orderdate > DATE '2000-01-02' THEN 'date_future' ELSE 'date_anterieure' END AS type FROM orders WHERE o_orderdate > DATE '2000-01-02' OR o_orderdate < DATE '1996-01-01'")
def date_checks(spark, sf):
    from datetime import date
    s = checks.Settings(run_date=date(2000, 1, 1), start_date=date(1996, 1, 1))
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("_date"))
    return spread(rows, ["k"], F.concat(*checks.date_issues(s)), "seq").select("k", "type")


_IDS = """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN concat('zone ', CAST(o_custkey % 25 AS STRING), '-or-', CAST(o_orderkey AS STRING))
 WHEN o_orderkey % 7 = 1 THEN concat('ZONE0', CAST(1 + o_custkey % 25 AS STRING), 'OR00', CAST(o_orderkey AS STRING)) WHEN o_orderkey % 7 = 2 THEN concat('ZONE3XX', CAST(o_orderkey AS STRING))
 WHEN o_orderkey % 7 = 3 THEN 'null' WHEN o_orderkey % 7 = 4 THEN 'Zone12-sans' ELSE concat('ZONE', CAST(1 + o_custkey % 25 AS STRING), 'OR', CAST(o_orderkey AS STRING)) END AS id FROM orders"""
_FLAT = "regexp_replace(upper(id), '[\\s_\\-./]', '', 'g')"
_ZN = "CAST(regexp_extract(s, '^ZONE0*([0-9]+)OR0*([0-9]+)$', 1) AS BIGINT)"
_NN = "CAST(regexp_extract(s, '^ZONE0*([0-9]+)OR0*([0-9]+)$', 2) AS BIGINT)"


@query("canonical_ids", f"""SELECT k, CASE WHEN regexp_matches(s, '^ZONE0*([1-9][0-9]*)OR0*([1-9][0-9]*)$') THEN 'ZONE' || {_ZN} || 'OR' || {_NN} END AS canon
 FROM (SELECT k, {_FLAT} AS s FROM ({_IDS}))""")
def canonical_ids(spark, sf):
    return derived(spark, sf, _IDS, "orders").select("k", canonical_id(F.col("id"), "OR").alias("canon"))


@query("zones_of_ids", """SELECT k, CASE WHEN regexp_matches(id, '^(?i)ZONE[0-9]+') THEN 'ZONE' || CAST(CAST(regexp_extract(id, '^(?i)ZONE([0-9]+)', 1) AS BIGINT) AS VARCHAR) ELSE 'SANS_ZONE' END AS zone FROM (%s)""" % _IDS)
def zones_of_ids(spark, sf):
    return derived(spark, sf, _IDS, "orders").select("k", report.zone_of_id(F.col("id")).alias("zone"))


@query("position_keys", f"SELECT _path, _row_src, CASE WHEN x IS NULL THEN '' ELSE CAST(round(x, 5) AS VARCHAR) || ' ' || CAST(round(y, 5) AS VARCHAR) END AS pos FROM ({SURVEY})")
def position_keys(spark, sf):
    return derived(spark, sf, SURVEY, "customer").select("_path", "_row_src", checks.position_key(F.col("x"), F.col("y")).alias("pos"))


@query("label_prefixes", """SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_type || ' x' END AS prefix, p_partkey % 2 = 1 AS differs FROM part""")
def label_prefixes(spark, sf):
    t = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_type", F.lit(" – "), "p_name")).otherwise(F.concat("p_type", F.lit(" x - "), "p_name"))
    p = tx.label_prefix(t)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), p.alias("prefix"), (tx.value_key(p) != tx.value_key(F.col("p_type"))).alias("differs"))


@query("agent_file_names", "SELECT s_suppkey AS k, regexp_replace(s_name || ' é/' || CAST(s_nationkey AS VARCHAR), '[^A-Za-z0-9_-]+', '_', 'g') AS fichier FROM supplier")
def agent_file_names(spark, sf):
    c = F.concat("s_name", F.lit(" é/"), F.col("s_nationkey").cast("string"))
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), report.agent_file(c).alias("fichier"))


@query("zones_in_paths", "SELECT o_orderkey AS k, 'ZONE' || CAST(o_custkey AS VARCHAR) AS zone FROM orders")
def zones_in_paths(spark, sf):
    c = F.concat(F.lit("/in/Zone_0"), F.col("o_custkey").cast("string"), F.lit("/f.kml"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), align.zone_in_text(c).alias("zone"))


@query("number_texts", "SELECT l_orderkey AS k, l_linenumber AS n, format('{:g}', l_extendedprice) AS g, CAST(l_extendedprice AS VARCHAR) AS t FROM lineitem")
def number_texts(spark, sf):
    rows = in_steps(table(spark, sf, "lineitem"), {"g": (F.col("l_extendedprice"), vl.GENERAL_STEPS)})
    return rows.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "g", vl.double_text(F.col("l_extendedprice")).alias("t"))
