"""The first pack end to end on a survey layer derived from the customers, and its single group operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.functions.steps import spread
from fieldlens.operators import align, checks, duplicates, report
from fieldlens.operators.checks import Settings
from fieldlens.operators.distribution import attach
from fieldlens.plans.bindings.registry import (SURVEY, dealt_out, derived, query, sql_clean, sql_number, sql_utm, sql_value_key)
from fieldlens.plans.layer_qa import LayerCheck, check_layer, ordered_issues
from fieldlens.sources.dictionary import Layer, Variable

CLIENTS = Layer("Clients", "Point", "id_client", "nom_client", (
    Variable("id_client", "Identifiant", required=True),
    Variable("nom_client", "Nom du client", required=True),
    Variable("segment", "Segment", required=True, values=("Building", "Machinery", "Household", "Automobile", "Furniture")),
    Variable("services", "Services", type="multiselect", values=("Eau", "Gaz, fioul", "Électricité", "Aucun")),
    Variable("solde", "Solde", type="double", low=0, high=9000),
    Variable("effectif", "Effectif", type="integer", low=0, high=50),
    Variable("actif", "Actif", type="boolean"),
))
SETTINGS = Settings(run_date=date(2024, 6, 1), start_date=date(2024, 1, 15))


def survey(spark: SparkSession, sf: str) -> DataFrame:
    rows = dealt_out(derived(spark, sf, SURVEY, "customer"))
    return rows.withColumn("geom", geo.point(F.col("x"), F.col("y"))).drop("x", "y", "k")


def checked(spark: SparkSession, sf: str) -> LayerCheck:
    return check_layer(survey(spark, sf), CLIENTS, SETTINGS)


# ---- expected result, written with window functions and a plain distance join -----------------------
_seg, _act = sql_value_key("seg"), sql_value_key("act")
_SIG = ", ".join(f"""CASE WHEN regexp_matches(replace({v}, ',', '.'), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$')
    THEN CAST(CAST(replace({v}, ',', '.') AS DOUBLE) AS VARCHAR) ELSE {sql_value_key(v)} END""" for v in ("id", "nom", "seg", "srv", "sol", "eff", "act"))
_CTES = f"""
survey AS ({SURVEY}),
c AS (SELECT _path, _source, _row_src, _file_date, _fmt, x, y, {sql_clean('id_client')} AS id, {sql_clean('nom_client')} AS nom,
  {sql_clean('segment')} AS seg, {sql_clean('services')} AS srv, {sql_clean('solde')} AS sol, {sql_clean('effectif')} AS eff,
  {sql_clean('actif')} AS act, coalesce({sql_clean('agent')}, 'INCONNU') AS agent,
  coalesce(CASE WHEN created LIKE '__/__/____%' THEN strptime(substring(created, 1, 10), '%d/%m/%Y')::DATE
    ELSE CAST(substring(created, 1, 10) AS DATE) END, _file_date) AS d FROM survey),
t AS (SELECT *, {_seg} AS seg_k, {sql_number('sol')} AS sol_n, {sql_number('eff')} AS eff_n,
  CASE WHEN {_act} IN ('oui','true','vrai','1','yes','o','y','t') THEN true
       WHEN {_act} IN ('non','false','faux','0','no','n','f') THEN false END AS act_b,
  ' ' || {sql_value_key('srv')} || ' ' AS s0,
  CASE WHEN x IS NULL THEN '' ELSE CAST(round(x, 5) AS VARCHAR) || ' ' || CAST(round(y, 5) AS VARCHAR) END AS pos FROM c),
m1 AS (SELECT *, regexp_replace(s0, ' electricite ', ' ') AS s1 FROM t),
m2 AS (SELECT *, regexp_replace(s1, ' gaz fioul ', ' ') AS s2 FROM m1),
m3 AS (SELECT *, regexp_replace(s2, ' aucun ', ' ') AS s3 FROM m2),
w AS (SELECT *, trim(regexp_replace(s3, ' eau ', ' ')) AS rest FROM m3),
sig AS (SELECT *, concat_ws(chr(31), {_SIG}) AS sg,
  (CASE WHEN id IS NULL THEN 0 ELSE 1 END + CASE WHEN nom IS NULL THEN 0 ELSE 1 END + CASE WHEN seg IS NULL THEN 0 ELSE 1 END +
   CASE WHEN srv IS NULL THEN 0 ELSE 1 END + CASE WHEN sol IS NULL THEN 0 ELSE 1 END + CASE WHEN eff IS NULL THEN 0 ELSE 1 END +
   CASE WHEN act IS NULL THEN 0 ELSE 1 END) AS filled,
  CASE WHEN id IS NOT NULL THEN 'id:' || id WHEN nom IS NOT NULL THEN 'nom:' || nom END AS gk FROM w),
g0 AS (SELECT *, count(*) OVER g AS gn, row_number() OVER (PARTITION BY gk, pos ORDER BY filled DESC, _file_date DESC, _path, _row_src) AS rk,
   row_number() OVER (PARTITION BY gk, pos ORDER BY _path, _row_src) AS ro,
   CASE WHEN min(sg) OVER g = max(sg) OVER g THEN 'exact' ELSE 'conflit' END AS nat
   FROM sig WHERE gk IS NOT NULL WINDOW g AS (PARTITION BY gk, pos)),
grp AS (SELECT gk, pos, row_number() OVER (ORDER BY _path, _row_src) - 1 AS gid FROM g0 WHERE gn >= 2 AND ro = 1),
kept AS (SELECT gk, pos, _path AS kp, _row_src AS kr, _source AS ks, ro AS kro FROM g0 WHERE gn >= 2 AND rk = 1),
oth AS (SELECT g0.gk, g0.pos, arg_min(_row_src, ro) AS orow, arg_min(_source, ro) AS osrc
   FROM g0 JOIN kept ON g0.gk = kept.gk AND g0.pos = kept.pos WHERE gn >= 2 AND rk > 1 GROUP BY ALL),
mem AS (SELECT g0._path, g0._row_src, gid, nat, rk = 1 AS keep, CASE WHEN rk = 1 THEN orow ELSE kr END AS rrow,
   CASE WHEN rk = 1 THEN osrc ELSE ks END AS rsrc FROM g0 JOIN grp USING (gk, pos) JOIN kept USING (gk, pos) JOIN oth USING (gk, pos) WHERE gn >= 2),
ids AS (SELECT id FROM c JOIN t USING (_path, _row_src, id) WHERE id IS NOT NULL GROUP BY id HAVING count(DISTINCT pos) > 1),
utm AS (SELECT * FROM {sql_utm("(SELECT _path, _row_src, " + sql_value_key("coalesce(id, '') || ' ' || coalesce(nom, '')") + " AS sk, x, y FROM c WHERE x IS NOT NULL)", 'x', 'y', 33)}),
um AS (SELECT utm.*, gid FROM utm LEFT JOIN mem USING (_path, _row_src)),
near AS (SELECT DISTINCT a._path, a._row_src FROM um a JOIN um b ON a.sk = b.sk WHERE a.sk <> '' AND (a._path, a._row_src) <> (b._path, b._row_src)
   AND (a.e - b.e) * (a.e - b.e) + (a.n - b.n) * (a.n - b.n) <= 4 AND (a.gid IS NULL OR b.gid IS NULL OR a.gid <> b.gid)),
iss AS (
 SELECT _path, _row_src, 10 AS seq, 'error' AS severity, 'champ_obligatoire_vide' AS type, 'id_client' AS variable, NULL AS value, 'Champ obligatoire « Identifiant » (id_client) non renseigné' AS message FROM w WHERE id IS NULL
 UNION ALL SELECT _path, _row_src, 20, 'error', 'champ_obligatoire_vide', 'nom_client', NULL, 'Champ obligatoire « Nom du client » (nom_client) non renseigné' FROM w WHERE nom IS NULL
 UNION ALL SELECT _path, _row_src, 30, 'error', 'champ_obligatoire_vide', 'segment', NULL, 'Champ obligatoire « Segment » (segment) non renseigné' FROM w WHERE seg IS NULL
 UNION ALL SELECT _path, _row_src, 31, 'error', 'valeur_hors_liste', 'segment', seg, '« Segment » : valeur « ' || seg || ' » absente de la liste autorisée' FROM w WHERE seg IS NOT NULL AND seg_k NOT IN ('building','machinery','household','automobile','furniture')
 UNION ALL SELECT _path, _row_src, 41, 'error', 'valeur_hors_liste', 'services', srv, '« Services » : élément(s) hors liste « ' || rest || ' »' FROM w WHERE srv IS NOT NULL AND rest <> ''
 UNION ALL SELECT _path, _row_src, 52, 'error', 'type_invalide', 'solde', sol, '« Solde » : « ' || sol || ' » n''est pas un nombre' FROM w WHERE sol IS NOT NULL AND sol_n IS NULL
 UNION ALL SELECT _path, _row_src, 54, 'error', 'hors_plage', 'solde', CAST(sol_n AS VARCHAR), '« Solde » = ' || format('{{:g}}', sol_n) || ' inférieur au minimum plausible (0)' FROM w WHERE sol_n < 0
 UNION ALL SELECT _path, _row_src, 55, 'error', 'hors_plage', 'solde', CAST(sol_n AS VARCHAR), '« Solde » = ' || format('{{:g}}', sol_n) || ' supérieur au maximum plausible (9000)' FROM w WHERE sol_n > 9000
 UNION ALL SELECT _path, _row_src, 63, 'warning', 'type_invalide', 'effectif', eff, '« Effectif » : entier attendu, reçu ' || eff FROM w WHERE eff_n <> round(eff_n)
 UNION ALL SELECT _path, _row_src, 65, 'error', 'hors_plage', 'effectif', CAST(eff_n AS VARCHAR), '« Effectif » = ' || format('{{:g}}', eff_n) || ' supérieur au maximum plausible (50)' FROM w WHERE eff_n > 50
 UNION ALL SELECT _path, _row_src, 72, 'error', 'type_invalide', 'actif', act, '« Actif » : « ' || act || ' » n''est pas Oui/Non' FROM w WHERE act IS NOT NULL AND act_b IS NULL
 UNION ALL SELECT _path, _row_src, 100, 'error', 'id_duplique', 'id_client', id, 'Identifiant « ' || id || ' » utilisé pour plusieurs positions différentes' FROM w JOIN ids USING (id)
 UNION ALL SELECT _path, _row_src, 101, 'error', 'id_format', 'id_client', id, 'Identifiant « ' || id || ' » non conforme au format attendu (ZONE<n>CL<n>)' FROM w WHERE NOT regexp_matches(id, '^ZONE[0-9]+CL[0-9]+$')
 UNION ALL SELECT _path, _row_src, 110, 'error', 'date_future', '_date', CAST(d AS VARCHAR), 'Date de collecte dans le futur (horloge du terminal mal réglée ?)' FROM w WHERE d > DATE '2024-06-02'
 UNION ALL SELECT _path, _row_src, 111, 'warning', 'date_anterieure', '_date', CAST(d AS VARCHAR), 'Date antérieure au début de la collecte (2024-01-15)' FROM w WHERE d < DATE '2024-01-15'
 UNION ALL SELECT _path, _row_src, 120, 'error', 'geometrie_vide', 'geometry', NULL, 'Géométrie absente ou illisible' FROM w WHERE x IS NULL
 UNION ALL SELECT _path, _row_src, 121, 'error', 'hors_emprise', 'geometry', NULL, 'Localisation hors de l''emprise attendue du corridor (coordonnées inversées ou erronées ?)' FROM w WHERE x < 8 OR x > 17.5 OR y < 2 OR y > 14.5
 UNION ALL SELECT _path, _row_src, 122, 'error', 'hors_emprise', 'geometry', '0,0', 'Coordonnées (0,0) : GPS non capté' FROM w WHERE x = 0 AND y = 0
 UNION ALL SELECT _path, _row_src, 129, 'warning', 'doublon_spatial', 'geometry', NULL, 'Point à moins de 2 m d''un autre point identique (même id/nom)' FROM near
 UNION ALL SELECT _path, _row_src, 130, 'warning', 'doublon_exact', 'id_client', NULL, 'Copie identique de la ligne ' || CAST(rrow AS VARCHAR) || ' de « ' || rsrc || ' » (ex. même collecte en .kml et .shp)' FROM mem WHERE nat = 'exact' AND NOT keep
 UNION ALL SELECT _path, _row_src, 130, 'warning', 'doublon_conflit', 'id_client', NULL, 'Mêmes ID/position que la ligne ' || CAST(rrow AS VARCHAR) || ' de « ' || rsrc || ' » mais valeurs différentes : à arbitrer' FROM mem WHERE nat = 'conflit'),
st AS (SELECT w._path, w._row_src, w._source, w._fmt, id, nom, agent, CAST(d AS VARCHAR) AS date, x, y,
  (SELECT count(*) FROM iss i WHERE i._path = w._path AND i._row_src = w._row_src AND severity = 'error') AS n_err,
  (SELECT count(*) FROM iss i WHERE i._path = w._path AND i._row_src = w._row_src AND severity = 'warning') AS n_warn,
  gid, nat, keep FROM w LEFT JOIN mem USING (_path, _row_src)),
msg AS (SELECT _path, _row_src, string_agg(message, ' | ' ORDER BY s) AS problemes FROM
  (SELECT _path, _row_src, message, min(seq) AS s FROM iss GROUP BY ALL) GROUP BY ALL)"""
_STATUS = "CASE WHEN n_err > 0 THEN 'À corriger' WHEN n_warn > 0 THEN 'À vérifier' ELSE 'Conforme' END"
_ROWS = f"""SELECT 'Clients' AS couche, _source AS fichier_source, _row_src AS ligne_source, id, nom, agent, date, _fmt AS format,
 n_err, n_warn, {_STATUS} AS statut, coalesce(problemes, '') AS problemes, gid AS groupe_doublon, coalesce(nat, '') AS nature_doublon,
 CASE WHEN nat = 'exact' AND keep THEN 'Conserver (ligne la plus complète du groupe)' WHEN nat = 'exact' THEN 'Copie identique : à écarter après validation'
  WHEN nat = 'conflit' AND keep THEN 'Valeurs différentes : arbitrer (version la plus complète)' WHEN nat = 'conflit' THEN 'Valeurs différentes : arbitrer' ELSE '' END AS recommandation_doublon,
 round(x, 6) AS longitude, round(y, 6) AS latitude, _path FROM st LEFT JOIN msg USING (_path, _row_src)"""


@query("layer_issues", f"""WITH {_CTES} SELECT 'Clients' AS layer, severity, type, id, nom, agent, CAST(d AS VARCHAR) AS date, variable, value,
 message, _source AS fichier, _row_src AS ligne FROM iss JOIN w USING (_path, _row_src)""")
def layer_issues(spark, sf):
    return ordered_issues(checked(spark, sf).issues).drop("_path", "_seq")


@query("layer_rows", f"WITH {_CTES} {_ROWS}")
def layer_rows(spark, sf):
    return checked(spark, sf).rows


@query("layer_quality_summary", f"""WITH {_CTES}, r AS ({_ROWS}) SELECT couche, count(*) AS entites, count(DISTINCT fichier_source) AS fichiers,
 count(*) FILTER (statut = 'Conforme') AS conformes, count(*) FILTER (statut = 'À vérifier') AS a_verifier,
 count(*) FILTER (statut = 'À corriger') AS a_corriger, count(groupe_doublon) AS entites_en_doublon, CAST(sum(n_err) AS BIGINT) AS erreurs,
 CAST(sum(n_warn) AS BIGINT) AS avertissements, count(*) FILTER (date = '2024-01-20') AS entites_aujourdhui,
 round(100.0 * count(*) FILTER (statut = 'Conforme') / count(*), 1) AS taux_conformite_pct FROM r GROUP BY couche""")
def layer_quality_summary(spark, sf):
    return report.quality_summary(checked(spark, sf).rows, date(2024, 1, 20))


@query("row_local_checks", f"""WITH {_CTES} SELECT _path, _row_src, severity, type, variable, value, message FROM iss
 WHERE type NOT IN ('id_duplique', 'doublon_spatial', 'doublon_exact', 'doublon_conflit')""")
def row_local_checks(spark, sf):
    work = checks.add_position(checks.add_meta(align.harmonise(survey(spark, sf), CLIENTS), SETTINGS))
    done = checks.row_checks(checks.canonicalise(work, CLIENTS), CLIENTS, SETTINGS)
    return spread(done, ["_path", "_row_src"], "_issues", "seq").drop("seq")


@query("canonical_values", f"""WITH {_CTES} SELECT _path, _row_src, CASE seg_k WHEN 'building' THEN 'Building' WHEN 'machinery' THEN 'Machinery'
  WHEN 'household' THEN 'Household' WHEN 'automobile' THEN 'Automobile' WHEN 'furniture' THEN 'Furniture' ELSE seg END AS segment,
  CASE WHEN srv IS NOT NULL THEN nullif(concat_ws('; ', CASE WHEN contains(s3, ' eau ') THEN 'Eau' END,
   CASE WHEN contains(s1, ' gaz fioul ') THEN 'Gaz, fioul' END, CASE WHEN contains(s0, ' electricite ') THEN 'Électricité' END,
   CASE WHEN contains(s2, ' aucun ') THEN 'Aucun' END), '') END AS services,
  sol_n AS solde, eff_n AS effectif, act_b AS actif FROM w""")
def canonical_values(spark, sf):
    done = checks.canonicalise(align.harmonise(survey(spark, sf), CLIENTS), CLIENTS)
    return done.select("_path", "_row_src", "segment", "services", "solde", "effectif", "actif")


@query("duplicate_groups", f"""WITH {_CTES} SELECT gid AS groupe, any_value(nat) AS nature, count(*) AS n,
  CAST(max(CASE WHEN keep THEN _row_src END) AS BIGINT) AS ligne_conservee FROM mem GROUP BY gid""")
def duplicate_groups(spark, sf):
    groups = checked(spark, sf).groups
    return groups.select(F.col("_grp").alias("groupe"), "nature", "n", F.col("kept._row_src").alias("ligne_conservee"))


@query("shared_identifiers", f"WITH {_CTES} SELECT id, count(*) AS n FROM t JOIN ids USING (id) GROUP BY id")
def shared_identifiers(spark, sf):
    work = checks.add_position(align.harmonise(survey(spark, sf), CLIENTS))
    return duplicates.shared_ids(work, "id_client").select(F.col("_id").alias("id"), "n")


@query("rows_of_shared_identifiers", f"WITH {_CTES} SELECT _path, _row_src, id FROM t JOIN ids USING (id)")
def rows_of_shared_identifiers(spark, sf):
    work = checks.add_position(align.harmonise(survey(spark, sf), CLIENTS)).select("_path", "_row_src", F.col("id_client").alias("_id"), "_px", "_py")
    return attach(work, duplicates.shared_ids(work, "_id"), ["_id"], "n", "inner").select("_path", "_row_src", F.col("_id").alias("id"))


@query("near_copies_of_one_object", f"WITH {_CTES} SELECT _path, _row_src FROM near")
def near_copies_of_one_object(spark, sf):
    return checked(spark, sf).near_issues.select("_path", "_row_src")


@query("date_and_agent", f"WITH {_CTES} SELECT _path, _row_src, d AS jour, agent FROM w")
def date_and_agent(spark, sf):
    work = checks.add_meta(align.harmonise(survey(spark, sf), CLIENTS), SETTINGS)
    return work.select("_path", "_row_src", F.col("_date").alias("jour"), F.col("_agent").alias("agent"))
