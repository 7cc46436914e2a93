"""Report tables on a status table and an issue table derived from customers and orders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fieldlens.operators import align, report
from fieldlens.plans.bindings.registry import derived, query, table
from fieldlens.plans.layer_qa import joined_messages, row_status

ROWS = """SELECT c_mktsegment AS couche, concat('f', CAST(c_custkey % 40 AS STRING), '.kml') AS fichier_source, c_custkey AS ligne_source,
 CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'inconnu' ELSE concat('Zone', CAST(c_nationkey AS STRING), 'CL', CAST(c_custkey AS STRING)) END AS id,
 c_name AS nom, concat('agent ', CAST(c_custkey % 15 AS STRING)) AS agent, CASE WHEN c_custkey % 9 = 0 THEN '2024-06-01' ELSE '2024-05-30' END AS date, 'kml' AS format,
 CAST(CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 3 ELSE 0 END AS BIGINT) AS n_err, CAST(c_custkey % 2 AS BIGINT) AS n_warn,
 CASE WHEN c_custkey % 4 = 0 AND c_custkey % 3 > 0 THEN 'À corriger' WHEN c_custkey % 2 = 1 THEN 'À vérifier' ELSE 'Conforme' END AS statut,
 'x' AS problemes, CASE WHEN c_custkey % 6 = 0 THEN CAST(floor(c_custkey / 12) AS BIGINT) END AS groupe_doublon, 'exact' AS nature_doublon, 'r' AS recommandation_doublon,
 CAST(c_custkey % 10 AS DOUBLE) AS longitude, CAST(c_custkey % 7 AS DOUBLE) AS latitude FROM customer"""
ISSUES = """SELECT o_orderpriority AS layer, CASE WHEN o_orderkey % 3 = 0 THEN 'warning' ELSE 'error' END AS severity,
 CASE WHEN o_orderkey % 5 = 0 THEN 'champ_obligatoire_vide' WHEN o_orderkey % 5 = 1 THEN 'id_format' WHEN o_orderkey % 5 = 2 THEN 'autre_type' ELSE 'hors_emprise' END AS type,
 concat('v', CAST(o_orderkey % 4 AS STRING)) AS variable, concat('agent ', CAST(o_custkey % 15 AS STRING)) AS agent, concat('f', CAST(o_custkey % 20 AS STRING)) AS fichier,
 o_custkey AS ligne, concat('m', CAST(o_orderkey % 6 AS STRING)) AS message FROM orders"""
ORDER_ROWS = "SELECT o_orderpriority AS couche, concat('Zone', CAST(o_custkey % 25 AS STRING), 'OR') AS id FROM orders"
_ZONE = "CASE WHEN regexp_matches(id, '^(?i)ZONE[0-9]+') THEN 'ZONE' || CAST(CAST(regexp_extract(id, '^(?i)ZONE([0-9]+)', 1) AS BIGINT) AS VARCHAR) ELSE 'SANS_ZONE' END"
DAY = date(2024, 6, 1)


def rows(spark, sf):
    return derived(spark, sf, ROWS, "customer")


def issues(spark, sf):
    return derived(spark, sf, ISSUES, "orders")


_SUMMARY = f"""SELECT couche, count(*) AS entites, count(DISTINCT fichier_source) AS fichiers, count(*) FILTER (statut = 'Conforme') AS conformes,
 count(*) FILTER (statut = 'À vérifier') AS a_verifier, count(*) FILTER (statut = 'À corriger') AS a_corriger, count(groupe_doublon) AS entites_en_doublon,
 CAST(sum(n_err) AS BIGINT) AS erreurs, CAST(sum(n_warn) AS BIGINT) AS avertissements, count(*) FILTER (date = '2024-06-01') AS entites_aujourdhui,
 round_even(100.0 * count(*) FILTER (statut = 'Conforme') / count(*), 1)::DOUBLE AS taux_conformite_pct FROM ({ROWS}) GROUP BY couche"""


@query("quality_summary", _SUMMARY)
def quality_summary(spark, sf):
    return report.quality_summary(rows(spark, sf), DAY)


@query("headline_metrics", f"""SELECT CAST(sum(entites) AS BIGINT) AS lignes, CAST(sum(a_corriger) AS BIGINT) AS a_corriger, CAST(sum(a_verifier) AS BIGINT) AS a_verifier,
 round_even(100.0 * sum(conformes) / sum(entites), 1)::DOUBLE AS conformes_pct, CAST(sum(entites_en_doublon) AS BIGINT) AS en_doublon FROM ({_SUMMARY})""")
def headline_metrics(spark, sf):
    return report.headline(report.quality_summary(rows(spark, sf), DAY))


# Team and recommended action of each issue type, as they must come out.
_TEXTS = (
    ("champ_obligatoire_vide", "Terrain", "Renseigner le champ (retour à l'agent ou nouvelle visite)"),
    ("valeur_hors_liste", "Traitement", "Remplacer la valeur par l'une des valeurs de la liste"),
    ("id_format", "Traitement", "Renommer l'identifiant au format ZONE<n><2 lettres de la couche><n> (ex. ZONE4IN1)"),
    ("id_duplique", "Traitement", "Un même ID est utilisé pour des positions différentes : attribuer des ID uniques"),
    ("doublon_exact", "Traitement", "Copie identique : ne garder qu'une ligne après validation (aucune suppression automatique)"),
    ("doublon_conflit", "Traitement", "Mêmes ID/position mais valeurs différentes : choisir la bonne version avec l'agent"),
    ("doublon_spatial", "Traitement", "Deux points quasi confondus portant le même ID/nom : vérifier s'il s'agit du même objet"),
    ("geometrie_vide", "Terrain", "Position absente ou illisible : récupérer le point (GPS non capté) ou re-lever"),
    ("geometrie_type", "Traitement", "Type de géométrie inattendu pour cette couche : vérifier la couche d'origine"),
    ("geometrie_invalide", "Traitement", "Réparer la géométrie (auto-intersection, anneau non fermé)"),
    ("hors_emprise", "Traitement", "Position hors du corridor : coordonnées inversées ou erronées ? Corriger ou re-lever"),
    ("hors_plage", "Terrain", "Valeur numérique hors plage plausible : vérifier avec l'agent"),
    ("type_invalide", "Traitement", "Valeur de mauvais type (ex. texte à la place d'un nombre ou Oui/Non) : corriger"),
    ("tronçon_court", "Traitement", "Tronçon très court : vérifier qu'il ne s'agit pas d'un doublon ou d'un clic parasite"),
    ("incoherence", "Terrain", "Champs contradictoires entre eux : confirmer la bonne réponse avec l'agent"),
    ("date_future", "Traitement", "Date dans le futur (horloge du terminal mal réglée) : corriger la date"),
    ("date_anterieure", "Traitement", "Date antérieure au début de la collecte : vérifier le fichier"),
)
_ACTIONS = " UNION ALL ".join("SELECT '{}' AS type, '{}' AS equipe, '{}' AS action".format(*(x.replace("'", "''") for x in a)) for a in _TEXTS)


@query("action_plan", f"""SELECT row_number() OVER (ORDER BY severity, n DESC, layer, type) AS priorite, layer AS couche,
 CASE severity WHEN 'error' THEN 'Erreur' ELSE 'Avertissement' END AS gravite, type, n AS nb_anomalies, l AS nb_lignes,
 coalesce(equipe, '') AS equipe, coalesce(action, 'Vérifier') AS action_recommandee FROM (SELECT layer, severity, type, count(*) AS n,
  count(DISTINCT (fichier, ligne)) AS l FROM ({ISSUES}) GROUP BY ALL) LEFT JOIN ({_ACTIONS}) USING (type)""")
def action_plan(spark, sf):
    return report.action_plan(issues(spark, sf))


@query("issues_with_actions", f"SELECT layer, type, ligne, coalesce(equipe, '') AS equipe, coalesce(action, 'Vérifier') AS action_recommandee FROM ({ISSUES}) LEFT JOIN ({_ACTIONS}) USING (type)")
def issues_with_actions(spark, sf):
    return report.with_actions(issues(spark, sf)).select("layer", "type", "ligne", "equipe", "action_recommandee")


@query("zone_coverage", "SELECT couche, " + ", ".join(f"count(*) FILTER (z = 'ZONE{i}') AS ZONE{i}" for i in range(25)) + f" FROM (SELECT couche, {_ZONE} AS z FROM ({ORDER_ROWS})) GROUP BY couche")
def zone_coverage(spark, sf):
    return report.coverage(derived(spark, sf, ORDER_ROWS, "orders"))


@query("zone_coverage_long", f"SELECT couche, coalesce({_ZONE}, 'SANS_ZONE') AS zone, count(*) AS entites FROM ({ROWS}) GROUP BY ALL")
def zone_coverage_long(spark, sf):
    return report.coverage_long(rows(spark, sf))


@query("rows_to_treat", f"""SELECT couche, statut, fichier_source, ligne_source, id, nom, agent, date, n_err AS nb_erreurs, n_warn AS nb_avertissements,
 problemes AS problemes_detectes, recommandation_doublon FROM ({ROWS}) WHERE statut <> 'Conforme'""")
def rows_to_treat(spark, sf):
    return report.to_treat(rows(spark, sf))


@query("duplicate_list", f"""SELECT couche || '-' || groupe_doublon AS groupe, couche, nature_doublon, fichier_source, ligne_source, format, id, nom, agent,
 recommandation_doublon FROM ({ROWS}) WHERE groupe_doublon IS NOT NULL""")
def duplicate_list(spark, sf):
    return report.duplicate_list(rows(spark, sf))


@query("empty_required_fields", f"""SELECT layer AS couche, variable AS champ, count(*) AS nb_lignes_vides, round_even(100.0 * count(*) / any_value(t), 1)::DOUBLE AS pct_des_lignes
 FROM ({ISSUES}) JOIN (SELECT o_orderpriority AS layer, count(*) AS t FROM orders GROUP BY ALL) USING (layer) WHERE type = 'champ_obligatoire_vide' GROUP BY ALL""")
def empty_required_fields(spark, sf):
    return report.empty_required(derived(spark, sf, ORDER_ROWS, "orders"), issues(spark, sf))


@query("agent_workload", f"SELECT agent, couche, count(*) AS lignes, count(*) FILTER (n_err > 0) AS lignes_a_corriger FROM ({ROWS}) GROUP BY ALL")
def agent_workload(spark, sf):
    return report.agent_workload(rows(spark, sf))


@query("issues_by_type", f"SELECT type, count(*) AS n FROM ({ISSUES}) GROUP BY type")
def issues_by_type(spark, sf):
    return report.issues_by_type(issues(spark, sf))


@query("rows_to_fix_by_agent", f"SELECT agent, count(*) AS n FROM ({ROWS}) WHERE statut = 'À corriger' GROUP BY agent")
def rows_to_fix_by_agent(spark, sf):
    return report.to_fix_by_agent(rows(spark, sf))


@query("run_totals", f"SELECT count(DISTINCT layer) AS couches, count(*) FILTER (severity = 'error') AS erreurs, count(*) FILTER (severity = 'warning') AS avertissements FROM ({ISSUES})")
def run_totals(spark, sf):
    return report.run_totals(issues(spark, sf))


@query("anomaly_list", f"SELECT layer AS couche, severity AS gravite, type, variable, agent, fichier AS fichier_source, ligne AS ligne_source, message FROM ({ISSUES})")
def anomaly_list(spark, sf):
    return report.anomalies(issues(spark, sf))


@query("filtered_rows", f"SELECT ligne_source, statut, agent FROM ({ROWS}) WHERE statut IN ('À corriger', 'À vérifier') AND agent IN ('agent 1', 'agent 2')")
def filtered_rows(spark, sf):
    return report.filter_rows(rows(spark, sf), ["À corriger", "À vérifier"], [], ["agent 1", "agent 2"]).select("ligne_source", "statut", "agent")


@query("agent_selector", f"SELECT DISTINCT agent FROM ({ISSUES})")
def agent_selector(spark, sf):
    return report.selector_values(issues(spark, sf), "agent")


@query("map_points", f"""SELECT coalesce(id, '(sans id)') AS id, CASE WHEN n_err > 0 THEN 'rouge' WHEN n_warn > 0 THEN 'orange' ELSE 'vert' END AS couleur,
 agent, longitude, latitude FROM ({ROWS})""")
def map_points(spark, sf):
    return report.map_points(rows(spark, sf))


@query("row_messages", f"SELECT fichier, ligne, string_agg(message, ' | ' ORDER BY message) AS problemes FROM (SELECT DISTINCT fichier, ligne, message FROM ({ISSUES})) GROUP BY ALL")
def row_messages(spark, sf):
    seq = F.substring("message", 2, 1).cast("int")
    kept = issues(spark, sf).groupBy("fichier", "ligne").agg(F.collect_set(F.struct(seq.alias("seq"), "message")).alias("i"))
    return kept.select("fichier", "ligne", joined_messages(F.col("i")).alias("problemes"))


@query("row_statuses", f"SELECT ligne_source, CASE WHEN n_err > 0 THEN 'À corriger' WHEN n_warn > 0 THEN 'À vérifier' ELSE 'Conforme' END AS statut FROM ({ROWS})")
def row_statuses(spark, sf):
    return rows(spark, sf).select("ligne_source", row_status(F.col("n_err"), F.col("n_warn")).alias("statut"))


_HIST = "SELECT CAST(CAST(ts AS DATE) AS STRING) AS date_execution, event_type AS couche, user_id FROM events"


def history(spark, sf):
    return derived(spark, sf, _HIST, "events").groupBy("date_execution", "couche").agg(F.count("*").alias("entites"))


@query("history_pivot", f"""SELECT date_execution, {', '.join(f"CAST(nullif(count(*) FILTER (couche = '{t}'), 0) AS BIGINT) AS {t}" for t in ('click', 'error', 'purchase', 'signup', 'view'))}
 FROM ({_HIST}) GROUP BY date_execution""")
def history_pivot(spark, sf):
    return report.history_pivot(history(spark, sf), ["click", "error", "purchase", "signup", "view"])


@query("history_upsert", f"""SELECT date_execution, couche, count(*) AS entites FROM ({_HIST}) WHERE date_execution <> '2024-01-30' GROUP BY ALL
 UNION ALL SELECT '2024-01-30', couche, 2 * count(*) FROM ({_HIST}) WHERE date_execution = '2024-01-30' GROUP BY couche""")
def history_upsert(spark, sf):
    h = history(spark, sf)
    return report.merge_history(h, h.filter("date_execution = '2024-01-30'").withColumn("entites", F.col("entites") * 2))


@query("layers_without_data", "SELECT n_name AS layer FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def layers_without_data(spark, sf):
    nations = table(spark, sf, "nation")
    data = table(spark, sf, "supplier").filter("s_acctbal > 5000").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("couche"))
    return align.layers_without_data(nations.select(F.col("n_name").alias("layer")), data)
