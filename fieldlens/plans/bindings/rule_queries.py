"""Cross-field rules of both packs on layers derived from the line items.

Each layer gets its answers from the columns of a line item, so every rule meets rows that satisfy it and
rows that do not. The expected result spells every predicate out on the derived answers.
"""

from __future__ import annotations


from fieldlens.operators.rules import FIRST_PACK, SECOND_PACK, evaluate_rules
from fieldlens.plans.bindings.registry import derived, query


def pick(expr: str, *values: str | None) -> str:
    """CASE over ``expr % n`` with one branch per value."""
    n = len(values)
    quoted = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return "CASE " + " ".join(f"WHEN ({expr}) % {n} = {i} THEN {v}" for i, v in enumerate(quoted)) + " END"


def flag(expr: str) -> str:
    return f"CASE WHEN ({expr}) % 3 = 0 THEN true WHEN ({expr}) % 3 = 1 THEN false END"


K1, K2, K3 = "l_orderkey + l_linenumber", "l_partkey", "l_suppkey + l_linenumber"
ANSWERS = {
    "Gares": {"presence_magasin_gare": flag(K1), "type_magasin": pick(K2, None, "Autre", "Boutique-commerce"),
              "capacite_stockage_gare": pick(K3, None, "Non applicable", "< 100 t", "NON applicable"),
              "reseau_telecom": pick(K2, "Aucune couverture", "aucune  Couverture", "Bonne couverture", None),
              "operateur_telecom": pick(K1, None, "MTN; Orange")},
    "Infrastructures_Ferroviaires": {"type_infra": pick(K2, "Passage à niveau", "Gare", "passage a NIVEAU", None), "quai_embarq": flag(K1)},
    "Points_Vente_Marches": {"presence_magasin_stockage": flag(K1), "capacite_stockage": pick(K2, None, "Non applicable", "< 100 t"),
                             "presence_aire_chargement": flag(K3), "type_aire_chargement": pick(K2, None, "Quai", "Parking", "Autre")},
    "Reseau_Routier_Pistes": {"pt_critique": flag(K1), "type_blocage": pick(K2, None, "Aucun", "Pont endommagé", "aucun"),
                              "praticabilite_pluie": pick(K3, "Accessible toute année (Toutes voitures)", None, "Accessible uniquement Moto / Pied"),
                              "duree_coupure_jours": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_linenumber % 3 AS DOUBLE) END",
                              "categorie_voie": pick(K1, "Route Nationale (RN)", "Route Régionale", "Voirie Primaire", None),
                              "type_surface": pick(K2, "Terre", "Sable", "Bitume", None)},
    "Activites_autour_gare": {"type_culture": pick(K1, None, "Maïs"), "type_elevage": pick(K2, None, "Bovins", "Ovins"),
                              "type_activite": pick(K3, "Agriculture – champs riverains", "Pâturage – élevage extensif", "Commerce", None),
                              "traversee_betail": pick(K1, "Oui, fréquente", "Oui, occasionnelle", "Non", None), "point_traversee_informelle": flag(K2),
                              "localisation_gare": pick(K2, "Dans l'emprise ferroviaire", "Hors emprise"), "distance_voie": pick(K3, "50–200 m", "> 200 m", "< 50 m", None)},
    "Ouvrage_franchissement": {
        "type_ouvrage": pick(K1, "Passage à niveau (PN) gardé", "Passage à niveau (PN) non gardé", "Passage informel (traversée sauvage)", "Autre (préciser)", None, "PN gardé"),
        "presence_gardien": pick(K2, "Non", "Oui, permanent", None, "non"),
        "dispositif_securite": pick(K3, "Gardien-barrières présent", "Aucun dispositif", "Barrières manuelles; Gardien-barrières présent", None),
        "etat_ouvrage": pick(K2, "Impraticable", "Bon", None), "necessite_rehab": pick(K1, "Non nécessaire", "Urgente", None),
        "statut_ouvrage": pick(K3, "Traversée sauvage (interdite)", "Officiel", None)},
    "Gouvernance_Services_Securite": {"moyens_mobilite": pick(K1, "Moto; Aucun moyen propre", "Aucun moyen propre", "Moto; Autre", None),
                                      "source_energie_securite": pick(K2, "Aucune; Solaire", "Aucune", "Solaire; Groupe", None, "Aucunement; X")},
    "Ground_Truthing_LandCover": {"classe_reelle": pick(K1, "Forêt dense / Couvert arborescent", "Sol nu / Zone d'extraction", "Savane", None),
                                  "densite_couvert": "CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_partkey % 100 AS DOUBLE) END"},
    "Services_Sociaux_Bases": {"type_equipement": pick(K1, "Santé – CSI", "Éducation – Lycée", "Autre – à préciser", None, "Sécurité"),
                               "domaine_activite": pick(K2, "Santé", "éducation", "Autre (préciser)", None, "Sécurité")},
}


def answers(layer: str) -> str:
    return "SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, " + ", ".join(f"{e} AS {c}" for c, e in ANSWERS[layer].items()) + " FROM lineitem"


_DASH_PREFIX = "CASE WHEN contains(type_equipement, ' – ') THEN split_part(type_equipement, ' – ', 1) ELSE type_equipement END"
# predicates on the derived answers, in rule order
FIRST_SQL = {
    "Gares": ["presence_magasin_gare AND type_magasin IS NULL", "NOT presence_magasin_gare AND type_magasin IS NOT NULL",
              "NOT presence_magasin_gare AND capacite_stockage_gare <> 'Non applicable'"],
    "Points_Vente_Marches": ["NOT presence_magasin_stockage AND capacite_stockage <> 'Non applicable'", "presence_magasin_stockage AND capacite_stockage IS NULL",
                             "presence_aire_chargement AND type_aire_chargement IS NULL", "NOT presence_aire_chargement AND type_aire_chargement IS NOT NULL"],
    "Reseau_Routier_Pistes": ["pt_critique AND (type_blocage IS NULL OR type_blocage = 'Aucun')", "NOT pt_critique AND type_blocage <> 'Aucun'",
                              "duree_coupure_jours > 0 AND praticabilite_pluie LIKE '%toute ann%'"],
    "Services_Sociaux_Bases": [f"domaine_activite IS NOT NULL AND type_equipement NOT LIKE 'Autre%' AND domaine_activite NOT LIKE 'Autre%' AND lower(strip_accents({_DASH_PREFIX})) <> lower(strip_accents(domaine_activite))"],
    "Activites_autour_gare": ["type_culture IS NOT NULL AND coalesce(type_activite, '') NOT LIKE 'Agricult%'", "type_elevage IS NOT NULL AND coalesce(type_activite, '') NOT LIKE 'Pâturage%'"],
    "Ouvrage_franchissement": ["type_ouvrage IN ('PN gardé', 'Passage à niveau (PN) gardé') AND lower(presence_gardien) = 'non'",
                               "(type_ouvrage LIKE '%non gardé' OR type_ouvrage LIKE 'Passage informel%') AND dispositif_securite LIKE '%Gardien-barrières présent'",
                               "etat_ouvrage = 'Impraticable' AND necessite_rehab = 'Non nécessaire'"],
    "Gouvernance_Services_Securite": ["moyens_mobilite = 'Moto; Aucun moyen propre'", "source_energie_securite = 'Aucune; Solaire'"],
}
SECOND_SQL = {
    "Gares": ["NOT presence_magasin_gare AND type_magasin IS NOT NULL", "NOT presence_magasin_gare AND lower(capacite_stockage_gare) <> 'non applicable'",
              "presence_magasin_gare AND type_magasin IS NULL", "reseau_telecom ILIKE 'aucune%' AND operateur_telecom IS NOT NULL"],
    "Infrastructures_Ferroviaires": ["type_infra ILIKE 'passage%' AND quai_embarq"],
    "Points_Vente_Marches": ["NOT presence_magasin_stockage AND capacite_stockage <> 'Non applicable'", "NOT presence_aire_chargement AND type_aire_chargement IS NOT NULL",
                             "presence_aire_chargement AND type_aire_chargement IS NULL"],
    "Reseau_Routier_Pistes": ["pt_critique AND (type_blocage IS NULL OR lower(type_blocage) = 'aucun')", "NOT pt_critique AND lower(type_blocage) <> 'aucun'",
                              "praticabilite_pluie LIKE 'Accessible toute%' AND duree_coupure_jours > 0", "categorie_voie LIKE 'Route%' AND type_surface IN ('Terre', 'Sable')"],
    "Activites_autour_gare": ["type_culture IS NOT NULL AND (type_activite IS NULL OR type_activite NOT LIKE 'Agriculture%')", "type_elevage IS NOT NULL AND (type_activite IS NULL OR type_activite NOT LIKE 'Pâturage%')",
                              "traversee_betail LIKE 'Oui%' AND NOT point_traversee_informelle", "localisation_gare LIKE 'Dans%' AND distance_voie IN ('50–200 m', '> 200 m')"],
    "Ouvrage_franchissement": ["lower(presence_gardien) = 'non' AND dispositif_securite LIKE '%Gardien-barrières présent'", "presence_gardien LIKE 'Oui%' AND dispositif_securite = 'Aucun dispositif'",
                               "type_ouvrage = 'Passage à niveau (PN) gardé' AND lower(presence_gardien) = 'non'",
                               "statut_ouvrage LIKE 'Traversée%' AND type_ouvrage NOT IN ('Passage informel (traversée sauvage)', 'Autre (préciser)')"],
    "Ground_Truthing_LandCover": ["classe_reelle LIKE 'Forêt%' AND densite_couvert < 40", "classe_reelle LIKE 'Sol nu%' AND densite_couvert > 30"],
    "Services_Sociaux_Bases": ["contains(type_equipement, ' – ') AND domaine_activite IS NOT NULL AND type_equipement NOT LIKE 'Autre%' AND domaine_activite NOT LIKE 'Autre%' AND lower(strip_accents(split_part(type_equipement, ' – ', 1))) <> lower(strip_accents(domaine_activite))"],
}


# Severity, variable and message of each rule of the first pack, as they must come out.
FIRST_TEXTS = {
    "Gares": [
        ("error", "type_magasin", "Présence de magasin = Oui mais type de magasin non renseigné"),
        ("warning", "type_magasin", "Présence de magasin = Non mais un type de magasin est renseigné"),
        ("warning", "capacite_stockage_gare", "Pas de magasin mais capacité de stockage renseignée (autre que « Non applicable »)"),
    ],
    "Points_Vente_Marches": [
        ("warning", "capacite_stockage", "Pas de magasin de stockage mais capacité renseignée (autre que « Non applicable »)"),
        ("error", "capacite_stockage", "Magasin de stockage présent mais capacité absente"),
        ("error", "type_aire_chargement", "Aire de chargement présente mais type non renseigné"),
        ("warning", "type_aire_chargement", "Pas d'aire de chargement mais un type est renseigné"),
    ],
    "Reseau_Routier_Pistes": [
        ("error", "type_blocage", "Point critique = Oui mais aucun type de blocage"),
        ("warning", "type_blocage", "Point critique = Non mais un blocage est indiqué"),
        ("warning", "duree_coupure_jours", "Praticable toute l'année mais durée de coupure > 0"),
    ],
    "Services_Sociaux_Bases": [
        ("error", "type_equipement", "Le type d'équipement ne correspond pas au domaine d'activité"),
    ],
    "Activites_autour_gare": [
        ("warning", "type_culture", "Type de culture renseigné alors que l'activité n'est pas agricole"),
        ("warning", "type_elevage", "Type d'élevage renseigné alors que l'activité n'est pas pastorale"),
    ],
    "Ouvrage_franchissement": [
        ("warning", "presence_gardien", "Passage à niveau gardé mais gardien-barrières = Non"),
        ("warning", "dispositif_securite", "Passage à niveau non gardé/informel avec « gardien-barrières présent »"),
        ("warning", "etat_ouvrage", "Ouvrage « Impraticable » mais réhabilitation jugée non nécessaire"),
    ],
    "Gouvernance_Services_Securite": [
        ("warning", "moyens_mobilite", "« Aucun moyen propre » combiné avec d'autres moyens de mobilité"),
        ("warning", "source_energie_securite", "« Aucune » combinée avec d'autres sources d'énergie"),
    ],
}
# Code and message of each rule of the second pack; all are warnings without a variable.
SECOND_TEXTS = {
    "Gares": [
        ("L_MAG1", "Aucun magasin déclaré mais un type de magasin est renseigné"),
        ("L_MAG2", "Aucun magasin déclaré mais une capacité de stockage est renseignée"),
        ("L_MAG3", "Magasin présent sans type de magasin"),
        ("L_TEL", "« Aucune couverture » mais un opérateur est renseigné"),
    ],
    "Infrastructures_Ferroviaires": [
        ("L_PN", "Un passage à niveau ne devrait pas avoir de quai d'embarquement"),
    ],
    "Points_Vente_Marches": [
        ("L_STK1", "Pas de magasin de stockage mais capacité renseignée"),
        ("L_AIRE1", "Pas d'aire de chargement mais un type d'aire est renseigné"),
        ("L_AIRE2", "Aire de chargement présente sans type"),
    ],
    "Reseau_Routier_Pistes": [
        ("L_CRIT1", "Point critique = oui mais aucun blocage / obstacle indiqué"),
        ("L_CRIT2", "Blocage indiqué alors que point critique = non"),
        ("L_PRAT", "Accessible toute l'année mais coupures > 0 jour/an"),
        ("L_SURF", "Route nationale/régionale avec revêtement en terre/sable"),
    ],
    "Activites_autour_gare": [
        ("L_CULT", "Type de culture renseigné hors activité agricole"),
        ("L_ELEV", "Type d'élevage renseigné hors activité pastorale"),
        ("L_BETAIL", "Traversée de bétail déclarée mais pas de point de traversée informelle"),
        ("L_EMPRISE", "Localisation « dans l'emprise » incohérente avec la distance à la voie"),
    ],
    "Ouvrage_franchissement": [
        ("L_GARD1", "Gardien-barrières présent dans les dispositifs mais « Présence de gardien » = Non"),
        ("L_GARD2", "Gardien présent mais dispositif = « Aucun dispositif »"),
        ("L_PNG", "PN gardé sans gardien-barrières"),
        ("L_SAUV", "Traversée sauvage : le type d'ouvrage devrait être « Passage informel »"),
    ],
    "Ground_Truthing_LandCover": [
        ("L_FOR", "Forêt dense avec densité de couvert < 40 %"),
        ("L_SOL", "Sol nu avec densité de couvert > 30 %"),
    ],
    "Services_Sociaux_Bases": [
        ("L_EQ", "Type d'équipement incohérent avec le domaine d'activité"),
    ],
}


def _register(tag: str, pack: dict, layer: str, predicates: list[str], texts: list[tuple[str, str, str, str]]) -> None:
    quote = lambda t: t.replace("'", "''")
    oracle = " UNION ALL ".join(
        f"SELECT k, n, p, '{severity}' AS severity, '{code}' AS code, '{variable}' AS variable, '{quote(message)}' AS message FROM ({answers(layer)}) WHERE {p}"
        for (severity, code, variable, message), p in zip(texts, predicates, strict=True))

    @query(f"rules_{tag}_{layer.lower()}", oracle)
    def run(spark, sf):
        rows = derived(spark, sf, answers(layer), "lineitem")
        return evaluate_rules(rows, pack[layer], ["k", "n", "p"])


for _layer, _p in FIRST_SQL.items():
    _register("first", FIRST_PACK, _layer, _p, [(severity, "incoherence", variable, message) for severity, variable, message in FIRST_TEXTS[_layer]])
for _layer, _p in SECOND_SQL.items():
    _register("second", SECOND_PACK, _layer, _p, [("WARNING", code, "", message) for code, message in SECOND_TEXTS[_layer]])
