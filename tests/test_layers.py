"""Golden rows for both packs and the repair mode."""

from datetime import date

from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.operators import repair
from fieldlens.operators.checks import Settings
from fieldlens.plans import layer_qa_second as second
from fieldlens.plans.layer_qa import check_layer
from fieldlens.sources.dictionary import Layer, Variable, column_lookup

GARES = Layer("Gares", "Point", "id_fichegare", "nom_gare_detail", (
    Variable("id_fichegare", "Identifiant", required=True, level="E"), Variable("nom_gare_detail", "Nom de la gare", required=True, level="W"),
    Variable("type_gare", "Type de gare", required=True, values=("Gare principale", "Halte")),
    Variable("presence_magasin_gare", "Présence de magasin", type="boolean"), Variable("type_magasin", "Type de magasin"),
    Variable("capacite_stockage_gare", "Capacité"), Variable("reseau_telecom", "Réseau"),
    Variable("operateur_telecom", "Opérateur", type="multiselect", values=("MTN", "Orange", "Aucun opérateur")),
    Variable("effectif", "Effectif", type="integer", low=0, high=100)))
SCHEMA = ("_rid long, id_fichegare string, nom_gare_detail string, type_gare string, presence_magasin_gare string, type_magasin string, "
          "operateur_telecom string, effectif string, x double, y double")
ROWS = [
    (1, "ZONE1GA1", "A", "gare principale", "oui", None, "MTN; Orange", "5", 10.0, 5.0),
    (2, "ZONE1GA1", "A", "gare principale", "oui", None, "MTN; Orange", "5.0", 10.0, 5.0),
    (3, "ZONE1GA3", "B", "Halté", "non", "Autre", "MTN, Foo", "1 250,5", 0.0, 0.0),
    (4, "zone1GA4", None, None, "peut-être", None, "Aucun operateur; MTN", "3.5", 5.0, 10.0),
    (5, "ZONE1GA5", "C", "Hlate", "x", "Autre", None, None, 10.1, 5.0),
    (6, "ZONE2GA5", "C", "Halte", "non", None, None, None, 10.2, 5.0),
    (7, None, None, "Halte", None, None, None, None, None, None),
]


def _raw(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"capacite_stockage_gare": F.lit(None).cast("string"), "reseau_telecom": F.lit(None).cast("string")})
    return df.select("*", geo.point(F.col("x"), F.col("y")).alias("geom"), F.lit("ZONE1").alias("zone")).drop("x", "y")


def test_first_pack(spark):
    raw = _raw(spark).drop("zone").withColumnRenamed("_rid", "_row_src").withColumns(
        {"_path": F.lit("/a/f.kml"), "_source": F.lit("f.kml"), "_fmt": F.lit("kml"), "_file_date": F.lit(date(2024, 1, 1))})
    check = check_layer(raw, GARES, Settings(run_date=date(2024, 6, 1)), reuse=True)
    rows = {r.ligne_source: r for r in check.rows.collect()}
    assert len(rows) == 7
    assert (rows[1].statut, rows[1].nature_doublon, rows[1].recommandation_doublon[:9]) == ("À corriger", "exact", "Conserver")
    assert rows[2].problemes.startswith("Copie identique de la ligne 1 de « f.kml »")
    assert "« Effectif » = 1250.5 supérieur au maximum plausible (100)" in rows[3].problemes
    issues = check.issues.collect()
    assert sum(i.type == "hors_emprise" and i.ligne == 3 for i in issues) == 2
    for n, r in rows.items():
        assert r.n_err == sum(i.severity == "error" and i.ligne == n for i in issues)
        assert r.n_warn == sum(i.severity == "warning" and i.ligne == n for i in issues)


def test_second_pack_and_status(spark):
    df = _raw(spark)
    issues = second.check_all_second({"Gares": df}, {"Gares": GARES}).cache()
    found = {(r._rid, r.rule) for r in issues.collect()}
    for expected in [(1, "DOM_CASE"), (1, "L_MAG3"), (1, "ID_DUP"), (2, "ID_DUP"), (1, "GEOM_DUP"), (2, "GEOM_DUP"), (3, "GEOM_ZERO"), (3, "DOM_CASE"),
                     (3, "DOM_INVALID"), (3, "L_MAG1"), (4, "ID_FORMAT"), (4, "REQ_MISSING"), (4, "TYPE_INVALID"), (4, "TYPE_DECIMAL"), (4, "MULTI_EXCL"),
                     (5, "DOM_INVALID"), (6, "ID_ZONE"), (7, "GEOM_NULL"), (7, "ID_MISSING"), (None, "ID_GAP")]:
        assert expected in found, expected
    hint = issues.filter("_rid = 5 and rule = 'DOM_INVALID'").first()
    assert hint.suggestion == "Proche de : Halte"
    status = {r._rid: r.qa_status for r in second.apply_status(df, "Gares", issues).collect()}
    assert status[1] == "ERROR" and status[6] == "ERROR"


def test_repair(spark):
    done = repair.repair_layer(_raw(spark), GARES)
    rows = {r._rid: r for r in done.rows.collect()}
    counts = {r.mesure: r.nombre for r in done.counts.collect()}
    assert counts == {"recues": 7, "valeurs_normalisees": 5, "identifiants_changes": 2, "renumerotations": 1, "sans_geometrie": 1, "doublons_stricts": 1, "conservees": 5}
    assert {(r._rid, r.reject_reason[:7]) for r in done.rejects.collect()} == {(7, "Géométr"), (2, "Doublon")}
    assert (rows[4].lon, rows[4].lat) == (10.0, 5.0)              # exchanged back
    assert rows[3].type_gare == "Halte" and rows[5].presence_magasin_gare is True
    assert rows[4].id_fichegare == "ZONE1GA4" and rows[6].id_fichegare == "ZONE1GA6" and rows[6].id_orig == "ZONE2GA5"
    assert rows[4].effectif == 4 and rows[4].operateur_telecom == "Aucun opérateur; MTN"


def test_column_names():
    layer = Layer("L", "Point", "id_troncon", None, (Variable("id_troncon", "Identifiant"), Variable("type_marche", "Type"), Variable("type_marchandise", "Marchandise")))
    lookup = column_lookup(layer)
    assert [lookup.match(c) for c in ("ID TRONÇON", "id_trocon", "type_march", "Marchandis", "xx")] == ["id_troncon", "id_troncon", None, "type_marchandise", None]
    assert lookup.ambiguous == {"type_march"}
