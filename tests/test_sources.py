"""Files in, reports out: KML, shapefile and zip reading, a whole run, and the streaming jobs."""

import struct
import zipfile
from datetime import date

from fieldlens.operators.checks import Settings
from fieldlens.plans import run as runs
from fieldlens.sources import archive, kml, shapefile
from fieldlens.sources.dictionary import Layer, Variable
from fieldlens.streaming import landing

GARES = Layer("Gares", "Point", "id_fichegare", "nom_gare_detail", (
    Variable("id_fichegare", "Identifiant", required=True), Variable("nom_gare_detail", "Nom de la gare", required=True),
    Variable("type_gare", "Type de gare", values=("Principale", "Halte"))))

KML = """<?xml version="1.0"?><kml:kml xmlns:kml="http://www.opengis.net/kml/2.2"><kml:Document>
<kml:Placemark><kml:name>A &amp; B</kml:name><kml:ExtendedData><kml:Data name="id_fichegare"><kml:value>ZONE1GA1</kml:value></kml:Data>
<kml:Data name="type_gare"><kml:value/></kml:Data><kml:Data name="Nom de la gare"><kml:value>"Nord"</kml:value></kml:Data></kml:ExtendedData>
<kml:Point><kml:coordinates> 10.5, 4.25,7 </kml:coordinates></kml:Point></kml:Placemark>
<kml:Placemark><kml:ExtendedData><kml:SchemaData><kml:SimpleData name="id_fichegare">x</kml:SimpleData></kml:SchemaData></kml:ExtendedData>
<kml:MultiGeometry><kml:LineString><kml:coordinates>1,2 3,4</kml:coordinates></kml:LineString><kml:Point><kml:coordinates>bad</kml:coordinates></kml:Point></kml:MultiGeometry></kml:Placemark>
</kml:Document></kml:kml>"""


def _write(folder):
    (folder / "sub").mkdir(parents=True)
    (folder / "sub" / "Gares_lot1.kml").write_text(KML, encoding="utf-8")
    with zipfile.ZipFile(folder / "lot.zip", "w") as z:
        z.writestr("in/Gares_lot2.kml", KML)
        z.writestr("__MACOSX/Gares_lot2.kml", "x")
    (folder / "broken.zip").write_bytes(b"not a zip")
    (folder / "other.kml").write_text("<kml><Placemark><ExtendedData><Data name='zz'><value>1</value></Data></ExtendedData></Placemark></kml>")


def test_kml_edge_cases(spark, tmp_path):
    _write(tmp_path / "in")
    rows = kml.read_kml(spark, str(tmp_path / "in")).filter("_source = 'Gares_lot1.kml'").orderBy("_row_src").collect()
    assert [r["_row_src"] for r in rows] == [1, 2]
    assert rows[0]["placemark_name"] == "A & B" and rows[0]["attributes"]["id_fichegare"] == "ZONE1GA1"
    assert rows[0]["geom"]["parts"][0][0].asDict() == {"x": 10.5, "y": 4.25}
    assert rows[1]["attributes"]["id_fichegare"] == "x"
    assert rows[1]["geom"]["parts"] == [] and rows[1]["_multigeom"] == "True"


def test_archives(spark, tmp_path):
    _write(tmp_path / "in")
    rows = archive.read_archives(spark, str(tmp_path / "in")).select("member", "flat_name", "error").collect()
    assert sorted((r["member"] or "", (r["error"] or "")[:3]) for r in rows) == [("", "ZIP"), ("in/Gares_lot2.kml", "")]
    small = archive.expand_archives(spark.read.format("binaryFile").load(str(tmp_path / "in" / "lot.zip")), limit=10)
    assert small.collect()[0]["error"] == "Archive trop volumineuse"


def test_archives_are_opened_once(spark, tmp_path):
    _write(tmp_path / "in")
    with zipfile.ZipFile(tmp_path / "in" / "void [1].zip", "w"):
        pass
    read = lambda: archive.read_archives(spark, str(tmp_path / "in"), str(tmp_path / "store"))
    first = {(r["archive"].split("/")[-1], r["update"]) for r in read().collect()}
    assert len({u for _, u in first}) == 1 and {a for a, _ in first} == {"lot.zip", "broken.zip", "void [1].zip"}
    assert {(r["archive"].split("/")[-1], r["update"]) for r in read().collect()} == first  # nothing new: no update
    with zipfile.ZipFile(tmp_path / "in" / "lot.zip", "w") as z:
        z.writestr("in/Gares_lot3.kml", KML + " ")
    with zipfile.ZipFile(tmp_path / "in" / "new {a,b}.zip", "w") as z:
        z.writestr("x.kml", KML)
    rows = read().collect()
    now = {r["archive"].split("/")[-1]: r["update"] for r in rows}
    old = {u for _, u in first}
    assert {a for a, u in now.items() if u not in old} == {"lot.zip", "new {a,b}.zip"} and len(now) == 4
    assert [r["member"] for r in rows if r["archive"].endswith("lot.zip")] == ["in/Gares_lot3.kml"]


def test_values_names_and_encodings_stay(spark, tmp_path):
    body = ('<kml:Placemark><kml:name><![CDATA[A & B]]> &#233;</kml:name><kml:ExtendedData><kml:Data k:x="1" name="note"><kml:value>voir ref:code=12 xmlns:a="b"</kml:value>'
            '</kml:Data></kml:ExtendedData></kml:Placemark>')
    (tmp_path / "latin.kml").write_bytes(f'<?xml version="1.0" encoding="ISO-8859-1"?><kml:kml>{body.replace("voir", "Garé")}</kml:kml>'.encode("latin-1"))
    (tmp_path / "utf.kml").write_text(f"<kml:kml>{body}</kml:kml>", encoding="utf-8")
    rows = {r["_source"]: r for r in kml.read_kml(spark, str(tmp_path)).collect()}
    assert rows["utf.kml"]["attributes"] == {"note": 'voir ref:code=12 xmlns:a="b"'} and rows["utf.kml"]["placemark_name"] == "A & B é"
    assert rows["latin.kml"]["attributes"]["note"].startswith("Garé ref:code=12")


def test_every_file_is_in_the_journal(spark, tmp_path):
    _write(tmp_path / "in")
    (tmp_path / "in" / "empty.kml").write_text("<kml/>")
    order = "".join(f"<Data name='{n}'><value>1</value></Data>" for n in ("zz", "b", "Obs", "obs", "a"))
    (tmp_path / "in" / "gares_cols.kml").write_text(f"<kml><Placemark><ExtendedData>{order}</ExtendedData></Placemark></kml>")
    schemas = runs.file_schemas(runs.read_folder(spark, str(tmp_path / "in")))
    files = {r["_source"]: r for r in schemas.collect()}
    assert {"empty.kml", "broken.zip", "other.kml", "Gares_lot1.kml", "Gares_lot2.kml"} <= set(files)
    assert files["broken.zip"]["error"].startswith("ZIP") and files["empty.kml"]["n_entites"] == 0
    assert [c for c in files["gares_cols.kml"]["columns"] if c != "placemark_name"] == ["zz", "b", "Obs", "obs", "a"]


def test_shapefile(spark, tmp_path):
    point = struct.pack("<i2d", 1, 500000.0, 442000.0)
    shp = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 64) + bytes(72) + struct.pack(">2i", 1, len(point) // 2) + point
    field = lambda n: n.ljust(11, b"\0") + b"C" + bytes(4) + bytes([10]) + bytes(15)
    dbf = struct.pack("<4BiHH", 3, 24, 1, 1, 1, 32 + 64 + 1, 21) + bytes(20) + field(b"nom") + field(b"nom") + b"\r" + b" " + "Gar\xe9".encode("latin-1").ljust(10) + b"b".ljust(10)
    for ext, data in (("shp", shp), ("dbf", dbf), ("prj", b'PROJCS["WGS_1984_UTM_Zone_33N",GEOGCS["GCS_WGS_1984"]]')):
        (tmp_path / f"a.{ext}").write_bytes(data)
    row = shapefile.read_shapefiles(spark, str(tmp_path)).collect()[0]
    assert row["attributes"] == {"nom": "Garé", "nom.1": "b"} and row["error"] is None
    p = row["geom"]["parts"][0][0]
    assert abs(p["x"] - 15.0) < 1e-9 and abs(p["y"] - 3.99879) < 1e-3


def test_run_and_export(spark, tmp_path):
    _write(tmp_path / "in")
    settings = Settings(run_date=date(2024, 6, 1))
    result = runs.run(spark, str(tmp_path / "in"), {"Gares": GARES}, settings)
    assert result.failures == {} and result.rows.count() == 4
    status = {r["fichier"]: r["statut"] for r in result.journal.collect()}
    assert status["other.kml"] == "NON RECONNU" and status["Gares_lot1.kml"].startswith("OK")
    kinds = {r["type"] for r in result.issues.select("type").distinct().collect()}
    assert {"doublon_exact", "geometrie_vide", "champ_obligatoire_vide"} <= kinds
    summary = runs.export(result, {"Gares": GARES}, str(tmp_path / "out"), settings.run_date)
    assert summary.collect()[0]["entites"] == 4
    text = "".join(r["value"] for r in spark.read.text(str(tmp_path / "out" / "run_date=2024-06-01" / "donnees_brutes" / "kml" / "Gares")).collect())
    assert text.count("<Placemark>") == 2


def test_streams(spark, tmp_path):
    _write(tmp_path / "in")
    features = landing.feature_stream(landing.file_stream(spark, str(tmp_path / "in")))
    rows = kml.attribute_columns(features, ["id_fichegare"])
    landing.check_arrivals(rows, GARES, Settings(run_date=date(2024, 6, 1)), str(tmp_path / "issues"), str(tmp_path / "ck1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "issues")).filter("type = 'geometrie_vide'").count() >= 1
