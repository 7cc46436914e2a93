"""Files cut into many splits against whole files, long values, encodings and odd tags."""

import random

import pytest
from pyspark.sql import functions as F

from fieldlens.sources import kml


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _whole(spark, path):
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("_path"), kml.decoded(F.col("content")).alias("value"))
    return kml.parse_placemarks(kml.placemarks(files, "value", ["_path"]))


def _rows(df):
    picked = df.select("_path", "_row_src", "placemark_name", "attributes", "geom", "_multigeom").collect()
    return sorted(((r._path, r._row_src, r.placemark_name, sorted(r.attributes.items()), str(r.geom), r._multigeom) for r in picked))


def _document(rng, n, prefix=""):
    p, out = prefix, []
    for i in range(n):
        kind = rng.randrange(6)
        if kind == 0:
            out.append(f'<{p}Placemark id="s{i}"/>' if i % 2 else f"<{p}Placemark/>")
        if kind == 1:
            out.append(f"<{p}Folder><{p}name>dossier {i}</{p}name></{p}Folder>")
        opening = f'<{p}Placemark id="p/{i}" {p}x="a>b">'.replace("a>b", "ab") if kind in (2, 3) else f"<{p}Placemark>"
        out.append(f"{opening}<{p}name>é{i}</{p}name><{p}ExtendedData><{p}Data {p}q=\"1\" name=\"v\"><{p}value>{'x' * rng.randrange(300)} ref:n=\"{i}\"</{p}value></{p}Data>"
                   f"</{p}ExtendedData><{p}Point><{p}coordinates>{i},2</{p}coordinates></{p}Point></{p}Placemark>")
    ns = f' xmlns:{p[:-1]}="http://www.opengis.net/kml/2.2"' if p else ""
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<{p}kml{ns}><{p}Document>{"".join(out)}</{p}Document></{p}kml>'


def test_splits_give_the_rows_of_the_whole_file(spark, tmp_path, small_splits):
    rng = random.Random(4)
    for name, n, prefix in (("a", 120, ""), ("b + c%20[1]", 90, "kml:"), ("none", 0, ""), ("one", 1, "")):
        (tmp_path / f"{name}.kml").write_text(_document(rng, n, prefix), encoding="utf-8")
    (tmp_path / "wide.kml").write_bytes(_document(rng, 5).replace("UTF-8", "UTF-16").encode("utf-16"))
    found, _ = kml.split_placemarks(spark, str(tmp_path))
    assert found.count() > 200 and spark.read.option("lineSep", "Placemark>").text(str(tmp_path)).rdd.getNumPartitions() > 8
    got = kml.read_kml(spark, str(tmp_path))
    assert _rows(got) == _rows(_whole(spark, str(tmp_path)))
    none = kml.read_kml(spark, str(tmp_path), empty=True).filter("_row_src is null").collect()
    assert sorted(r["_source"] for r in none) == ["none.kml"] and all(r["_file_date"] for r in none)


@pytest.mark.parametrize("value", ['see x:y="b" ' + "z" * 1_000_000, 'a:b="c" ' * 100_000, "it's <![CDATA[" + "<i>" * 50_000 + "]]>", '"' * 300_001])
def test_long_values(spark, tmp_path, value):
    (tmp_path / "a.kml").write_text(f"<k:kml><k:Placemark><k:name>n</k:name><k:ExtendedData><k:Data name='v'><k:value>{value}</k:value></k:Data>"
                                    "</k:ExtendedData></k:Placemark></k:kml>")
    want = value.replace("<![CDATA[", "").replace("]]>", "")
    for row in (kml.read_kml(spark, str(tmp_path)).collect(), _whole(spark, str(tmp_path)).collect()):
        assert row[0]["attributes"] == {"v": want} and row[0]["placemark_name"] == "n"


def test_encodings(spark, tmp_path, small_splits):
    body = "<Placemark><name>l’été € 5</name></Placemark>" * 40
    for enc, codec in (("windows-1252", "cp1252"), ("UTF-8", "utf-8"), ("x-none", "utf-8"), ("cp1250", "cp1250")):
        (tmp_path / f"{enc}.kml").write_bytes(f'<?xml version="1.0" encoding="{enc}"?><kml>{body.replace("é", "e") if enc == "cp1250" else body}</kml>'.encode(codec))
    (tmp_path / "iso.kml").write_bytes(f'<?xml version="1.0" encoding="ISO-8859-15"?><kml>{body.replace("’", "_")}</kml>'.encode("iso-8859-15"))
    (tmp_path / "bom.kml").write_bytes(b"\xef\xbb\xbf" + f"<kml>{body}</kml>".encode())
    rows = kml.read_kml(spark, str(tmp_path), empty=True).groupBy("_source", "placemark_name", "_encoding").count().collect()
    got = {r["_source"]: (r["placemark_name"], r["_encoding"], r["count"]) for r in rows}
    name = "l’été € 5"
    assert got == {"windows-1252.kml": (name, None, 40), "UTF-8.kml": (name, None, 40), "bom.kml": (name, None, 40), "iso.kml": ("l_été € 5", None, 40),
                   "cp1250.kml": ("l’ete € 5", None, 40), "x-none.kml": (None, "x-none", 1)}
    whole = spark.read.format("binaryFile").load(str(tmp_path)).select("path", kml.decoded(F.col("content")).alias("t")).collect()
    assert {r.path.split("/")[-1] for r in whole if r.t is None} == {"x-none.kml"} and sum("€ 5" in (r.t or "") for r in whole) == 5
