"""Column functions against Python and published references."""

import unicodedata

from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.functions import text as tx
from fieldlens.functions import values as vl
from fieldlens.functions.steps import in_steps


def _map(spark, values, kind, **columns):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return in_steps(df, {k: (F.col("v"), s) for k, s in columns.items()}).collect()


def test_folding_over_the_bmp(spark):
    chars = [f"x{chr(c)}y" for c in range(32, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    for r in _map(spark, chars, "string", f=tx.FOLD_STEPS, k=tx.VALUE_KEY_STEPS):
        text = r.v
        for a, b in tx.ASCII_SUBSTITUTES.items():
            text = text.replace(a, b)
        assert r.f == unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
        assert r.k == tx.plain_value_key(r.v)


def test_phrase_keys(spark):
    values = ["50–200 m", "  Éle vage — x ", "l’été", "4×4", "Œuvre", "ﬁn ½"]
    for r in _map(spark, values, "string", k=tx.PHRASE_KEY_STEPS):
        assert r.k == tx.plain_phrase_key(r.v)


def test_cleaning(spark):
    got = {r.v: r.c for r in _map(spark, ['"Bitume"', " a   b ", "N/A", '"none"', '"', '""', "-- Sélectionnez une valeur --"],
                                  "string", c=tx.CLEAN_STEPS)}
    assert list(got.values()) == ["Bitume", "a b", None, None, '"', None, None]


def test_numbers_as_python_writes_them(spark):
    values = [1250.5, 0.0, 1e6, 999999.5, 1234567.0, -3.25, 1e-5, 0.0001234, 68423.45, 12345.25, 12345.75, 1e7, 1e15, 1e16, 1.5e20, 2.5e-10]
    df = in_steps(spark.createDataFrame([(v,) for v in values], "v double"), {"g": (F.col("v"), vl.GENERAL_STEPS)})
    for r in df.withColumn("t", vl.double_text(F.col("v"))).collect():
        assert r.g == f"{r.v:g}" and r.t == str(r.v)


def test_number_text(spark):
    got = [r.n for r in _map(spark, ["1 250,5", "abc", "1d", "NaN", "1_000", "+.5", "1e400", "Infinity"], "string", n=vl.NUMBER_STEPS)]
    assert got == [1250.5, None, None, None, 1000.0, 0.5, None, None]


def test_dates(spark):
    got = {r.v: r.d and r.d.isoformat() for r in _map(spark, [
        "2024-01-05", "20240105", "2024-01-05T10:00:05Z", "5/4/2024", "4/13/2024", "13/14/2024", "3 Mar 2024", "March 3, 2024", "x", "31/02/2024"],
        "string", d=vl.DATE_STEPS)}
    assert list(got.values()) == ["2024-01-05T00:00:00", "2024-01-05T00:00:00", "2024-01-05T10:00:05", "2024-04-05T00:00:00",
                                  "2024-04-13T00:00:00", None, "2024-03-03T00:00:00", "2024-03-03T00:00:00", None, None]


def test_multiselect(spark):
    values = ["Gestion de foules (marchés, gares)", "Autre", "Eau"]
    df = spark.createDataFrame([("Gestion de foules (marchés, gares), Autre",), ("Eau; Eau",)], "v string")
    a, b = (r.s for r in df.select(tx.split_known_values(F.col("v"), values).alias("s")).collect())
    assert (a.found, a.rest) == (values[:2], "") and (b.found, b.rest) == (["Eau"], "eau")


def test_utm_control_point_and_inverse(spark):
    df = geo.with_utm(spark.createDataFrame([(-79.387139, 43.642567)], "x double, y double"), "x", "y", 17)
    back = df.withColumn("p", geo.utm_to_lonlat(F.col("_e"), F.col("_n"), F.lit(17), F.lit(False))).first()
    assert abs(back._e - 630084) < 1.5 and abs(back._n - 4833438) < 1.5
    assert abs(back.p.x + 79.387139) < 1e-8 and abs(back.p.y - 43.642567) < 1e-8


def test_dbf_names():
    assert tx.dbf_names(["type_marchandise", "type_marche", "TYPE_MARCHX"]) == {
        "type_marchandise": "type_march", "type_marche": "type_mar_1", "TYPE_MARCHX": "TYPE_MAR_2"}
