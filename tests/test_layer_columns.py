"""Columns of a layer: those asked for come alone, in the order and spelling of all."""

from fieldlens.plans import run


def test_columns_asked_for(spark):
    files = spark.createDataFrame([("L", f"/f{i:04}", [f"own_{i}", "id", "obs"], [f"Own_{i}", "id", "Obs"]) for i in range(300)] + [
        ("M", "/m", ["id"], ["ID"])], "layer string, _path string, keys array<string>, names array<string>")
    every = run.layer_columns(files)
    assert len(every["L"]) == 302 and every["M"] == ["ID"]
    shown = run.layer_columns(files, ["OBS", "id", "Own_7", "gone"])
    assert shown == {"L": [n for n in every["L"] if n in ("id", "Obs", "Own_7")], "M": ["ID"]}
    features = spark.createDataFrame([("/f0007", {"Own_7": "x", "ID": "1", "remark": "r"}, ["Own_7", "ID", "remark"], ["own_7", "id", "obs"])],
                                     "_path string, attributes map<string,string>, columns array<string>, keys array<string>")
    features = features.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in run.META if c != "_path"])
    got = run.aligned_layer(features, shown["L"]).select(*shown["L"]).first().asDict()
    assert got == {"Own_7": "x", "id": "1", "Obs": "r"}
