"""Hot keys: the salted and broadcast paths give what a plain join or window gives."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldlens.operators import distribution, spatial
from fieldlens.operators.duplicates import keep_first, repeated


def _rows(spark):
    return spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 0, None)
                                    .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"))


def test_attach_with_hot_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(distribution, "HOT_ROWS", 50)
    rows = _rows(spark)
    facts = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    got = {r.row: (r.key, r.n, r.first) for r in distribution.attach(rows, facts, ["key"], "n").collect()}
    want = rows.join(facts.filter("key is not null"), "key", "left").collect()
    assert got == {r.row: (r.key, r.n, r.first) for r in want} and len(got) == 3000
    assert distribution.attach(rows, facts, ["key"], "n", "inner").count() == rows.filter("key is not null").count()


def test_number_in_order(spark):
    rows = _rows(spark).filter("key is not null")
    w = Window.partitionBy("key").orderBy("row")
    want = {r.row: r.n for r in rows.withColumn("n", F.row_number().over(w)).collect()}
    assert {r.row: r.n for r in distribution.number_in_order(rows, [F.col("row")], ["key"]).collect()} == want
    assert [r.n for r in distribution.number_in_order(rows, [F.col("row")]).orderBy("row").collect()] == list(range(1, len(want) + 1))


def test_copies_of_a_hot_row(spark, monkeypatch):
    monkeypatch.setattr(distribution, "HOT_ROWS", 50)
    rows = _rows(spark)
    kept = {r.row for r in keep_first(rows, ["key"], ["row"]).filter("not is_copy").collect()}
    assert kept == {r.f for r in rows.groupBy("key").agg(F.min("row").alias("f")).collect()}
    assert repeated(rows, "key").filter("is_repeated").filter("key = 'hot'").count() == 1000


def test_distances_against_brute_force(spark):
    pts = spark.range(120).select(F.col("id").alias("k"), (F.pmod(F.col("id") * 37, F.lit(41)) * 2.3).alias("_e"),
                                  (F.pmod(F.col("id") * 53, F.lit(29)) * 3.1).alias("_n"))
    local = [(r.k, r._e, r._n) for r in pts.collect()]
    far = lambda a, b: ((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) ** 0.5
    near = {r.k: r.n_near for r in spatial.neighbours(pts, 6.0, ["k"], "k").collect()}
    assert near == {a[0]: c for a in local if (c := sum(far(a, b) <= 6 and a != b for b in local))}
    goals = pts.filter("k < 7")
    chosen = local[:7] if [x[0] for x in local[:7]] == list(range(7)) else [x for x in local if x[0] < 7]
    lone = {r.k for r in spatial.without_neighbour(pts, goals, 15.0).collect()}
    assert lone == {a[0] for a in local if all(far(a, b) > 15 for b in chosen)}
    nearest = {r.k: r.distance_m for r in spatial.nearest_distance(pts, goals, 2.0, 16).collect()}
    assert all(abs(nearest[a[0]] - min(far(a, b) for b in chosen)) < 1e-9 for a in local)
