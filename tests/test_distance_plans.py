"""No side of a distance join that grows with the rows passes through the driver."""

from pyspark.sql import functions as F

from fieldlens.operators import spatial


def test_distance_joins_are_not_broadcast(spark, monkeypatch):
    plans = []
    keep = spatial.durable

    def durable(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    monkeypatch.setattr(spatial, "durable", durable)
    source = spark.range(40).select("id", (F.col("id") * 700.0).alias("_e"), (F.col("id") % 7 * 900.0).alias("_n"))
    target = spark.range(20).select((F.col("id") * 1400.0 + 30).alias("_e"), (F.col("id") % 5 * 1300.0).alias("_n"))
    got = spatial.nearest_distance(source, target)
    lone = spatial.without_neighbour(source, target, 500.0)
    near = {r["id"]: r["distance_m"] for r in got.collect()}
    goals = [(r["_e"], r["_n"]) for r in target.collect()]
    want = {r["id"]: min(((r["_e"] - e) ** 2 + (r["_n"] - n) ** 2) ** 0.5 for e, n in goals) for r in source.collect()}
    assert near.keys() == want.keys() and all(abs(near[k] - want[k]) < 1e-6 for k in want)
    assert {r["id"] for r in lone.collect()} == {k for k, d in want.items() if d > 500}
    assert plans and not any("BroadcastHashJoin" in p for p in plans)
