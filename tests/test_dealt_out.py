"""Rows of a file of one row group reach all tasks before the work on them begins."""

from pyspark.sql import functions as F

from fieldlens.plans.bindings import layer_queries, line_queries, registry, source_queries


def test_all_tasks_get_rows(spark, tmp_path, monkeypatch):
    spark.range(400).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("Customer#"), "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        F.lit("BUILDING").alias("c_mktsegment"), (F.col("id") * 1.5).alias("c_acctbal")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = registry.table(spark, str(tmp_path), "customer")
    assert read.rdd.getNumPartitions() == 1 and registry.dealt_out(read).exceptAll(read).count() == 0
    at = []
    keep = line_queries.shaped
    monkeypatch.setattr(line_queries, "shaped", lambda df: at.append(df) or keep(df))
    line_queries.repaired_lines(spark, str(tmp_path))
    for df in (layer_queries.survey(spark, str(tmp_path)), source_queries.kml_round_trip(spark, str(tmp_path)), *at):
        got = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(got) == parts and max(r["count"] for r in got) < 2 * sum(r["count"] for r in got) / parts
