"""Spark session for local runs; on a cluster the submitted configuration is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: str | int = 8, name: str = "fieldlens", memory: str = "8g") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
             .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
             .config("spark.driver.memory", memory)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
