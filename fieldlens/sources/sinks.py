"""Exports: flat raw data, name-mapped CSV, KML, report tables, per-agent corrections and the daily history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.functions.text import dbf_names, file_safe, strip_control
from fieldlens.operators import report
from fieldlens.sources.kml import write_kml

INTERNAL = ("_fmt", "_file_date", "_multigeom", "_crs_assumed", "_path")


def _clean(c: Column) -> Column:
    return strip_control(c.cast("string"))


def flat_raw(df: DataFrame) -> DataFrame:
    """Raw rows for export: internal columns dropped, provenance named, empty geometry null."""
    cols = []
    for c in df.columns:
        if c in INTERNAL or c == "geom":
            continue
        name = {"_source": "fichier_source", "_row_src": "ligne_source"}.get(c, "fid_source" if c.lower() == "fid" else c)
        cols.append(F.col(f"`{c}`").cast("long").alias(name) if c == "_row_src" else _clean(F.col(f"`{c}`")).alias(name))
    geometry = [F.when(~geo.is_empty(F.col("geom")), F.col("geom")).alias("geom")] if "geom" in df.columns else []
    return df.select(*cols, *geometry)


def write_raw_tables(frames: dict[str, DataFrame], path: str) -> None:
    """One Parquet table per layer under ``couche=<layer>``, geometry as well-known text."""
    for layer, df in frames.items():
        flat = flat_raw(df)
        flat.withColumn("geom", geo.wkt(F.col("geom"))).write.mode("overwrite").parquet(f"{path}/couche={layer}")


def name_mapping(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame(list(dbf_names(columns).items()), "champ_complet string, champ_shp string")


def write_short_named_csv(df: DataFrame, layer: str, path: str) -> None:
    """CSV with 10-character column names and the mapping to the full names."""
    flat = flat_raw(df).withColumn("geom", geo.wkt(F.col("geom")))
    names = [c for c in flat.columns if c != "geom"]
    short = dbf_names(names)
    flat.select(*[F.col(f"`{c}`").alias(short[c]) for c in names], "geom") \
        .write.mode("overwrite").option("header", True).csv(f"{path}/{layer}")
    name_mapping(df.sparkSession, names).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/{layer}_champs")


def write_kml_layers(frames: dict[str, DataFrame], ids: dict[str, str], path: str) -> None:
    for layer, df in frames.items():
        write_kml(flat_raw(df), layer, ids[layer], f"{path}/{layer}")


def report_tables(rows: DataFrame, issues: DataFrame, journal: DataFrame, run_date: date) -> dict[str, DataFrame]:
    summary = report.quality_summary(rows, run_date)
    return {
        "lisez_moi": report.guide(summary, run_date), "synthese": summary, "plan_action": report.action_plan(issues),
        "a_traiter": report.to_treat(rows), "doublons": report.duplicate_list(rows),
        "champs_vides": report.empty_required(rows, issues), "par_agent": report.agent_workload(rows),
        "couverture_zones": report.coverage_long(rows), "anomalies": report.anomalies(issues), "journal_fichiers": journal,
    }


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_corrections(issues: DataFrame, path: str) -> None:
    """Issues per agent, one folder each; the rows of a busy agent stay spread over several files."""
    # Rows of an agent meet in few tasks before the write; those of a busy one are split again.
    report.anomalies(issues.filter("agent is not null")).withColumn("agent_fichier", file_safe(F.col("agent"))) \
        .hint("rebalance", F.col("agent_fichier")).write.mode("overwrite").partitionBy("agent_fichier").parquet(path)


def upsert_history(today: DataFrame, path: str) -> None:
    """Replace the day's partition of the history table, keep the other days."""
    today.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_execution").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("date_execution", F.col("date_execution").cast("string"))


def run_folder(base: str, run_date: date) -> str:
    """Dated folder of a run; readers that want the newest take the greatest date."""
    return f"{base}/run_date={run_date.isoformat()}"
