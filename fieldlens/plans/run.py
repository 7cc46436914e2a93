"""A whole run: read the received files, recognise layers, union raw rows, check, report, export."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators import align, report
from fieldlens.operators.checks import Settings
from fieldlens.operators.distribution import shared_path, staged
from fieldlens.plans.layer_qa import LayerCheck, check_layer, unchecked_rows
from fieldlens.sources import kml, shapefile, sinks
from fieldlens.sources.archive import archive_errors, member_kind, read_archives
from fieldlens.sources.dictionary import Layer

META = ["_path", "_source", "_file_date", "_row_src", "_fmt", "_multigeom", "_crs_assumed", "geom"]


@dataclass
class RunResult:
    raw: dict[str, DataFrame]
    checks: dict[str, LayerCheck]
    journal: DataFrame
    rows: DataFrame | None
    issues: DataFrame | None
    failures: dict[str, str]


def read_folder(spark: SparkSession, folder: str, store: str | None = None) -> DataFrame:
    """Features of every KML file, shapefile and zip member below a folder, attributes still as a map.

    With a ``store`` an archive is opened only in the first run that meets it. A file without features and an archive that can't be read give one row with ``error``."""
    loose = kml.read_kml(spark, folder, empty=True)
    shapes = shapefile.read_shapefiles(spark, folder)
    unpacked = read_archives(spark, folder, store or shared_path(spark, "members"))
    members, broken = member_kind(unpacked), archive_errors(unpacked)
    zipped_kml = members.filter("ext = 'kml'").select(
        F.col("path").alias("_path"), F.col("file_date").alias("_file_date"), kml.decoded(F.col("content")).alias("value"))
    zipped = kml.parse_placemarks(kml.placemarks(zipped_kml.withColumn("_encoding", F.when(F.col("value").isNull(), "")), "value", [
        "_path", "_file_date", "_encoding"], empty=True)).withColumns({"_fmt": F.lit("kml"), "_crs_assumed": F.lit(False)})
    zipped_shapes = shapefile.to_wgs84(shapefile.decode_groups(members.select("path", "content", "file_date"))) \
        .withColumn("_fmt", F.lit("shp"))
    frames = []
    for df in (loose, zipped):
        named = F.map_from_arrays(F.array(F.lit("placemark_name")), F.array("placemark_name"))
        frames.append(df.withColumn("attributes", F.map_concat(
            named, F.map_filter("attributes", lambda k, v: k != "placemark_name"))).withColumn(
                "error", F.when(F.col("_encoding").isNotNull(), F.concat_ws(" ", F.lit("Encodage inconnu"), F.nullif("_encoding", F.lit(""))))
                .when(F.col("_row_src").isNull(), "Aucun élément")))
    for df in (shapes, zipped_shapes):
        frames.append(df.withColumn("_multigeom", F.lit(None).cast("string")))
    columns = ["_path", "_file_date", "_row_src", "_fmt", "_multigeom", "_crs_assumed", "geom", "attributes", "error"]
    frames.append(frames[0].filter("false").select(*columns).unionByName(
        broken.select(F.col("path").alias("_path"), F.lit("zip").alias("_fmt"), "error"), allowMissingColumns=True))
    out = reduce(lambda a, b: a.unionByName(b), [f.select(*columns) for f in frames])
    return out.withColumn("_source", F.regexp_extract("_path", r"([^/!]*)$", 1))


def file_schemas(features: DataFrame) -> DataFrame:
    """Per file: entities, attribute names in the order of the file, geometry types, error. Names are bounded by a file's width."""
    met = features.filter("error is null").select("_path", "_row_src", F.posexplode(F.map_keys("attributes")).alias("at", "name"))
    names = met.groupBy("_path", "name").agg(F.min(F.struct("_row_src", "at")).alias("first")) \
        .groupBy("_path").agg(F.array_sort(F.collect_list(F.struct("first", "name"))).alias("named")) \
        .select("_path", F.col("named.name").alias("columns"))
    files = features.groupBy("_path", "_source").agg(
        F.count_if(F.col("error").isNull()).alias("n_entites"), F.collect_set("geom.gtype").alias("gtypes"),
        F.max("error").alias("error"), F.bool_or("_crs_assumed").alias("crs_assumed"))
    return files.join(names, "_path", "left").withColumn("columns", F.coalesce("columns", F.array().cast("array<string>")))


def recognise_files(schemas: DataFrame, layers: dict[str, Layer]) -> DataFrame:
    """Layer per file from its name, its columns and its geometry types."""
    listed = list(layers.values())
    columns = schemas.select(F.col("_path").alias("file"), F.explode_outer("columns").alias("column"))
    matches = align.match_names(columns, listed).select("file", "layer", "variable")
    files = schemas.select(F.col("_path").alias("file"), F.col("_source").alias("name"), "gtypes")
    return align.recognise(files, matches, listed).select(F.col("file").alias("_path"), "layer")


def layout_table(known: DataFrame, layers: dict[str, Layer]) -> DataFrame:
    """Per layer and list of columns: the aligned names, their keys without regard to case, absent variables and ambiguous columns."""
    def look_up(batches):
        for batch in batches:
            met = [(name, list(columns), align.aligned_names(list(columns), layers[name]), align.absent_variables(list(columns), layers[name]),
                    align.ambiguous_names(list(columns), layers[name])) for name, columns in zip(batch["layer"], batch["columns"])]
            yield pd.DataFrame([(n, c, a, [x.lower() for x in a], gone, two) for n, c, a, gone, two in met],
                               columns=["layer", "columns", "names", "keys", "absent", "ambiguous"])

    return known.filter("layer is not null").select("layer", "columns").distinct().mapInPandas(
        look_up, "layer string, columns array<string>, names array<string>, keys array<string>, absent array<string>, ambiguous array<string>")


def layer_columns(files: DataFrame, only: list[str] | None = None) -> dict[str, list[str]]:
    """Column names of every layer, in the order in which files bring them up; one row per column reaches the driver, which the table's schema needs.

    With ``only`` the names of these columns, without regard to case: as many rows as are asked for, however many columns files have of their own."""
    met = files.select("layer", "_path", F.posexplode(F.arrays_zip("keys", "names")).alias("at", "n"))
    if only is not None:
        met = met.filter(F.col("n.keys").isin([n.lower() for n in only]))
    met = met.groupBy("layer", "n.keys").agg(F.min(F.struct("_path", "at", "n.names")).alias("first"))
    out: dict[str, list[str]] = {}
    for r in met.orderBy("layer", "first").select("layer", "first.names").collect():
        out.setdefault(r["layer"], []).append(r["names"])
    return out


def aligned_layer(features: DataFrame, columns: list[str]) -> DataFrame:
    """Raw rows of one layer as text columns under dictionary names; ``columns`` are all names of the layer, or those to show.

    The values of a row are looked up by the names that its file's layout gives them, so any number of layouts is one pass over the rows."""
    renamed = F.map_from_arrays("keys", F.transform("columns", lambda c: F.col("attributes")[c]))
    return features.withColumn("_renamed", renamed).select(*[F.col("_renamed")[n.lower()].alias(n) for n in columns], *META)


def run(spark: SparkSession, folder: str, layers: dict[str, Layer], settings: Settings | None = None, store: str | None = None) -> RunResult:
    """Read, recognise, check; ``store`` is the folder of unpacked archives that earlier runs left, if they are to be reused."""
    settings = settings or Settings()
    features = staged(read_folder(spark, folder, store), "features")
    schemas = file_schemas(features)
    known = schemas.join(recognise_files(schemas, layers), "_path", "left")
    known = staged(known.join(layout_table(known, layers), ["layer", "columns"], "left"), "files")
    tagged = features.filter("error is null").join(known.select("_path", "layer", "columns", "keys"), "_path")
    names = layer_columns(known.filter("layer is not null"))
    journal = file_journal(known)
    raw, checks, failures, status, issues = {}, {}, {}, [], []
    for name, layer in layers.items():
        if name not in names:
            continue
        try:
            # alignment and checks run here, so a layer that fails is reported without stopping the others
            raw[name] = aligned_layer(tagged.filter(F.col("layer") == name), names[name])
            check = check_layer(raw[name], layer, settings, reuse=True)
            status.append(check.rows)
            issues.append(check.issues)
            checks[name] = check
        except Exception as e:
            failures[name] = str(e)
            if name in raw:
                status.append(unchecked_rows(raw[name], layer))
    union = lambda frames: reduce(lambda a, b: a.unionByName(b), frames) if frames else None
    return RunResult(raw, checks, journal, union(status), union(issues), failures)


def file_journal(known: DataFrame) -> DataFrame:
    """Journal of all files, with what is missing or ambiguous in their layout."""
    none = F.array().cast("array<string>")
    return align.journal(known.select(
        F.col("_source").alias("fichier"), F.col("error").isNull().alias("readable"), F.col("layer").alias("couche"),
        "n_entites", "columns", F.coalesce("absent", none).alias("absent"), F.coalesce("ambiguous", none).alias("ambiguous"),
        F.coalesce("crs_assumed", F.lit(False)).alias("crs_assumed")))


def export(result: RunResult, layers: dict[str, Layer], folder: str, run_date: date,
           formats: tuple[str, ...] = ("table", "csv", "kml")) -> DataFrame | None:
    """Write raw data, report, corrections per agent and the day's history; returns the quality summary."""
    if not result.raw:
        return None
    target = sinks.run_folder(folder, run_date)
    if "table" in formats:
        sinks.write_raw_tables(result.raw, f"{target}/donnees_brutes/tables")
    for name, df in result.raw.items():
        if "csv" in formats:
            sinks.write_short_named_csv(df, name, f"{target}/donnees_brutes/csv")
    if "kml" in formats:
        sinks.write_kml_layers(result.raw, {n: layers[n].id_var for n in result.raw}, f"{target}/donnees_brutes/kml")
    tables = sinks.report_tables(result.rows, result.issues, result.journal, run_date)
    sinks.write_report(tables, f"{target}/rapport")
    sinks.write_corrections(result.issues, f"{target}/corrections_par_agent")
    summary = tables["synthese"]
    sinks.upsert_history(report.daily_history(summary, run_date), f"{folder}/suivi_quotidien")
    return summary


