"""File listings as tables: grouping, filtering and incremental selection without touching the files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions.steps import in_steps
from fieldlens.operators.align import PATH_KEY_STEPS, layer_in_key, zone_in_text
from fieldlens.operators.distribution import attach
from fieldlens.sources.dictionary import LAYER_ALIASES

# The files that belong to one shapefile, and the formats read as one file.
SHAPE_PARTS = ("shp", "shx", "dbf", "prj", "cpg", "qpj", "sbn", "sbx")
SINGLE_FILES = ("kml", "kmz", "zip")
WANTED = ("shp", "kml", "zip", "dbf", "shx", "prj", "cpg")
# A listing line is eight fields (rights, links, owner, group, size, month, day, time or year) and the name, which may hold blanks.
UNIX_FIELDS = ("[-d][A-Za-z-]{9}", "[0-9]+", "[^ ]+", "[^ ]+", "[0-9]+", "[A-Za-z]{3}", "[0-9]+", "[0-9:]+")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(base_name(path), r"\.([^.]*)$", 1))


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def discover(spark: SparkSession, folder: str, extensions: tuple[str, ...] = ("shp", "kml")) -> DataFrame:
    """Files below a folder: path, name, ext, size, file_date; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", base_name(F.col("path")).alias("name"), extension(F.col("path")).alias("ext"),
                        F.col("length").alias("size"), F.to_date("modificationTime").alias("file_date")) \
        .filter(F.col("ext").isin(*extensions) & ~F.contains("path", F.lit("__MACOSX")))


def local_inventory(files: DataFrame, root: str = "") -> DataFrame:
    """Name below the root, size in kB and time of change, newest first. Needs (path, size, mtime)."""
    name = F.regexp_replace("path", f"^{root}/?", "") if root else F.col("path")
    return files.select(name.alias("fichier"), F.bround(F.col("size") / 1024, 1).alias("taille_ko"),
                        F.date_format("mtime", "yyyy-MM-dd HH:mm").alias("modifie_le"), "mtime") \
        .orderBy(F.desc("mtime"), "fichier").drop("mtime")


def parse_unix_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Directory listing text to (name, is_dir, size, mtime); "." and ".." are left out.

    When a folder has a line of another form, all of its lines are read as bare names: a name without an
    extension is a directory, size and time are unknown. ``folder`` groups the lines.
    """
    c = F.col(column)
    lines = lines.filter(F.trim(c) != "").withColumn("_f", F.split(c, r"\s+", len(UNIX_FIELDS) + 1))
    field = lambda i: F.get("_f", F.lit(i))
    listed = F.coalesce(field(len(UNIX_FIELDS)) != "", F.lit(False))
    for i, form in enumerate(UNIX_FIELDS):
        listed = listed & F.coalesce(field(i).rlike(f"^{form}$"), F.lit(False))
    odd = lines.groupBy("folder").agg(F.count("*").alias("_lines"), F.count_if(~listed).alias("_odd")) \
        .filter("_odd > 0").select("folder", "_lines", "_odd")
    marked = attach(lines, odd, ["folder"], "_lines")
    plain = F.col("_odd").isNotNull()
    out = marked.select(
        "folder", F.when(plain, base_name(c)).otherwise(F.trim(field(8))).alias("name"),
        F.when(plain, ~c.rlike(r"\.[A-Za-z0-9]{2,4}$")).otherwise(F.startswith(field(0), F.lit("d"))).alias("is_dir"),
        F.when(~plain, field(4).try_cast("double")).alias("size"),
        F.when(~plain, F.concat_ws(" ", field(5), field(6), field(7))).alias("mtime"))
    return out.filter(~F.col("name").isin(".", ".."))


def within_depth(entries: DataFrame, root: str = "/", max_depth: int = 3, extensions: tuple[str, ...] = WANTED) -> DataFrame:
    """Files at most ``max_depth`` folders below the root with a wanted extension. Needs (path, is_dir)."""
    below = F.substring("path", F.lit(len(root.rstrip("/")) + 2), F.length("path"))
    depth = F.size(F.split(below, "/")) - 1
    last = F.lower(F.element_at(F.split(base_name(F.col("path")), r"\."), -1))
    return entries.filter(~F.col("is_dir") & F.startswith("path", F.lit(root)) & (depth <= max_depth) & last.isin(*extensions))


def group_sources(entries: DataFrame, aliases: dict[str, tuple[str, ...]] = LAYER_ALIASES) -> DataFrame:
    """One row per readable source: path, fmt, size, layer, zone, sidecars.

    Shapefile parts are grouped by folder and lower-case stem; a group needs its ``.shp``, sizes add up.
    Needs (path, size).
    """
    p = F.col("path")
    ext = extension(p)
    entries = entries.withColumns({"_ext": ext, "_dir": folder_of(p), "_stem": F.lower(F.regexp_replace(base_name(p), r"\.[^.]*$", ""))})
    single = entries.filter(F.col("_ext").isin(*SINGLE_FILES)).select(
        "path", F.col("_ext").alias("fmt"), "size", F.array().cast("array<string>").alias("sidecars"))
    # one stem has at most one part per extension, so the collected list is as short as SHAPE_PARTS
    parts = entries.filter(F.col("_ext").isin(*SHAPE_PARTS)) \
        .groupBy("_dir", "_stem", "_ext").agg(F.max("path").alias("path"), F.max_by("size", "path").alias("size"))
    shapes = parts.groupBy("_dir", "_stem").agg(
        F.max(F.when(F.col("_ext") == "shp", F.col("path"))).alias("path"), F.sum("size").alias("size"),
        F.array_sort(F.collect_list(F.when(F.col("_ext") != "shp", F.col("path")))).alias("sidecars")) \
        .filter("path is not null").select("path", F.lit("shp").alias("fmt"), "size", "sidecars")
    out = in_steps(single.unionByName(shapes), {"_name": (base_name(F.col("path")), PATH_KEY_STEPS), "_whole": (F.col("path"), PATH_KEY_STEPS)})
    return out.select("path", "fmt", "size", F.coalesce(layer_in_key(F.col("_name"), aliases), layer_in_key(F.col("_whole"), aliases)).alias("layer"),
                      zone_in_text(F.col("path")).alias("zone"), "sidecars").orderBy("path")


def inherit_from_archive(members: DataFrame, archives: DataFrame) -> DataFrame:
    """Layer and zone of an archive member, taken from the archive when its own name has none.

    ``members`` has (archive, path, fmt, layer, zone), ``archives`` (path, layer, zone).
    """
    outer = archives.select(F.col("path").alias("archive"), F.col("layer").alias("_l"), F.col("zone").alias("_z"))
    return members.join(outer, "archive", "left").select(
        F.concat_ws("!", "archive", "path").alias("origin"), "fmt", F.coalesce("layer", "_l").alias("layer"),
        F.coalesce("zone", "_z").alias("zone"))


def local_folder(path: Column) -> Column:
    """Folder name a remote folder is stored under."""
    return F.regexp_replace(F.regexp_replace(path, "^/+|/+$", ""), "[^A-Za-z0-9_-]+", "_")


def changed_files(listing: DataFrame, manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """Remote files to fetch: not known exactly once, changed in size or time, or no longer stored.

    ``listing`` has (remote, size, mtime); a missing size or time on the server counts as unchanged.
    ``manifest`` has (remote, size, mtime, local) as text, ``stored`` (local).
    """
    known = manifest.groupBy("remote").agg(
        F.count("*").alias("n"), F.max("size").alias("m_size"), F.max("mtime").alias("m_time"), F.max("local").alias("local")) \
        .filter("n = 1").join(stored.select("local").distinct(), "local", "left_semi")
    same_size = F.col("size").isNull() | (F.col("m_size").try_cast("double") == F.col("size").cast("double"))
    same_time = F.col("mtime").isNull() | (F.col("m_time") == F.col("mtime"))
    joined = listing.join(known.select("remote", "m_size", "m_time", F.col("n").alias("_known")), "remote", "left")
    unchanged = F.col("_known").isNotNull() & F.coalesce(same_size, F.lit(False)) & F.coalesce(same_time, F.lit(False))
    return joined.filter(~unchanged).select(*listing.columns)


def merge_manifest(manifest: DataFrame, fetched: DataFrame) -> DataFrame:
    """Manifest with the entries of fetched paths replaced or added."""
    return manifest.join(fetched.select("remote").distinct(), "remote", "left_anti").unionByName(fetched)
