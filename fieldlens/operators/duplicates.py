"""Duplicate records: found with aggregates per key, marked on the rows, never removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.steps import in_steps
from fieldlens.functions.text import VALUE_KEY_STEPS
from fieldlens.functions.values import COMPARABLE_NUMBER_STEPS
from fieldlens.operators.distribution import attach, number_in_order

ROW_KEY = ["_path", "_row_src"]
GROUP_KEY = ["_kind", "_key", "_pos"]


def shared_ids(rows: DataFrame, id_col: str, x: str = "_px", y: str = "_py") -> DataFrame:
    """Identifiers used at more than one position: (id, n). A missing position counts as one position."""
    ids = rows.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.count("*").alias("n"), F.count(x).alias("located"), F.min(x).alias("x0"), F.max(x).alias("x1"),
        F.min(y).alias("y0"), F.max(y).alias("y1"))
    mixed = (F.col("located") > 0) & (F.col("located") < F.col("n"))
    return ids.filter(mixed | (F.col("x0") != F.col("x1")) | (F.col("y0") != F.col("y1"))).select("_id", "n")


def with_signature(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``_sig1`` and ``_sig2``, two independent hashes of the comparable values of a row."""
    text = {c: F.col(c).cast("string") for c in columns}
    work = {f"_n_{c}": (text[c], COMPARABLE_NUMBER_STEPS) for c in columns}
    work.update({f"_k_{c}": (text[c], VALUE_KEY_STEPS) for c in columns})
    values = [F.coalesce(F.col(f"_n_{c}").cast("string"), F.col(f"_k_{c}")) for c in columns]
    return in_steps(rows, work).withColumns({"_sig1": F.xxhash64(*values), "_sig2": F.hash(*values).cast("long")}).drop(*work)


def completeness_of(columns: list[Column]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + c.isNotNull().cast("int")
    return total


def group_keys(id_col: Column, name_col: Column | None, x: Column, y: Column) -> dict[str, Column]:
    """Key of a duplicate group: the id, else the name, at a rounded position."""
    name = F.lit(None).cast("string") if name_col is None else name_col
    return {"_kind": F.when(id_col.isNotNull(), "id").when(name.isNotNull(), "nom"),
            "_key": F.coalesce(id_col, name), "_pos": F.concat_ws(" ", x.cast("string"), y.cast("string"))}


def duplicate_groups(keyed: DataFrame) -> DataFrame:
    """One row per group of at least two records, numbered by first appearance.

    ``keyed`` has GROUP_KEY, ROW_KEY, ``_source``, ``_sig1``, ``_sig2``, ``_filled`` and ``_file_date``.
    The kept record is the most complete one, then the newest file, then the first row.
    """
    row = F.struct("_path", "_row_src", "_source")
    rank = F.struct((-F.col("_filled")).alias("filled"),
                    F.coalesce(-F.unix_date(F.col("_file_date").cast("date")), F.lit(0)).alias("newest"),
                    "_path", "_row_src", "_source")
    groups = keyed.filter(F.col("_key").isNotNull()).groupBy(*GROUP_KEY).agg(
        F.count("*").alias("n"), F.min("_sig1").alias("a0"), F.max("_sig1").alias("a1"),
        F.min("_sig2").alias("b0"), F.max("_sig2").alias("b1"), F.min(rank).alias("best"), F.min(row).alias("first"))
    groups = groups.filter("n >= 2").select(
        *GROUP_KEY, "n", F.when((F.col("a0") == F.col("a1")) & (F.col("b0") == F.col("b1")), "exact")
        .otherwise("conflit").alias("nature"),
        F.struct("best._path", "best._row_src", "best._source").alias("kept"), "first")
    return number_in_order(groups, [F.col("first._path"), F.col("first._row_src")], name="_number") \
        .withColumn("_grp", F.col("_number") - 1).drop("_number")


def group_members(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """Every record of a group with its role: ROW_KEY, _grp, nature, keep and the record it refers to."""
    narrow = keyed.select(*ROW_KEY, *GROUP_KEY)
    members = attach(narrow, groups, GROUP_KEY, "n", "inner").select(
        *ROW_KEY, "_grp", "nature", "kept", "first",
        ((F.col("_path") == F.col("kept._path")) & (F.col("_row_src") == F.col("kept._row_src"))).alias("keep"))
    # a kept first row of a conflict refers to the first of the others: one aggregate keyed by that row
    needs = (F.col("nature") == "conflit") & (F.col("kept") == F.col("first")) & ~F.col("keep")
    source = keyed.select(*ROW_KEY, "_source")
    others = members.filter(needs).join(source, ROW_KEY).groupBy(
        F.col("kept._path").alias("_path"), F.col("kept._row_src").alias("_row_src")) \
        .agg(F.min(F.struct("_path", "_row_src", "_source")).alias("other"))
    members = members.join(others, ROW_KEY, "left")
    refers = F.when(~F.col("keep"), F.col("kept")).otherwise(F.coalesce("other", "first"))
    return members.select(*ROW_KEY, "_grp", "nature", "keep", refers.alias("refers"))


def recommendation() -> Column:
    """Advice for a member of a duplicate group (empty text outside groups)."""
    exact, keep = F.col("nature") == "exact", F.col("keep")
    return F.when(exact & keep, "Conserver (ligne la plus complète du groupe)") \
        .when(exact, "Copie identique : à écarter après validation") \
        .when(keep, "Valeurs différentes : arbitrer (version la plus complète)") \
        .when(~exact, "Valeurs différentes : arbitrer").otherwise("")


def duplicate_message() -> Column:
    row, file = F.col("refers._row_src").cast("string"), F.col("refers._source")
    return F.when((F.col("nature") == "exact") & ~F.col("keep"), F.concat(
        F.lit("Copie identique de la ligne "), row, F.lit(" de « "), file,
        F.lit(" » (ex. même collecte en .kml et .shp)"))) \
        .when(F.col("nature") == "conflit", F.concat(
            F.lit("Mêmes ID/position que la ligne "), row, F.lit(" de « "), file,
            F.lit(" » mais valeurs différentes : à arbitrer")))


def keep_first(rows: DataFrame, columns: list[str], order: list[str] = ROW_KEY) -> DataFrame:
    """Mark rows that repeat an earlier row in all ``columns`` (nulls equal): adds ``is_copy``.

    Rows are compared through a 128-bit digest; one aggregate finds the first row of each digest, so a row
    copied very many times costs one partial aggregate per task, not one long window.
    """
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    digested = rows.withColumn("_digest", F.md5(text))
    firsts = digested.groupBy("_digest").agg(F.count("*").alias("_copies"), F.min(F.struct(*order)).alias("_first")) \
        .filter("_copies > 1")
    marked = attach(digested, firsts, ["_digest"], "_copies")
    same_row = F.lit(True)
    for c in order:
        same_row = same_row & F.col(c).eqNullSafe(F.col(f"_first.{c}"))
    return marked.select(*rows.columns, (F.col("_first").isNotNull() & ~same_row).alias("is_copy"))


def repeated(rows: DataFrame, column: str, name: str = "is_repeated") -> DataFrame:
    """Mark every row whose non-null ``column`` value occurs more than once."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_times")).filter("_times > 1")
    marked = attach(rows, counts, [column], "_times")
    return marked.select(*rows.columns, F.col("_times").isNotNull().alias(name))
