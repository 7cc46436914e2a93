"""First rule pack for one layer: raw rows in, a status per row and the list of issues out.

Raw rows are neither changed nor dropped. Row-local checks are one narrow pass; group checks (shared
identifiers, duplicate groups, near duplicates) travel as narrow (row, issue) pairs and meet the rows in
one join on the row key, which is unique and therefore even.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.functions.steps import in_steps, spread
from fieldlens.functions.text import VALUE_KEY_STEPS
from fieldlens.functions.values import day_text
from fieldlens.operators import checks, duplicates, spatial
from fieldlens.operators.align import harmonise
from fieldlens.operators.checks import ISSUE, Settings
from fieldlens.operators.distribution import attach, durable
from fieldlens.operators.duplicates import ROW_KEY
from fieldlens.sources.dictionary import Layer


def _issue(seq: int, kind: Column, severity: str, variable: str, value: Column, message: Column) -> Column:
    return F.struct(F.lit(seq).alias("seq"), F.lit(severity).alias("severity"), kind.alias("type"),
                    F.lit(variable).alias("variable"), value.cast("string").alias("value"),
                    message.alias("message")).cast(ISSUE)


def row_status(n_err: Column, n_warn: Column) -> Column:
    return F.when(n_err > 0, "À corriger").when(n_warn > 0, "À vérifier").otherwise("Conforme")


def count_severity(issues: Column, severity: str) -> Column:
    return F.size(F.filter(issues, lambda i: i["severity"] == severity)).cast("long")


def joined_messages(issues: Column) -> Column:
    """Distinct messages of a row in the order of first appearance."""
    return F.array_join(F.array_distinct(F.transform(F.array_sort(issues), lambda i: i["message"])), " | ")


@dataclass
class LayerCheck:
    """Lazy tables of one checked layer."""
    raw: DataFrame
    layer: Layer
    settings: Settings
    reuse: bool = False     # write the annotated rows once when several tables are derived from them

    @cached_property
    def cleaned(self) -> DataFrame:
        """Harmonised rows with date, agent, centroid and rounded position."""
        return checks.add_position(checks.add_meta(harmonise(self.raw, self.layer), self.settings))

    @cached_property
    def checked(self) -> DataFrame:
        """Canonical rows with every row-local issue."""
        return checks.row_checks(checks.canonicalise(self.cleaned, self.layer), self.layer, self.settings)

    @cached_property
    def narrow(self) -> DataFrame:
        """What the group checks need from a row, computed in one pass and written once.

        Duplicate key, value signature, number of filled values, position in degrees and metres. The
        group checks read this table several times; without it each reading would repeat the cleaning.
        """
        layer, cols = self.layer, [F.col(v) for v in self.layer.names]
        has_name = layer.name_var in layer.names
        name = F.col(layer.name_var) if has_name else F.lit(None).cast("string")
        ident = F.col(layer.id_var)
        keys = duplicates.group_keys(ident, name, F.col("_px"), F.col("_py"))
        both = F.concat_ws(" ", F.coalesce(ident, F.lit("")), F.coalesce(name, F.lit("")))
        signed = duplicates.with_signature(self.cleaned, layer.names)
        rows = in_steps(signed, {"_same": (both, VALUE_KEY_STEPS)}).select(
            *ROW_KEY, "_source", "_file_date", *[c.alias(k) for k, c in keys.items()], "_sig1", "_sig2",
            duplicates.completeness_of(cols).alias("_filled"), ident.alias("_id"), "_px", "_py", "_cx", "_cy", "_same")
        return durable(geo.with_utm(rows, "_cx", "_cy", self.settings.utm_zone).drop("_cx", "_cy"))

    @cached_property
    def groups(self) -> DataFrame:
        return duplicates.duplicate_groups(self.narrow)

    @cached_property
    def members(self) -> DataFrame:
        return durable(duplicates.group_members(self.narrow, self.groups))

    @cached_property
    def group_issues(self) -> DataFrame:
        """(row key, issue) of the checks that compare rows."""
        layer, value = self.layer, F.col("_id")
        ids = self.narrow.select(*ROW_KEY, "_id", "_px", "_py")
        shared = attach(ids, duplicates.shared_ids(ids, "_id"), ["_id"], "n", "inner").select(*ROW_KEY, _issue(
            checks.SEQ_ID_SHARED, F.lit("id_duplique"), "error", layer.id_var, value,
            F.concat(F.lit("Identifiant « "), value, F.lit(" » utilisé pour plusieurs positions différentes"))).alias("i"))
        kind = F.when(F.col("nature") == "exact", "doublon_exact").otherwise("doublon_conflit")
        copies = self.members.withColumn("_m", duplicates.duplicate_message()).filter("_m is not null").select(
            *ROW_KEY, _issue(checks.SEQ_DUPLICATE, kind, "warning", layer.id_var, F.lit(None), F.col("_m")).alias("i"))
        found = shared.unionByName(copies)
        return found.unionByName(self.near_issues) if layer.geometry.upper() == "POINT" else found

    @cached_property
    def near_issues(self) -> DataFrame:
        pts = self.narrow.filter("_e is not null").select(*ROW_KEY, "_same", "_e", "_n") \
            .join(self.members.select(*ROW_KEY, "_grp"), ROW_KEY, "left")
        near = spatial.same_object_nearby(pts, self.settings.near_m).filter("near")
        return near.select(*ROW_KEY, _issue(
            checks.SEQ_SPATIAL, F.lit("doublon_spatial"), "warning", "geometry", F.lit(None),
            F.lit(f"Point à moins de {self.settings.near_m:g} m d'un autre point identique (même id/nom)")).alias("i"))

    @cached_property
    def annotated(self) -> DataFrame:
        """Row context with all issues and the duplicate role, one row per raw row."""
        layer = self.layer
        name = F.col(layer.name_var) if layer.name_var in layer.names else F.lit(None).cast("string")
        context = self.checked.select(
            *ROW_KEY, "_source", "_fmt", F.col(layer.id_var).cast("string").alias("id"), name.cast("string").alias("nom"),
            F.col("_agent").alias("agent"), day_text(F.col("_date")).alias("date"),
            F.bround("_cx", 6).alias("longitude"), F.bround("_cy", 6).alias("latitude"), "_issues")
        per_row = self.group_issues.groupBy(*ROW_KEY).agg(F.collect_list("i").alias("_more"))
        roles = self.members.select(*ROW_KEY, "_grp", "nature", "keep")
        rows = context.join(per_row, ROW_KEY, "left").join(roles, ROW_KEY, "left")
        rows = rows.withColumn("_issues", F.concat("_issues", F.coalesce("_more", F.array().cast(f"array<{ISSUE}>")))).drop("_more")
        return durable(rows) if self.reuse else rows

    @property
    def rows(self) -> DataFrame:
        """Status table: one row per raw row."""
        counted = self.annotated.withColumns({
            "n_err": count_severity(F.col("_issues"), "error"), "n_warn": count_severity(F.col("_issues"), "warning"),
            "problemes": joined_messages(F.col("_issues"))})
        return counted.select(
            F.lit(self.layer.name).alias("couche"), F.col("_source").alias("fichier_source"),
            F.col("_row_src").alias("ligne_source"), "id", "nom", "agent", "date", F.col("_fmt").alias("format"),
            "n_err", "n_warn", row_status(F.col("n_err"), F.col("n_warn")).alias("statut"), "problemes",
            F.col("_grp").alias("groupe_doublon"), F.coalesce("nature", F.lit("")).alias("nature_doublon"),
            F.coalesce(duplicates.recommendation(), F.lit("")).alias("recommandation_doublon"),
            "longitude", "latitude", "_path")

    @property
    def issues(self) -> DataFrame:
        """Issue table; ``_seq`` keeps the order of checks."""
        flat = spread(self.annotated, [*ROW_KEY, "_source", "id", "nom", "agent", "date"], "_issues", "seq")
        return flat.select(F.lit(self.layer.name).alias("layer"), "severity", "type", "id", "nom", "agent", "date", "variable",
                           "value", "message", F.col("_source").alias("fichier"), F.col("_row_src").alias("ligne"),
                           "_path", F.col("seq").alias("_seq"))


def check_layer(raw: DataFrame, layer: Layer, settings: Settings | None = None, reuse: bool = False) -> LayerCheck:
    """Check one layer of raw rows (text columns, ``geom``, ``_source``, ``_path``, ``_file_date``, ``_row_src``, ``_fmt``)."""
    return LayerCheck(raw, layer, settings or Settings(), reuse)


def unchecked_rows(raw: DataFrame, layer: Layer) -> DataFrame:
    """Status table of a layer whose check failed: raw rows stay visible as not checked."""
    none = F.lit(None)
    return raw.select(
        F.lit(layer.name).alias("couche"), F.col("_source").alias("fichier_source"), F.col("_row_src").alias("ligne_source"),
        none.cast("string").alias("id"), none.cast("string").alias("nom"), F.lit("INCONNU").alias("agent"),
        none.cast("string").alias("date"), F.col("_fmt").alias("format"), F.lit(0).cast("long").alias("n_err"),
        F.lit(0).cast("long").alias("n_warn"), F.lit("Non contrôlé").alias("statut"), F.lit("").alias("problemes"),
        none.cast("long").alias("groupe_doublon"), F.lit("").alias("nature_doublon"),
        F.lit("").alias("recommandation_doublon"), none.cast("double").alias("longitude"),
        none.cast("double").alias("latitude"), "_path")


def ordered_issues(issues: DataFrame) -> DataFrame:
    """Errors first, then agent and id; ties follow check order and row order."""
    return issues.orderBy(F.when(F.col("severity") == "error", 0).otherwise(1), F.col("agent").asc_nulls_last(),
                          F.col("id").asc_nulls_last(), "_seq", "_path", "ligne")
