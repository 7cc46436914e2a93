"""Repair mode of the second pack: new tables plus a table of rejects; the input is not touched."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.functions.steps import in_steps
from fieldlens.functions.text import CLEAN_SECOND_STEPS, is_null_second
from fieldlens.functions.values import BOOL_SECOND_STEPS, NUMBER_SECOND_STEPS
from fieldlens.operators.distribution import attach, durable, number_in_order
from fieldlens.operators.duplicates import keep_first
from fieldlens.plans import layer_qa_second as second
from fieldlens.sources.dictionary import Layer

ORDER = ["_rid"]
ID_TEXT = r"^ZONE([1-9][0-9]*)([A-Z]{2})([1-9][0-9]*)$"


@dataclass(frozen=True)
class RepairOptions:
    clean_text: bool = True
    fix_geometry: bool = True
    fix_swapped: bool = True
    drop_empty: bool = True
    coerce_types: bool = True
    fix_domains: bool = True
    fuzzy_cutoff: float = 0.88
    drop_copies: bool = True
    harmonise_ids: bool = True
    add_coordinates: bool = True


def clean_texts(df: DataFrame, layer: Layer) -> DataFrame:
    return in_steps(df, {v.name: (F.col(v.name), CLEAN_SECOND_STEPS) for v in layer.variables
                         if v.type not in ("boolean", "double", "integer")})


def repair_geometry(df: DataFrame) -> DataFrame:
    """Single-part multi-points unwrapped, touching lines merged, remaining multi-parts split into rows."""
    g = geo.merge_lines(geo.unwrap_single(F.col("geom")))
    return explode_parts(df.withColumn("geom", g))


def explode_parts(df: DataFrame) -> DataFrame:
    """Multi-points and multi-lines become one row per part; ``_part`` numbers the parts of a row."""
    g = F.col("geom")
    single = F.struct(F.replace(g["gtype"], F.lit("Multi"), F.lit("")).alias("gtype"), F.array(F.col("_one")).alias("parts")).cast(geo.GEOMETRY)
    multi = g["gtype"].isin("MultiPoint", "MultiLineString") & (F.size(g["parts"]) > 0)
    # posexplode over null yields no row, so the others get one dummy part
    parts = F.when(multi, g["parts"]).otherwise(F.array(F.lit(None).cast("array<struct<x:double,y:double>>")))
    wide = df.select("*", F.posexplode(parts).alias("_part", "_one"))
    return wide.withColumn("geom", F.when(F.col("_one").isNotNull(), single).otherwise(F.col("geom"))).drop("_one")


def coerce_types(df: DataFrame, layer: Layer) -> DataFrame:
    """Booleans and numbers typed; integers rounded half to even; uninterpretable values become null."""
    steps = {"boolean": BOOL_SECOND_STEPS, "double": NUMBER_SECOND_STEPS,
             "integer": [*NUMBER_SECOND_STEPS, lambda c: F.bround(c).try_cast("long")]}
    return in_steps(df, {v.name: (F.col(v.name), steps[v.type]) for v in layer.variables if v.type in steps})


def _values_of(field: str) -> Column:
    return F.transform(F.filter(F.col("_t"), lambda t: t["field"] == field), lambda t: t["value"])


def repair_domains(df: DataFrame, layer: Layer, cutoff: float) -> DataFrame:
    """List values rewritten to their dictionary spelling; ``_fixed`` counts the changed fields of a row."""
    key = ORDER + (["_part"] if "_part" in df.columns else [])
    fields = [v for v in layer.variables if v.values and v.type in ("text", "multiselect")]
    if not fields:
        return df.withColumn("_fixed", F.lit(0))
    tokens = second.token_statuses(df, layer, key, cutoff)
    # tokens of one cell: as many as the cell holds
    cells = tokens.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("field", "at", "value"))).alias("_t"))
    joined = df.join(cells, key, "left")
    fixed, out = F.lit(0), {}
    for v in fields:
        mine = _values_of(v.name)
        new = F.array_join(F.array_distinct(mine), "; ") if v.type == "multiselect" else F.get(mine, F.lit(0))
        new = F.when(~is_null_second(F.col(v.name)), F.coalesce(new, F.lit("")))
        out[f"_new_{v.name}"] = new
        fixed = fixed + (~F.col(f"_new_{v.name}").eqNullSafe(F.col(v.name))).cast("int")
    joined = joined.withColumns(out).withColumn("_fixed", fixed)
    names = {v.name for v in fields}
    return joined.select(*[F.col(f"_new_{c}").alias(c) if c in names else F.col(c) for c in df.columns], "_fixed")


def canonical_id(c: Column, prefix: str) -> Column:
    """``ZONE<n><prefix><n>`` without separators and leading zeros, null when it cannot be read that way."""
    s = F.regexp_replace(F.upper(c), r"[\s_\-./]", "")
    short = F.regexp_replace(s, r"(?<=\D)0+(?=\d)", "")
    best = F.when(short.rlike(ID_TEXT), short).when(s.rlike(ID_TEXT), s)
    return F.when(~is_null_second(c) & (F.regexp_extract(best, ID_TEXT, 2) == prefix), best)


def harmonise_ids(df: DataFrame, layer: Layer, order: list[str] = ORDER) -> DataFrame:
    """Canonical, unique identifiers: the original in ``id_orig``, the new one in the id column.

    A row needs a new number when its id cannot be read, repeats an earlier one or names another zone.
    New numbers continue after the highest one kept in the zone, in row order; without a zone the id is
    null. ``_renumbered`` and ``_id_changed`` mark the rows concerned.
    """
    ident = F.col(layer.id_var)
    base = df.withColumns({"id_orig": ident, "_canon": canonical_id(ident, layer.prefix)})
    base = base.withColumn("_zid", F.when(F.col("_canon").isNotNull(), F.concat(F.lit("ZONE"), F.regexp_extract("_canon", ID_TEXT, 1))))
    base = base.withColumn("zone", F.coalesce(F.col("zone"), F.col("_zid")))
    firsts = base.filter("_canon is not null").groupBy("_canon").agg(
        F.count("*").alias("_uses"), F.min(F.struct(*order)).alias("_first")).filter("_uses > 1")
    base = attach(base, firsts, ["_canon"], "_uses")
    first = F.lit(True)
    for c in order:
        first = first & (F.col(c) == F.col(f"_first.{c}"))
    bad = F.col("_canon").isNull() | (F.col("_first").isNotNull() & ~first) | (F.col("_zid") != F.col("zone"))
    base = base.withColumn("_bad", F.coalesce(bad, F.lit(False))).drop("_uses", "_first")
    top = base.filter("not _bad and zone is not null").groupBy("zone").agg(
        F.max(F.regexp_extract("_canon", ID_TEXT, 3).try_cast("decimal(38,0)")).alias("_top"), F.count("*").alias("_n"))
    todo = base.filter("_bad and zone is not null").select("zone", *order)
    numbered = number_in_order(todo, [F.col(c) for c in order], ["zone"], "_k")
    given = attach(numbered, top, ["zone"], "_n").select(*order, (F.coalesce("_top", F.lit(0)) + F.col("_k")).cast("decimal(38,0)").alias("_num"))
    out = base.join(given, order, "left")
    new = F.when(~F.col("_bad"), F.col("_canon")).when(
        F.col("_num").isNotNull(), F.concat(F.col("zone"), F.lit(layer.prefix), F.col("_num").cast("string")))
    original = F.when(~is_null_second(F.col("id_orig")), F.col("id_orig"))
    out = out.withColumn("_new", new)
    return out.select(*[F.col("_new").alias(c) if c == layer.id_var else F.col(c) for c in df.columns], "id_orig",
                      F.col("_num").isNotNull().alias("_renumbered"), (~F.col("_new").eqNullSafe(original)).alias("_id_changed"))


def add_coordinates(df: DataFrame, layer: Layer, zone: int) -> DataFrame:
    g = F.col("geom")
    if layer.geometry == "Point":
        p = geo.first_point(g)
        return df.withColumns({"lon": F.bround(p["x"], 7), "lat": F.bround(p["y"], 7)})
    return df.withColumn("longueur_m", F.bround(geo.length_m(g, zone), 1))


@dataclass
class Repaired:
    """Repaired rows, rejected rows with ``reject_reason``, and what was done as rows (couche, mesure, nombre)."""

    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame


EMPTY = "Géométrie vide"
COPY = "Doublon strict (mêmes attributs et géométrie)"


def _count(df: DataFrame, layer: Layer, **measures: Column | None) -> DataFrame:
    """One row per measure: the sum of its column over ``df``, or the number of rows for None."""
    sums = df.agg(*[(F.count(F.lit(1)) if c is None else F.coalesce(F.sum(c.cast("long")), F.lit(0))).alias(m) for m, c in measures.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(layer.name).alias("couche"), F.lit(m).alias("mesure"), F.col(m).cast("long").alias("nombre"))
                                           for m in measures])).alias("_c")).select("_c.*")


def repair_layer(df: DataFrame, layer: Layer, options: RepairOptions = RepairOptions(), zone: int | None = None) -> Repaired:
    """Repair one layer. ``df`` needs ``_rid``, ``zone``, ``geom`` and the variables."""
    o = options
    counts = [_count(df, layer, recues=None)]
    out = clean_texts(df, layer) if o.clean_text else df
    out = repair_geometry(out) if o.fix_geometry else out.withColumn("_part", F.lit(0))
    if o.fix_swapped and layer.geometry == "Point":
        out = out.withColumn("geom", geo.swap_if_outside(F.col("geom"), second.BOX))
    out = out.withColumn("reject_reason", F.when(geo.is_empty(F.col("geom")), EMPTY) if o.drop_empty
                         else F.lit(None).cast("string"))
    rejected = [out.filter("reject_reason is not null")]
    out = out.filter("reject_reason is null")
    out = coerce_types(out, layer) if o.coerce_types else out
    out = durable(out)  # the cleaned rows are read several times by the steps below
    if o.fix_domains:
        out = durable(repair_domains(out, layer, o.fuzzy_cutoff))
        counts.append(_count(out, layer, valeurs_normalisees=F.col("_fixed")))
        out = out.drop("_fixed")
    if o.drop_copies:
        out = durable(keep_first(out, [*layer.names, "geom", "zone"], [*ORDER, "_part"]))
        rejected.append(out.filter("is_copy").drop("is_copy").withColumn("reject_reason", F.lit(COPY)))
        out = out.filter("not is_copy").drop("is_copy")
    if o.harmonise_ids:
        out = durable(harmonise_ids(out, layer, [*ORDER, "_part"]))
        counts.append(_count(out, layer, identifiants_changes=F.col("_id_changed"), renumerotations=F.col("_renumbered")))
        out = out.drop("_renumbered", "_id_changed")
    if o.add_coordinates:
        if layer.geometry != "Point" and zone is None:
            centre = df.select(geo.centroid(F.col("geom")).alias("c"))
            zone = geo.common_zone(centre.select(F.col("c.x").alias("_cx"), F.col("c.y").alias("_cy")))
        out = add_coordinates(out, layer, zone or 33)
    rejects = rejected[0]
    for r in rejected[1:]:
        rejects = rejects.unionByName(r.select(*[F.col(c).cast(t) if c in r.columns else F.lit(None).cast(t).alias(c)
                                                 for c, t in rejects.dtypes]), allowMissingColumns=True)
    reason = F.col("reject_reason")
    counts += [_count(rejects, layer, sans_geometrie=reason == EMPTY, doublons_stricts=reason == COPY), _count(out, layer, conservees=None)]
    return Repaired(out.drop("reject_reason"), rejects, reduce(lambda a, b: a.unionByName(b), counts))


def repair_layers(frames: dict[str, DataFrame], layers: dict[str, Layer], options: RepairOptions = RepairOptions()) -> dict[str, Repaired]:
    """Repair of all layers; rows get new ``_rid`` from 0 in their order, as rows have been split and removed."""
    out = {}
    for name, df in frames.items():
        done = repair_layer(df, layers[name], options)
        out[name] = Repaired(renumber_rows(done.rows, [*ORDER, "_part"]), done.rejects, done.counts)
    return out


def renumber_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """Contiguous ``_rid`` from 0 in row order after rows were split or removed."""
    return number_in_order(df.drop("_rid") if "_rid" not in order else df.withColumnRenamed("_rid", "_old_rid"),
                           [F.col("_old_rid" if c == "_rid" else c) for c in order], name="_n") \
        .withColumn("_rid", F.col("_n") - 1).drop("_n", "_old_rid")


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split checked rows into those to deliver and those still in error."""
    bad = F.col("qa_status") == "ERROR"
    return df.filter(~bad), df.filter(bad).withColumn("reject_reason", F.concat(F.lit("Erreur QA: "), "qa_flags"))
