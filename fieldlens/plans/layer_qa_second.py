"""Second rule pack: issues with rule codes and suggestions, and the distances between layers."""

from __future__ import annotations

import difflib
import json
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldlens.functions import geo
from fieldlens.functions.steps import in_steps, spread
from fieldlens.functions.text import (CLEAN_SECOND_STEPS, domain_status, is_null_second, phrase_key, plain_phrase_key,
                                      split_choices)
from fieldlens.functions.values import BOOL_SECOND_STEPS, NUMBER_SECOND_STEPS, double_text
from fieldlens.operators import spatial
from fieldlens.operators.distribution import attach, durable
from fieldlens.operators.duplicates import repeated
from fieldlens.operators.rules import SECOND_PACK, rules_for, with_phrase_keys
from fieldlens.sources.dictionary import Layer, Variable

BOX = (8.3, 1.6, 16.3, 13.2)
ID_PATTERN = r"^ZONE([1-9][0-9]*)([A-Z]{2})([1-9][0-9]*)$"
CLOSE_CUTOFF = 0.8
NEAR_M = 3.0
STATION_RADIUS_M = 300.0
# Plausible ranges as (low, high, severity); limits are shown as written.
RANGES = {
    "densite_couvert": (0, 100, "ERROR"), "temps_acces_min": (0, 600, "WARNING"),
    "largeur_m": (0.5, 40, "WARNING"), "vitesse_moy_kmh": (3, 140, "WARNING"),
    "duree_coupure_jours": (0, 365, "ERROR"), "capacite_stockage_t": (0, 1e7, "ERROR"),
}
COLUMNS = ["layer", "_rid", "zone", "id", "field", "rule", "severity", "message", "suggestion"]
ISSUE = "struct<seq:int,field:string,rule:string,severity:string,message:string,suggestion:string>"
SEVERITIES = ("ERROR", "WARNING", "INFO")


def issue(when: Column, seq: int, field: str, rule: str, severity: str, message, suggestion="") -> Column:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    one = F.struct(F.lit(seq).alias("seq"), F.lit(field).alias("field"), F.lit(rule).alias("rule"),
                   F.lit(severity).alias("severity"), lit(message).alias("message"), lit(suggestion).alias("suggestion"))
    return F.when(when, F.array(one).cast(f"array<{ISSUE}>")).otherwise(F.array().cast(f"array<{ISSUE}>"))


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def clean_ident(c: Column) -> Column:
    return F.when(~is_null_second(c), F.trim(c))


def typed_view(df: DataFrame, layer: Layer) -> DataFrame:
    """Typed copy: numbers, booleans and cleaned text; the received text stays under ``_raw_<name>``."""
    steps = {"boolean": BOOL_SECOND_STEPS, "double": NUMBER_SECOND_STEPS, "integer": NUMBER_SECOND_STEPS}
    raw = {f"_raw_{v.name}": F.col(v.name) for v in layer.variables if v.type in steps}
    df = df.withColumns(raw) if raw else df
    return in_steps(df, {v.name: (F.col(v.name), steps.get(v.type, CLEAN_SECOND_STEPS)) for v in layer.variables})


def id_issues(layer: Layer) -> list[Column]:
    """Missing or malformed identifiers stop the other identifier checks of their row."""
    c, z, f = F.col("_id"), F.col("_zone"), layer.id_var
    shaped = c.rlike(ID_PATTERN)
    prefix, zone = F.regexp_extract(c, ID_PATTERN, 2), F.concat(F.lit("ZONE"), F.regexp_extract(c, ID_PATTERN, 1))
    p = layer.prefix
    return [
        issue(c.isNull(), 20, f, "ID_MISSING", "ERROR", "Identifiant manquant"),
        issue(~shaped, 21, f, "ID_FORMAT", "ERROR",
              text(f"Format attendu ZONE<n>{p}<n> (ex. ZONE1{p}1), reçu « ", c, " »"),
              text(F.coalesce(z, F.lit("ZONEn")), f"{p}n")),
        issue(shaped & (prefix != p), 22, f, "ID_PREFIX", "ERROR",
              text("Préfixe ", prefix, f" ≠ {p} attendu pour cette couche")),
        issue(shaped & (zone != z), 23, f, "ID_ZONE", "ERROR", text("ID de ", zone, " mais fichier de ", z)),
        issue(shaped & F.col("_id_repeated"), 24, f, "ID_DUP", "ERROR", "Identifiant en double"),
    ]


def geometry_issues(layer: Layer) -> list[Column]:
    g = F.col("geom")
    empty = geo.is_empty(g)
    b = F.col("_bounds")
    xmin, ymin, xmax, ymax = BOX
    at_zero = (b["xmin"] == 0) & (b["ymin"] == 0) if layer.geometry == "Point" else F.lit(False)
    outside = (b["xmax"] < xmin) | (b["xmin"] > xmax) | (b["ymax"] < ymin) | (b["ymin"] > ymax)
    out = [
        issue(empty, 0, "geometry", "GEOM_NULL", "ERROR", "Géométrie absente ou vide"),
        issue(~empty & (g["gtype"] != layer.geometry), 1, "geometry", "GEOM_TYPE", "ERROR",
              text("Type ", g["gtype"], f" au lieu de {layer.geometry}")),
        issue(~empty & ~geo.is_valid(g), 2, "geometry", "GEOM_INVALID", "ERROR",
              "Géométrie invalide (auto-intersection…)", "make_valid"),
        issue(at_zero, 3, "geometry", "GEOM_ZERO", "ERROR", "Coordonnées (0,0) : GPS non fixé"),
        issue(~at_zero & outside, 4, "geometry", "GEOM_BBOX", "ERROR",
              text("Hors du Cameroun (", F.format_string("%.4f", b["xmin"]), ", ", F.format_string("%.4f", b["ymin"]), ")"),
              "Inversion lat/lon ou erreur GPS ?"),
    ]
    if layer.geometry != "Point":
        out.append(issue(F.col("_length_m") < 5, 6, "geometry", "LINE_SHORT", "WARNING",
                         text("Tronçon très court (", F.format_string("%.1f", F.col("_length_m")), " m)")))
    return out


def _tokens(v: Variable) -> Column:
    c = F.col(v.name)
    if v.type == "multiselect":
        return split_choices(c, sorted({plain_phrase_key(x) for x in v.values}))
    return F.when(c.isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))


def _judged(v: Variable) -> Column:
    """Tokens of a list variable with their position and status."""
    return F.transform(_tokens(v), lambda t, i: F.struct(
        F.lit(v.name).alias("field"), i.alias("at"), t.alias("token"), domain_status(t, list(v.values)).alias("s")))


def _spelling_issues(v: Variable, seq: int) -> Column:
    hits = F.filter(_judged(v), lambda x: x["s"]["status"] == "case")
    return F.transform(hits, lambda x: F.struct(
        F.lit(seq).alias("seq"), F.lit(v.name).alias("field"), F.lit("DOM_CASE").alias("rule"),
        F.lit("WARNING").alias("severity"), text("« ", x["token"], " » : casse/accents/tiret non conformes").alias("message"),
        x["s"]["value"].alias("suggestion")).cast(ISSUE))


def value_issues(layer: Layer) -> list[Column]:
    """Required, type, range and list checks; tokens no list knows are settled by ``unknown_tokens``."""
    out = []
    for i, v in enumerate(layer.variables):
        c, seq, name = F.col(v.name), 100 + 10 * i, v.name
        if v.level and name != layer.id_var:
            out.append(issue(c.isNull(), seq, name, "REQ_MISSING", "ERROR" if v.level == "E" else "WARNING",
                             f"Champ « {name} » non renseigné"))
        if v.type in ("boolean", "double", "integer"):
            raw = F.col(f"_raw_{name}")
            bad = ~is_null_second(raw) & c.isNull()
            kind = "booléenne" if v.type == "boolean" else "numérique"
            out.append(issue(bad, seq + 1, name, "TYPE_INVALID", "ERROR", text("Valeur « ", raw, f" » non {kind}")))
            if v.type == "integer":
                out.append(issue(c % 1 != 0, seq + 2, name, "TYPE_DECIMAL", "WARNING",
                                 text("Entier attendu, reçu ", double_text(c)), "arrondi"))
            if name in RANGES:
                low, high, severity = RANGES[name]
                out.append(issue((c < low) | (c > high), seq + 3, name, "RANGE", severity,
                                 text(f"{name}=", double_text(c), f" hors plage [{low}, {high}]")))
        elif v.values:
            # one issue per token written in another spelling
            out.append(_spelling_issues(v, seq + 4))
            if v.type == "multiselect":
                alone = F.exists(_tokens(v), lambda t: phrase_key(t).startswith("aucun"))
                out.append(issue((F.size(_tokens(v)) > 1) & alone, seq + 6, name, "MULTI_EXCL", "WARNING",
                                 "Valeur « Aucun » combinée à d'autres choix"))
    return out


@F.pandas_udf(T.DoubleType())
def _similarity(known: pd.Series, token: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, k, t).ratio() for k, t in zip(known, token)], dtype="float64")


def _pairs_of(c: Column) -> Column:
    """The distinct pairs of neighbouring characters, with a mark before the first and behind the last."""
    marked = F.concat(F.lit("\u0001"), c, F.lit("\u0001"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(marked) - 1), lambda i: F.substring(marked, i, F.lit(2))))


def _common_characters(a: Column, b: Column) -> Column:
    """Characters that both have, with their number; never less than a matching of the two can use."""
    times = lambda t, x: F.length(t) - F.length(F.replace(t, x, F.lit("")))
    return F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, x: n + F.when(x == "", 0).otherwise(F.least(times(a, x), times(b, x))))


def closest_values(tokens: DataFrame, lists: dict[str, list[str]], cutoff: float) -> DataFrame:
    """``tokens`` (field, token, …) that have a value of similarity ``cutoff`` or more in the list of their field, with the closest as ``_close``.

    Texts of a ratio above 2/3 have two neighbouring characters, their first or their last in common, so tokens meet the values they share such a pair with, and of those only the ones
    whose lengths and characters allow the ratio; the ratio itself is computed for what is left. Of equally close values the greatest key counts."""
    if cutoff <= 2 / 3:
        raise ValueError("pairs of characters find values of similarity above 2/3")
    spark = tokens.sparkSession
    keys = {(f, plain_phrase_key(v)): v for f, values in lists.items() for v in values}
    index = spark.createDataFrame([(f, k, v) for (f, k), v in keys.items()] or [], "field string, known string, value string")
    index = index.withColumn("pair", F.explode(_pairs_of(F.col("known"))))
    asked = tokens.withColumn("key", phrase_key(F.col("token")))
    total = F.length("key") + F.length("known")
    met = asked.select("field", "token", "key", F.explode(_pairs_of(F.col("key"))).alias("pair")) \
        .join(F.broadcast(index), ["field", "pair"]).filter(2 * F.least(F.length("key"), F.length("known")) >= cutoff * total - 1e-9) \
        .select("field", "token", "key", "known", "value").distinct()  # the index is the user's dictionary
    met = met.filter(2 * _common_characters(F.col("key"), F.col("known")) >= cutoff * total - 1e-9)
    close = met.withColumn("ratio", _similarity("known", "key")).filter(F.col("ratio") >= cutoff) \
        .groupBy("field", "token").agg(F.max_by("value", F.struct("ratio", "known")).alias("_close"))
    return tokens.join(close, ["field", "token"])


def token_statuses(df: DataFrame, layer: Layer, key: list[str], cutoff: float) -> DataFrame:
    """Every list token of every row: key, field, position, token, status and canonical value.

    Only tokens that no rule settles are compared, each distinct one once.
    """
    fields = [v for v in layer.variables if v.values and v.type in ("text", "multiselect")]
    if not fields:
        return df.select(*key, F.lit("").alias("field"), F.lit(0).alias("at"), F.lit("").alias("token"),
                         F.lit("").alias("status"), F.lit("").alias("value")).limit(0)
    listed = F.concat(*[_judged(v) for v in fields])
    tokens = spread(df, key, listed, "field").select(
        *key, "field", "at", "token", F.col("s.status").alias("status"), F.col("s.value").alias("value"))
    if not cutoff:
        return tokens
    tokens = durable(tokens)
    unknown = tokens.filter("status = 'none'").groupBy("field", "token").agg(F.count("*").alias("_times"))
    settled = closest_values(unknown, {v.name: list(v.values) for v in fields}, cutoff)
    joined = attach(tokens, settled, ["field", "token"], "_times")
    fuzzy = (F.col("status") == "none") & F.col("_close").isNotNull()
    return joined.select(*key, "field", "at", "token", F.when(fuzzy, "fuzzy").otherwise(F.col("status")).alias("status"),
                         F.when(fuzzy, F.col("_close")).otherwise(F.col("value")).alias("value"))


def unknown_token_issues(df: DataFrame, layer: Layer, key: list[str]) -> DataFrame:
    """Issues for tokens absent from their list, with the closest value as a suggestion."""
    order = {v.name: i for i, v in enumerate(layer.variables)}
    seq = F.from_json(F.lit(json.dumps({k: 105 + 10 * i for k, i in order.items()})), "map<string,int>")
    bad = token_statuses(df, layer, key, CLOSE_CUTOFF).filter("status in ('fuzzy', 'none')")
    return bad.select(*key, seq[F.col("field")].alias("seq"), "field", F.lit("DOM_INVALID").alias("rule"),
                      F.lit("ERROR").alias("severity"),
                      text("« ", F.col("token"), " » absent du dictionnaire").alias("message"),
                      F.when(F.col("status") == "fuzzy", text("Proche de : ", F.col("value"))).otherwise("").alias("suggestion"))


def near_point_issues(df: DataFrame, zone: int, tolerance: float = NEAR_M) -> DataFrame:
    """One issue per point with others within the tolerance; it names one of them and gives their number."""
    pts = geo.with_utm(df.filter("_cx is not null").select("_rid", "_id", "_zone", "_cx", "_cy"), "_cx", "_cy", zone)
    near = spatial.neighbours(pts, tolerance, ["_rid"], "_id")
    more = F.when(F.col("n_near") > 1, text(" et ", (F.col("n_near") - 1).cast("string"), " autre(s)")).otherwise("")
    return near.select(
        "_rid", "_zone", "_id", F.lit(5).alias("seq"), F.lit("geometry").alias("field"), F.lit("GEOM_DUP").alias("rule"),
        F.lit("WARNING").alias("severity"),
        text(f"Point à < {tolerance:g} m de ", F.coalesce("partner", F.lit("None")), more, " (doublon possible)").alias("message"),
        F.lit("").alias("suggestion"))


def id_gaps(rows: DataFrame, layer: Layer, id_col: str = "_id", shown: int = 15) -> DataFrame:
    """Missing numbers per zone in 1..max among well-formed ids: zone, number of gaps and the first ones.

    Gaps are ranges between consecutive numbers. Numbers are cut into blocks so that one crowded zone is
    handled by many tasks; only the first few ranges of a zone are listed, all are counted.
    """
    c = F.col(id_col)
    nums = rows.filter(c.rlike(ID_PATTERN) & (F.regexp_extract(c, ID_PATTERN, 2) == layer.prefix)).select(
        F.concat(F.lit("ZONE"), F.regexp_extract(c, ID_PATTERN, 1)).alias("zone"),
        F.regexp_extract(c, ID_PATTERN, 3).try_cast("long").alias("n")).filter("n is not null").distinct()
    return sequence_gaps(nums, "zone", "n", shown)


def _runs(shown: int):
    """Of sorted (zone, n): per zone the first and last number of the partition, how many are missing between them, and the first of those."""
    def run(batches):
        held = None

        def row():
            zone, first, last, missing, head = held
            return pa.RecordBatch.from_arrays([pa.array([zone]), *(pa.array([v], pa.int64()) for v in (first, last, missing)),
                                               pa.array([head], pa.list_(pa.int64()))], ["zone", "first", "last", "missing", "head"])

        for batch in batches:
            zones, n = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(zones[1:] != zones[:-1]) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(n))):
                if a == b:
                    continue
                if held is None or held[0] != zones[a]:
                    if held is not None:
                        yield row()
                    held = [zones[a], int(n[a]), int(n[a]), 0, []]
                before = np.append(held[2], n[a:b - 1])
                gap = np.maximum(n[a:b] - before - 1, 0)
                for k in np.flatnonzero(gap)[:shown]:
                    if len(held[4]) < shown:
                        held[4] += range(int(before[k]) + 1, int(before[k]) + 1 + min(int(gap[k]), shown - len(held[4])))
                held[2], held[3] = int(n[b - 1]), held[3] + int(gap.sum())
        if held is not None:
            yield row()

    return run


def sequence_gaps(nums: DataFrame, per: str, n: str, shown: int = 15) -> DataFrame:
    """(per, n_missing, first_missing) for distinct positive numbers ``n`` of each ``per`` value, null values of it aside.

    Numbers are sorted in ranges, so that one crowded value is handled by many tasks. A range hands on one row per value; between two ranges lies
    the gap from the last number of the one to the first of the next, and that window has as many rows as ranges."""
    kind = nums.schema[per].dataType.simpleString()
    sorted_ = nums.filter(F.col(per).isNotNull()).select(F.col(per).alias("zone"), F.col(n).cast("long").alias("n"))
    runs = sorted_.repartitionByRange("zone", "n").sortWithinPartitions("zone", "n") \
        .mapInArrow(_runs(shown), f"zone {kind}, first long, last long, missing long, head array<long>")
    before = F.coalesce(F.lag("last").over(Window.partitionBy("zone").orderBy("first")), F.lit(0))
    joined = runs.withColumn("prev", before).withColumn("border", F.col("first") - F.col("prev") - 1).select(
        "zone", (F.col("missing") + F.col("border")).alias("missing"),
        F.concat(F.when(F.col("border") > 0, F.sequence(F.col("prev") + 1, F.least(F.col("first") - 1, F.col("prev") + shown)))
                 .otherwise(F.array().cast("array<long>")), "head").alias("head"))
    return joined.groupBy(F.col("zone").alias(per)).agg(
        F.sum("missing").alias("n_missing"), F.slice(F.array_sort(F.flatten(F.collect_list("head"))), 1, shown).alias("first_missing")) \
        .filter("n_missing > 0")


def gap_issues(rows: DataFrame, layer: Layer, shown: int = 15) -> DataFrame:
    gaps = id_gaps(rows, layer, shown=shown)
    return gaps.select(F.lit(None).cast("long").alias("_rid"), F.col("zone").alias("_zone"), F.lit(None).cast("string").alias("_id"),
                       F.lit(30).alias("seq"), F.lit(layer.id_var).alias("field"), F.lit("ID_GAP").alias("rule"),
                       F.lit("INFO").alias("severity"),
                       text("Numéros manquants dans la séquence: [", F.array_join("first_missing", ", "), "]",
                            F.when(F.col("n_missing") > shown, "…").otherwise("")).alias("message"),
                       F.lit("").alias("suggestion"))


def prepare(df: DataFrame, layer: Layer) -> DataFrame:
    """Rows with clean id and zone, centroid and bounds. ``df`` needs ``_rid``, ``geom`` and the variables."""
    zone = F.col("zone").cast("string") if "zone" in df.columns else F.lit(None).cast("string")
    out = df.withColumns({"_id": clean_ident(F.col(layer.id_var)), "_zone": clean_ident(zone),
                          "_bounds": geo.bounds(F.col("geom")), "_centre": geo.centroid(F.col("geom"))})
    return out.withColumns({"_cx": F.col("_centre.x"), "_cy": F.col("_centre.y")}).drop("_centre")


def check_layer_second(df: DataFrame, layer: Layer, struct: DataFrame | None = None,
                       tolerance: float = NEAR_M) -> DataFrame:
    """Issue table of one layer; ``_seq`` keeps the order of checks. ``struct`` are issues found at ingest."""
    base = prepare(df, layer)
    zone = geo.common_zone(base)
    marked = repeated(base, "_id", "_id_repeated")
    if layer.geometry != "Point":
        marked = marked.withColumn("_length_m", geo.length_m(F.col("geom"), zone))
    ready, broken = rules_for(SECOND_PACK, layer.name, layer.names)
    # the typed copy feeds the row checks, the token table, the gaps and the distances: written once
    typed = durable(with_phrase_keys(typed_view(marked, layer), ready))
    rules = [issue(r.flag(), 5000 + i, "", r.code, r.severity, r.message) for i, r in enumerate(ready)]
    local = F.concat(*geometry_issues(layer), *id_issues(layer), *value_issues(layer), *rules)
    context = ["_rid", "_zone", "_id"]
    found = [spread(typed, context, local, "seq"),
             unknown_token_issues(typed, layer, context), gap_issues(typed, layer)]
    if layer.geometry == "Point":
        found.append(near_point_issues(typed, zone, tolerance))
    for r in broken:
        found.append(df.sparkSession.range(1).select(
            F.lit(None).cast("long").alias("_rid"), F.lit(None).cast("string").alias("_zone"),
            F.lit(None).cast("string").alias("_id"), F.lit(5000).alias("seq"), F.lit("").alias("field"),
            F.lit(r.code).alias("rule"), F.lit("INFO").alias("severity"),
            F.lit(f"Règle {r.code} non évaluée: colonnes absentes").alias("message"), F.lit("").alias("suggestion")))
    out = reduce(lambda a, b: a.unionByName(b), found).select(
        F.lit(layer.name).alias("layer"), F.col("_rid").cast("long"), F.col("_zone").alias("zone"), F.col("_id").alias("id"),
        "field", "rule", "severity", "message", "suggestion", F.col("seq").alias("_seq"))
    if struct is not None:
        out = structural_issues(struct, layer.name).unionByName(out)
    return out


def structural_issues(struct: DataFrame, layer: str) -> DataFrame:
    """Issues found at ingest (layer, zone, field, rule, severity, message), passed through without a row."""
    none = F.lit(None)
    return struct.filter(F.col("layer") == layer).select(
        "layer", none.cast("long").alias("_rid"), "zone", none.cast("string").alias("id"), "field", "rule", "severity",
        "message", F.lit("").alias("suggestion"), F.lit(-1).alias("_seq"))


def severity_rank(c: Column) -> Column:
    return F.when(c == "ERROR", 0).when(c == "WARNING", 1).otherwise(2)


def ordered_issues_second(issues: DataFrame) -> DataFrame:
    return issues.orderBy("layer", severity_rank(F.col("severity")), "rule", "_seq", F.col("_rid").asc_nulls_first())


# ---- between layers --------------------------------------------------------------------------------

def _cross_row(layer: str, rid: Column, zone: Column, ident: Column, field: str, rule: str, message: Column, seq: int):
    return [F.lit(layer).alias("layer"), rid.cast("long").alias("_rid"), zone.alias("zone"), ident.alias("id"),
            F.lit(field).alias("field"), F.lit(rule).alias("rule"), F.lit("WARNING").alias("severity"),
            message.alias("message"), F.lit("").alias("suggestion"), F.lit(seq).alias("_seq")]


def metric(df: DataFrame, zone: int) -> DataFrame:
    """Rows with a position, in UTM metres of one zone."""
    centre = geo.centroid(F.col("geom"))
    located = df.filter(~geo.is_empty(F.col("geom"))).withColumn("_c", centre)
    located = located.withColumns({"_cx": F.col("_c.x"), "_cy": F.col("_c.y")}).drop("_c")
    return geo.with_utm(located, "_cx", "_cy", zone)


def stations_without_partner(stations: DataFrame, facilities: DataFrame, zone: int,
                             radius: float = STATION_RADIUS_M) -> DataFrame:
    """Stations without a railway facility nearby and the reverse; level crossings are not facilities here."""
    a = metric(stations, zone)
    b = metric(facilities.filter(phrase_key(F.col("type_infra")) != "passage a niveau"), zone)
    out = None
    for source, target, name, other, ident in (
            (a, b, "Gares", "Infrastructures_Ferroviaires", "id_fichegare"),
            (b, a, "Infrastructures_Ferroviaires", "Gares", "id_infra")):
        # a side is skipped when the other is empty
        if target.limit(1).count() == 0:
            continue
        message = F.lit(f"Aucune fiche correspondante dans {other} à moins de {radius:g} m "
                        "(formulaires A et I à remplir sur les mêmes gares)")
        lone = spatial.without_neighbour(source.select("_rid", "zone", F.col(ident).alias("_id"), "_e", "_n"), target, radius) \
            .select(*_cross_row(name, F.col("_rid"), F.col("zone"), F.col("_id"), "geometry", "XL_GARE", message, 6000))
        out = lone if out is None else out.unionByName(lone)
    return out


# Metres covered by the four declared distance classes, and the tolerated deviation.
DISTANCE_CLASSES = ((0.0, 2000.0), (2000.0, 5000.0), (5000.0, 10000.0), (10000.0, 1e9))


def class_limits(declared: Column, values: list[str]) -> tuple[Column, Column]:
    key, low, high = phrase_key(declared), F.lit(None).cast("double"), F.lit(None).cast("double")
    for value, (lo, hi) in reversed(list(zip(values, DISTANCE_CLASSES))):
        low = F.when(key == plain_phrase_key(value), lo * 0.8).otherwise(low)
        high = F.when(key == plain_phrase_key(value), hi * 1.2).otherwise(high)
    return low, high


def wrong_distance_class(works: DataFrame, references: list[DataFrame], values: list[str], zone: int) -> DataFrame:
    """Crossings whose declared distance to the nearest station contradicts the measured one."""
    low, high = class_limits(F.col("distance_gare_proche"), values)
    src = metric(works, zone).select("_rid", "zone", F.col("id_ouvrage").alias("_id"), "distance_gare_proche", "_e", "_n")
    ref = reduce(lambda a, b: a.union(b), [metric(r, zone).select("_e", "_n") for r in references])
    measured = spatial.nearest_distance(src.filter(low.isNotNull()), ref)
    d = F.col("distance_m")
    message = text("Distance déclarée « ", F.col("distance_gare_proche"), " » vs ≈ ", F.format_string("%.1f", d / 1000),
                   " km mesurés (à vol d'oiseau) à la gare la plus proche")
    return measured.filter((d < low) | (d > high)).select(*_cross_row(
        "Ouvrage_franchissement", F.col("_rid"), F.col("zone"), F.col("_id"), "distance_gare_proche", "XL_DIST", message, 6001))


def cross_layer_issues(frames: dict[str, DataFrame], layers: dict[str, Layer],
                       radius: float = STATION_RADIUS_M) -> DataFrame | None:
    stations, facilities = frames.get("Gares"), frames.get("Infrastructures_Ferroviaires")
    works = frames.get("Ouvrage_franchissement")
    out = []

    def zone_of(df):
        return geo.common_zone(df.select(geo.centroid(F.col("geom")).alias("c")).select(
            F.col("c.x").alias("_cx"), F.col("c.y").alias("_cy")))

    if stations is not None and facilities is not None:
        out.append(stations_without_partner(stations, facilities, zone_of(stations), radius))
    references = [f for f in (stations, facilities) if f is not None]
    if works is not None and references:
        values = list(layers["Ouvrage_franchissement"]["distance_gare_proche"].values)
        if len(values) == len(DISTANCE_CLASSES):
            out.append(wrong_distance_class(works, references, values, zone_of(works)))
    out = [o for o in out if o is not None]
    return reduce(lambda a, b: a.unionByName(b), out) if out else None


def check_all_second(frames: dict[str, DataFrame], layers: dict[str, Layer], struct: DataFrame | None = None,
                     tolerance: float = NEAR_M) -> DataFrame:
    parts = [check_layer_second(df, layers[name], struct, tolerance) for name, df in frames.items()]
    cross = cross_layer_issues(frames, layers)
    return ordered_issues_second(reduce(lambda a, b: a.unionByName(b), parts + ([cross] if cross is not None else [])))


# ---- status and summaries --------------------------------------------------------------------------

def row_flags(issues: DataFrame) -> DataFrame:
    """Worst severity and sorted distinct rule codes per row; information is ignored."""
    bad = issues.filter("_rid is not null and severity <> 'INFO'").groupBy("layer", "_rid").agg(
        F.min(severity_rank(F.col("severity"))).alias("worst"),
        F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("qa_flags"))
    return bad.select("layer", "_rid", F.when(F.col("worst") == 0, "ERROR").otherwise("WARNING").alias("qa_status"), "qa_flags")


def apply_status(df: DataFrame, layer: str, issues: DataFrame) -> DataFrame:
    """Add ``qa_status`` (OK, WARNING, ERROR) and ``qa_flags`` to the rows of a layer."""
    flags = row_flags(issues.filter(F.col("layer") == layer)).drop("layer")
    return df.join(flags, "_rid", "left").withColumns({
        "qa_status": F.coalesce("qa_status", F.lit("OK")), "qa_flags": F.coalesce("qa_flags", F.lit(""))})


def summarise_second(rows: DataFrame, issues: DataFrame) -> DataFrame:
    """Per layer: entities, zones, entities with errors, with warnings only, % without either, structural issues.

    ``rows`` has (layer, _rid, zone).
    """
    size = rows.groupBy("layer").agg(F.count("*").alias("entites"), F.count_distinct("zone").alias("zones"))
    flags = row_flags(issues).groupBy("layer").agg(
        F.count_if(F.col("qa_status") == "ERROR").alias("erreurs"),
        F.count_if(F.col("qa_status") == "WARNING").alias("avertissements_seuls"))
    loose = issues.filter("_rid is null and severity <> 'INFO'").groupBy("layer").agg(F.count("*").alias("anomalies_structure"))
    out = size.join(flags, "layer", "left").join(loose, "layer", "left").na.fill(
        0, ["erreurs", "avertissements_seuls", "anomalies_structure"])
    clean = F.col("entites") - F.col("erreurs") - F.col("avertissements_seuls")
    return out.withColumn("entites_ok_pct", F.bround(100 * clean / F.greatest("entites", F.lit(1)), 1))


def completeness(df: DataFrame, layer: Layer) -> DataFrame:
    """Share of filled values per field, in percent; one aggregate over all fields."""
    n = F.count("*")
    cols = [F.sum((~is_null_second(F.col(v.name).cast("string"))).cast("long")).alias(v.name) for v in layer.variables]
    wide = df.agg(n.alias("_n"), *cols)
    entries = F.array(*[F.struct(F.lit(layer.name).alias("couche"), F.lit(v.name).alias("champ"), F.lit(v.type.upper()).alias("type"),
                                 F.when(F.col("_n") > 0, F.bround(100 * F.col(v.name) / F.col("_n"), 1)).otherwise(0.0)
                                 .alias("renseigne_pct")) for v in layer.variables])
    return wide.select(F.inline(entries))
