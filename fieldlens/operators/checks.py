"""Row-local checks of the first pack: every check adds an issue to the row's own array, no shuffle."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import geo
from fieldlens.functions.steps import in_steps
from fieldlens.functions.text import CLEAN_STEPS, VALUE_KEY_STEPS, plain_name_key, plain_value_key, split_known_values
from fieldlens.functions.values import BOOL_STEPS, DATE_STEPS, GENERAL_STEPS, NUMBER_STEPS, day_text, double_text
from fieldlens.operators.rules import FIRST_PACK, rules_for, with_value_keys
from fieldlens.sources.dictionary import Layer, Variable

ISSUE = "struct<seq:int,severity:string,type:string,variable:string,value:string,message:string>"

# Positions in the message order of a row: dictionary checks come first, numbered by variable.
SEQ_ID_SHARED, SEQ_ID_FORMAT, SEQ_DATE, SEQ_GEOMETRY, SEQ_SPATIAL, SEQ_DUPLICATE, SEQ_RULES = \
    10000, 10001, 10010, 10020, 10029, 10030, 10040


@dataclass(frozen=True)
class Settings:
    """Parameters of the first pack with their usual values."""
    run_date: date = field(default_factory=date.today)
    box: tuple[float, float, float, float] = (8.0, 2.0, 17.5, 14.5)
    utm_zone: int = 33
    start_date: date | None = None
    date_columns: tuple[str, ...] = ("created", "creation_date", "date_jour", "date_collecte", "date", "change")
    agent_columns: tuple[str, ...] = ("enumerator", "agent", "agent_nom", "collecteur", "enqueteur", "username", "user")
    id_convention: bool = True
    id_pattern: str | None = None
    min_line_m: float = 5
    near_m: float = 2
    as_written: bool = False


def issue(when: Column, seq: int, severity: str, kind: str, variable: str, value, message) -> Column:
    """Array with one issue where the condition holds, else empty (stays inside generated code)."""
    value = F.lit(value) if value is None or isinstance(value, str) else value
    message = F.lit(message) if isinstance(message, str) else message
    one = F.struct(F.lit(seq).alias("seq"), F.lit(severity).alias("severity"), F.lit(kind).alias("type"),
                   F.lit(variable).alias("variable"), value.cast("string").alias("value"), message.alias("message"))
    return F.when(when, F.array(one).cast(f"array<{ISSUE}>")).otherwise(F.array().cast(f"array<{ISSUE}>"))


def all_of(parts: list[Column]) -> Column:
    return F.concat(*parts) if parts else F.array().cast(f"array<{ISSUE}>")


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _helper_steps(v: Variable) -> list:
    """Steps from the cleaned text of a variable to the parsed form its checks share."""
    if v.type in ("text", "multiselect") and v.values:
        return VALUE_KEY_STEPS
    if v.type in ("double", "integer"):
        return NUMBER_STEPS
    return BOOL_STEPS if v.type == "boolean" else []


def _canonical(v: Variable) -> Column:
    c, h = F.col(v.name), F.col(f"_h_{v.name}")
    if v.type == "text" and v.values:
        spelling: dict[str, str] = {}
        for value in v.values:
            spelling.setdefault(plain_value_key(value), value)
        return F.coalesce(F.from_json(F.lit(json.dumps(spelling)), "map<string,string>")[h], c)
    if v.type == "multiselect" and v.values:
        return F.when(F.size(h["found"]) > 0, F.array_join(h["found"], "; "))
    if v.type in ("double", "integer", "boolean"):
        return h
    return c


def _variable_issues(v: Variable, seq: int) -> list[Column]:
    c, h, lab = F.col(v.name), F.col(f"_h_{v.name}"), v.label
    out = []
    if v.required:
        out.append(issue(c.isNull(), seq, "error", "champ_obligatoire_vide", v.name, None,
                         f"Champ obligatoire « {lab} » ({v.name}) non renseigné"))
    if v.type == "text" and v.values:
        known = {plain_value_key(x) for x in v.values}
        out.append(issue(c.isNotNull() & ~h.isin(*sorted(known)), seq + 1, "error", "valeur_hors_liste", v.name, c,
                         text(f"« {lab} » : valeur « ", c, " » absente de la liste autorisée")))
    if v.type == "multiselect" and v.values:
        out.append(issue(h["rest"] != "", seq + 1, "error", "valeur_hors_liste", v.name, c,
                         text(f"« {lab} » : élément(s) hors liste « ", h["rest"], " »")))
    if v.type in ("double", "integer"):
        out.append(issue(c.isNotNull() & h.isNull(), seq + 2, "error", "type_invalide", v.name, c,
                         text(f"« {lab} » : « ", c, " » n'est pas un nombre")))
        if v.type == "integer":
            out.append(issue(h != F.rint(h), seq + 3, "warning", "type_invalide", v.name, c,
                             text(f"« {lab} » : entier attendu, reçu ", c)))
        if v.low is not None:
            out.append(issue(h < v.low, seq + 4, "error", "hors_plage", v.name, double_text(h),
                             text(f"« {lab} » = ", F.col(f"_g_{v.name}"), f" inférieur au minimum plausible ({v.low:g})")))
        if v.high is not None:
            out.append(issue(h > v.high, seq + 5, "error", "hors_plage", v.name, double_text(h),
                             text(f"« {lab} » = ", F.col(f"_g_{v.name}"), f" supérieur au maximum plausible ({v.high:g})")))
    if v.type == "boolean":
        out.append(issue(c.isNotNull() & h.isNull(), seq + 2, "error", "type_invalide", v.name, c,
                         text(f"« {lab} » : « ", c, " » n'est pas Oui/Non")))
    return out


def value_issues(df: DataFrame, layer: Layer) -> Column:
    return all_of([p for i, v in enumerate(layer.variables) for p in _variable_issues(v, 10 * i)])


def canonicalise(df: DataFrame, layer: Layer) -> DataFrame:
    """Typed copy of harmonised rows plus ``_issues`` for required, list, type and range checks."""
    work = {f"_h_{v.name}": (F.col(v.name), _helper_steps(v)) for v in layer.variables if _helper_steps(v)}
    df = in_steps(df, work)
    multi = {f"_h_{v.name}": split_known_values(F.col(v.name), list(v.values), F.col(f"_h_{v.name}"))
             for v in layer.variables if v.type == "multiselect" and v.values}
    df = df.withColumns(multi) if multi else df
    changed = {v.name: _canonical(v) for v in layer.variables if f"_h_{v.name}" in work}
    # numbers out of range are rare: only they are written out for a message
    out_of_range = {}
    for v in layer.variables:
        if v.type in ("double", "integer") and (v.low is not None or v.high is not None):
            h = F.col(f"_h_{v.name}")
            outside = F.coalesce((h < v.low) if v.low is not None else F.lit(False), F.lit(False)) \
                | F.coalesce((h > v.high) if v.high is not None else F.lit(False), F.lit(False))
            out_of_range[f"_g_{v.name}"] = (F.when(outside, h), GENERAL_STEPS)
    df = in_steps(df, out_of_range)
    return df.withColumns({**changed, "_issues": value_issues(df, layer)}).drop(*work, *out_of_range)


def add_meta(df: DataFrame, settings: Settings) -> DataFrame:
    """``_date`` (collection day, else file day) and ``_agent`` from the first optional column present.

    Unknown columns carry an ``x_`` prefix in the working copy; the candidates are looked up without it.
    ``as_written`` looks them up with it, so that only dictionary variables can match.
    """
    keys = {}
    for c in df.columns:
        key = plain_name_key(c)
        if not settings.as_written and key.startswith("x_"):
            keys.setdefault(key[2:], c)
        else:
            keys[key] = c

    def pick(candidates):
        return next((F.col(f"`{keys[c]}`").cast("string") for c in candidates if c in keys), F.lit(None).cast("string"))

    df = in_steps(df, {"_date": (pick(settings.date_columns), DATE_STEPS), "_agent": (pick(settings.agent_columns), CLEAN_STEPS)})
    return df.withColumns({"_date": F.coalesce(F.to_date("_date"), F.col("_file_date").cast("date")),
                           "_agent": F.coalesce("_agent", F.lit("INCONNU"))})


def add_position(df: DataFrame) -> DataFrame:
    """Centroid (``_cx``, ``_cy``) and the position rounded to 5 decimals (``_px``, ``_py``)."""
    df = df.withColumn("_centre", geo.centroid(F.col("geom")))
    df = df.withColumns({"_cx": F.col("_centre.x"), "_cy": F.col("_centre.y")}).drop("_centre")
    return df.withColumns({"_px": F.bround("_cx", 5), "_py": F.bround("_cy", 5)})


def position_key(x: Column, y: Column) -> Column:
    return F.concat_ws(" ", double_text(F.bround(x, 5)), double_text(F.bround(y, 5)))


def id_pattern(layer: Layer, settings: Settings) -> tuple[str | None, str | None]:
    """Pattern of an identifier and how to call it in a message."""
    if not settings.id_pattern and settings.id_convention:
        return rf"^ZONE\d+{layer.prefix}\d+$", f"ZONE<n>{layer.prefix}<n>"
    return settings.id_pattern, settings.id_pattern


def id_issues(layer: Layer, settings: Settings) -> list[Column]:
    pattern, label = id_pattern(layer, settings)
    if not pattern:
        return []
    c = F.col(layer.id_var)
    return [issue(c.isNotNull() & ~c.rlike(pattern), SEQ_ID_FORMAT, "error", "id_format", layer.id_var, c,
                  text("Identifiant « ", c, f" » non conforme au format attendu ({label})"))]


def date_issues(settings: Settings) -> list[Column]:
    d = F.col("_date")
    out = [issue(d > F.date_add(F.lit(settings.run_date), 1), SEQ_DATE, "error", "date_future", "_date", day_text(d),
                 "Date de collecte dans le futur (horloge du terminal mal réglée ?)")]
    if settings.start_date:
        out.append(issue(d < F.lit(settings.start_date), SEQ_DATE + 1, "warning", "date_anterieure", "_date", day_text(d),
                         f"Date antérieure au début de la collecte ({settings.start_date})"))
    return out


def geometry_issues(layer: Layer, settings: Settings) -> list[Column]:
    g, x, y = F.col("geom"), F.col("_cx"), F.col("_cy")
    kind, empty = geo.single_type(g), geo.is_empty(g)
    xmin, ymin, xmax, ymax = settings.box
    s = SEQ_GEOMETRY
    out = [
        issue(empty, s, "error", "geometrie_vide", "geometry", None, "Géométrie absente ou illisible"),
        issue(~empty & (kind != layer.geometry.upper()), s + 1, "error", "geometrie_type", "geometry", kind,
              text(f"Type de géométrie {layer.geometry} attendu (", kind, " reçu)")),
        issue(~empty & ~geo.is_valid(g), s + 2, "error", "geometrie_invalide", "geometry", None,
              "Géométrie invalide (auto-intersection, anneau non fermé…)"),
        issue((x < xmin) | (x > xmax) | (y < ymin) | (y > ymax), s + 3, "error", "hors_emprise", "geometry", None,
              "Localisation hors de l'emprise attendue du corridor (coordonnées inversées ou erronées ?)"),
        issue((x == 0) & (y == 0), s + 4, "error", "hors_emprise", "geometry", "0,0",
              "Coordonnées (0,0) : GPS non capté"),
    ]
    if layer.geometry.upper() == "LINESTRING":
        metres = F.col("_length_m")
        limit = f"{settings.min_line_m:g}"
        out.append(issue(metres < settings.min_line_m, s + 5, "warning", "tronçon_court", "geometry",
                         double_text(F.bround(metres, 1)),
                         text("Tronçon de ", F.format_string("%.1f", metres), f" m seulement (< {limit} m)")))
    return out


def rule_issues(layer: Layer, columns: list[str]) -> list[Column]:
    ready, _ = rules_for(FIRST_PACK, layer.name, columns)
    return [issue(r.flag(), SEQ_RULES + i, r.severity, r.code, r.variable, None, r.message)
            for i, r in enumerate(ready)]


def row_checks(df: DataFrame, layer: Layer, settings: Settings) -> DataFrame:
    """All row-local checks on canonical rows; appends to ``_issues`` in message order."""
    if layer.geometry.upper() == "LINESTRING":
        g = F.col("geom")
        df = df.withColumn("_length_m", F.when(geo.single_type(g) == "LINESTRING", geo.length_m(g, settings.utm_zone)))
    columns = df.columns
    df = with_value_keys(df, rules_for(FIRST_PACK, layer.name, columns)[0])
    parts = id_issues(layer, settings) + date_issues(settings) + geometry_issues(layer, settings) \
        + rule_issues(layer, columns)
    return df.withColumn("_issues", F.concat("_issues", *parts)).select(*[c for c in columns if c != "_length_m"])
