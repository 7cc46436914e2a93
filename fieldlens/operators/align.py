"""Layer recognition and column alignment.

Column names of one file are schema, so matching them is plan-time work on a bounded list. Recognising
the layer of very many files is data work and runs as joins against the broadcast dictionary.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.steps import in_steps
from fieldlens.functions.text import CLEAN_STEPS, NAME_KEY_STEPS, PHRASE_KEY_STEPS, name_key, plain_name_key
from fieldlens.sources.dictionary import Layer, column_lookup

META = ("geom", "_source", "_path", "_file_date", "_multigeom", "_row_src", "_fmt", "_crs_assumed")
MIN_MATCHED_COLUMNS = 3


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META]


def _meta_columns(df: DataFrame) -> list[str]:
    return [c for c in META if c in df.columns]


# ---- lookup tables and matching over many files ----------------------------------------------------

def lookup_table(variables: DataFrame) -> DataFrame:
    """(layer, kind, key, variable, ambiguous) for full and 10-character keys of every variable.

    ``variables`` needs (layer, variable, json_name, label).
    """
    names = variables.select("layer", "variable", F.explode(F.array("variable", "json_name", "label")).alias("text"))
    full = names.select("layer", "variable", F.lit("full").alias("kind"), name_key(F.col("text")).alias("key"))
    short = names.select("layer", "variable", F.lit("short").alias("kind"),
                         name_key(F.substring(name_key(F.col("text")), 1, 10)).alias("key"))
    return full.unionByName(short).filter("key <> ''") \
        .groupBy("layer", "kind", "key").agg(F.count_distinct("variable").alias("owners"), F.min("variable").alias("variable")) \
        .select("layer", "kind", "key", "owners", F.when(F.col("owners") == 1, F.col("variable")).alias("variable"))


def known_names(layers: list[Layer]) -> list[tuple[str, str, str]]:
    """(key, layer, variable) for every normalised name, cut name, typo and unique prefix that can match."""
    return [(key, layer.name, hit) for layer in layers for key, hit in sorted(column_lookup(layer).names.items())]


def match_names(columns: DataFrame, layers: list[Layer], name: str = "column") -> DataFrame:
    """Match (file, column) pairs to the variables of every layer; unmatched columns keep one null row.

    The names a dictionary can match are enumerated once on the driver, so matching any number of files
    is one map-side join with a table as small as the dictionary, whatever name most files share.
    """
    known = columns.sparkSession.createDataFrame(known_names(layers), "_key string, layer string, variable string")
    keyed = in_steps(columns, {"key": (F.col(name), NAME_KEY_STEPS)})
    return keyed.join(F.broadcast(known), keyed["key"] == known["_key"], "left").drop("_key")


def recognise(files: DataFrame, matches: DataFrame, layers: list[Layer],
              min_columns: int = MIN_MATCHED_COLUMNS) -> DataFrame:
    """Best layer per file.

    ``files`` has (file, name, gtypes: array<string>); ``matches`` (file, layer, variable) as given by
    ``match_names``. Score: matched columns + 100 for the layer name in the file name + 0.5 for an
    expected geometry type; the first layer of the catalogue wins a tie.
    """
    counts = matches.filter("layer is not null").groupBy("file", "layer").agg(F.count("*").alias("n"))
    per_file = counts.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("layer", "n"))).alias("matched"))
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    scored = in_steps(files.join(per_file, "file", "left"), {"_stem": (stem, NAME_KEY_STEPS)})
    single = lambda g: F.replace(F.upper(g), F.lit("MULTI"), F.lit(""))
    options = []
    for i, layer in enumerate(layers):
        n = F.coalesce(F.try_element_at("matched", F.lit(layer.name)), F.lit(0)).cast("double")
        named = F.contains("_stem", F.lit(plain_name_key(layer.name)))
        shaped = F.array_contains(F.transform("gtypes", single), layer.geometry.upper())
        options.append(F.struct(
            (n + F.when(named, 100).otherwise(0) + F.when(shaped, 0.5).otherwise(0)).alias("score"),
            F.lit(-i).alias("rank"), F.lit(layer.name).alias("layer"), n.cast("long").alias("n_match"),
            named.alias("named"), shaped.alias("shaped")))
    best = F.array_max(F.array(*options))
    return scored.withColumn("_best", best).select(
        *files.columns, F.when(F.col("_best.named") | ((F.col("_best.n_match") >= min_columns) & F.col("_best.shaped")),
                               F.col("_best.layer")).alias("layer"),
        F.col("_best.score").alias("score"), F.col("_best.n_match").alias("n_match"))


# Key of a path or file name in which layer aliases are looked for.
PATH_KEY_STEPS = [*PHRASE_KEY_STEPS, lambda c: F.regexp_replace(c, "[^a-z0-9]+", "_")]


def layer_in_key(t: Column, layers: dict[str, tuple[str, ...]]) -> Column:
    """Layer whose longest alias occurs in a path key (first of equally long ones)."""
    options, i = [], 0
    for name, aliases in layers.items():
        for alias in (name.lower(), *aliases):
            options.append((len(alias), -i, alias, name))
            i += 1
    out = F.lit(None).cast("string")
    for _, _, alias, name in sorted(options):  # longest is tested first, so it is added last
        out = F.when(F.contains(t, F.lit(alias)), name).otherwise(out)
    return out


def zone_in_text(text: Column) -> Column:
    """``ZONE<n>`` from a path, leading zeros removed."""
    digits = F.regexp_extract(text, r"(?i)zone[\s_\-]*(\d+)", 1)
    return F.when(digits != "", F.concat(F.lit("ZONE"), F.regexp_replace(digits, r"^0+(?=\d)", "")))


# ---- one file's schema -----------------------------------------------------------------------------

def unique_names(columns: list[str]) -> list[str]:
    """Repeated names become ``n``, ``n.1``, ``n.2`` …"""
    seen: dict[str, int] = {}
    out = []
    for c in columns:
        seen[c] = seen.get(c, -1) + 1
        out.append(c if seen[c] == 0 else f"{c}.{seen[c]}")
    return out


def aligned_names(columns: list[str], layer: Layer) -> list[str]:
    """Raw names aligned on the dictionary, unique without regard to case as Spark compares them.

    Of the columns that match a variable the first one takes its name; a name that is gone is tried again with ``_2`` behind it."""
    lookup = column_lookup(layer)
    first: dict[str, int] = {}
    for i, c in enumerate(columns):
        first.setdefault(lookup.match(c) or "", i)
    wanted = {i: v for v, i in first.items() if v}
    names: dict[str, str] = {}
    for i, c in enumerate(columns):
        name = wanted.get(i, c)
        while name.lower() in names:
            name = f"{name}_2"
        names[name.lower()] = name
    return list(names.values())


def rename_raw(df: DataFrame, layer: Layer) -> DataFrame:
    """Raw rows with dictionary names; values untouched, unknown columns kept."""
    columns = _data_columns(df)
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, aligned_names(columns, layer))],
                     *_meta_columns(df))


def harmonise(df: DataFrame, layer: Layer) -> DataFrame:
    """Working copy: cleaned values under variable names, unknown columns as ``x_<key>``, missing ones null."""
    lookup = column_lookup(layer)
    sources: dict[str, list[str]] = {}
    for c in _data_columns(df):
        sources.setdefault(lookup.match(c) or "x_" + plain_name_key(c), []).append(c)
    columns = [c for cols in sources.values() for c in cols]
    temporary = {c: f"_c{i}" for i, c in enumerate(columns)}
    cleaned = in_steps(df, {t: (F.col(f"`{c}`"), CLEAN_STEPS) for c, t in temporary.items()})
    merged = [F.coalesce(*[F.col(temporary[c]) for c in cols]).alias(name) for name, cols in sources.items()]
    missing = [F.lit(None).cast("string").alias(v) for v in layer.names if v not in sources]
    return cleaned.select(*merged, *missing, *_meta_columns(df))


def absent_variables(columns: list[str], layer: Layer) -> list[str]:
    names = set(aligned_names(columns, layer))
    return [v for v in layer.names if v not in names]


def ambiguous_names(columns: list[str], layer: Layer) -> list[str]:
    return sorted(column_lookup(layer).ambiguous & {c.lower() for c in columns})


def union_layers(frames: list[DataFrame]) -> DataFrame:
    """Bag union by name; columns a file lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def journal(files: DataFrame) -> DataFrame:
    """Journal row per file from (fichier, readable, couche, n_entites, columns, absent, ambiguous, crs_assumed)."""
    notes = F.array_compact(F.array(
        F.when(F.size("absent") > 0, F.concat(F.lit("colonnes absentes : "), F.array_join("absent", ", "))),
        F.when(F.size("ambiguous") > 0, F.concat(F.lit("colonnes ambiguës (noms tronqués) : "),
                                                 F.array_join("ambiguous", ", "))),
        F.when(F.col("crs_assumed"), F.lit("CRS absent : WGS84 supposé"))))
    unknown = F.concat(F.lit("Colonnes : "), F.array_join(F.slice("columns", 1, 12), ", "))
    unreadable = ~F.col("readable") | (F.col("n_entites") == 0)
    status = F.when(unreadable, "ERREUR").when(F.col("couche").isNull(), "NON RECONNU") \
        .when(F.size(notes) > 0, "OK (avertissements)").otherwise("OK")
    detail = F.when(unreadable, "Fichier illisible ou vide").when(F.col("couche").isNull(), unknown) \
        .otherwise(F.array_join(notes, " | "))
    return files.select("fichier", F.when(~unreadable, F.col("couche")).alias("couche"),
                        F.when(unreadable, 0).otherwise(F.col("n_entites")).cast("long").alias("n_entites"),
                        status.alias("statut"), detail.alias("detail"))


def layers_without_data(layers: DataFrame, rows: DataFrame) -> DataFrame:
    return layers.select("layer").join(rows.select(F.col("couche").alias("layer")).distinct(), "layer", "left_anti")
