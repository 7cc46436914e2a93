"""The data dictionary: layers, their variables and value lists.

A dictionary is configuration of bounded size (hundreds of rows). It is read with Spark, collected once
and turned into plain objects from which the plans generate columns.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions.text import plain_name_key, short_name_key

LAYERS_SCHEMA = "layer string, geometry string, id_var string, name_var string"
VARIABLES_SCHEMA = ("layer string, ordre string, variable string, label string, json_name string, "
                    "type string, obligatoire string, min string, max string")
DOMAINS_SCHEMA = "layer string, variable string, ordre string, value string"
JSON_SCHEMA = ("name string, description string, fields array<struct<name:string,dataType:string,"
               "isStyling:boolean,defaultValue:string,values:array<string>>>")

# Column names written with a known typing error.
KNOWN_TYPOS = {"id_trocon": "id_troncon"}

# File-name aliases of the layers.
LAYER_ALIASES = {
    "Appui_Production_Valorisation": ("appui_production",),
    "Gouvernance_Services_Securite": ("service_securite", "gouvernance"),
    "Ground_Truthing_LandCover": ("ground_truthing", "landcover"),
    "Infrastructures_Ferroviaires": ("infra_ferro",),
    "Points_Vente_Marches": ("point_de_vente_marche", "points_vente", "point_vente"),
    "Reseau_Routier_Pistes": ("reseau_routier",),
    "Services_Sociaux_Bases": ("services_sociaux",),
    "Activites_autour_gare": ("activite_autour_gare",),
    "Gares": ("gares",),
    "Ouvrage_franchissement": ("ouvrage",),
}

# Fields the second rule pack recommends (warning) or requires besides the id (error).
RECOMMENDED = {
    "Appui_Production_Valorisation": ("nom_site", "type_unite"),
    "Gouvernance_Services_Securite": ("nom_poste", "type_service"),
    "Ground_Truthing_LandCover": ("photo_nord", "photo_sud"),
    "Infrastructures_Ferroviaires": ("nom_gare", "troncon", "type_infra"),
    "Points_Vente_Marches": ("nom_marche",),
    "Reseau_Routier_Pistes": ("nom_voie", "categorie_voie"),
    "Services_Sociaux_Bases": ("nom_etablissement", "domaine_activite"),
    "Activites_autour_gare": ("nom_designation", "type_activite"),
    "Gares": ("nom_gare_detail",),
    "Ouvrage_franchissement": ("nom_repere", "type_ouvrage"),
}
REQUIRED = {"Ground_Truthing_LandCover": ("classe_reelle",)}


@dataclass(frozen=True)
class Variable:
    name: str
    label: str = ""
    type: str = "text"            # text, multiselect, boolean, integer, double, picture
    required: bool = False
    low: float | None = None
    high: float | None = None
    json_name: str | None = None
    values: tuple[str, ...] = ()
    level: str | None = None      # second pack: E required, W recommended


@dataclass(frozen=True)
class Layer:
    name: str
    geometry: str
    id_var: str
    name_var: str | None
    variables: tuple[Variable, ...] = ()
    aliases: tuple[str, ...] = ()
    prefix: str = field(default="")

    def __post_init__(self):
        if not self.prefix:
            object.__setattr__(self, "prefix", self.name[:2].upper())

    @property
    def names(self) -> list[str]:
        return [v.name for v in self.variables]

    def __getitem__(self, name: str) -> Variable:
        return next(v for v in self.variables if v.name == name)


@dataclass(frozen=True)
class ColumnLookup:
    """Every normalised column name that leads to a variable of a layer, and cut names that could mean several."""
    names: dict[str, str]
    ambiguous: frozenset[str]

    def match(self, column: str) -> str | None:
        return self.names.get(plain_name_key(column))


def column_lookup(layer: Layer) -> ColumnLookup:
    """All names that can match, weaker ways first so that stronger ones replace them: the only beginning of that kind among the full names
    (5 to 10 characters), known typing errors, names cut to 10 characters, full names. A name that means several variables means none."""
    meant: dict[str, dict[str, set[str]]] = {"begins": {}, "typo": {}, "cut": {}, "full": {}}
    for v in layer.variables:
        for text in filter(None, (v.name, v.json_name, v.label)):
            meant["full"].setdefault(plain_name_key(text), set()).add(v.name)
            meant["cut"].setdefault(short_name_key(text), set()).add(v.name)
    sure = {k: owners for k, owners in meant["full"].items() if len(owners) == 1}
    for key, owners in sure.items():
        for n in range(5, 11):
            meant["begins"].setdefault(key[:n], set()).update(owners)
    for wrong, right in KNOWN_TYPOS.items():
        if right in layer.names:
            meant["typo"][wrong] = {right}
    names: dict[str, str] = {}
    for way in ("begins", "typo", "cut", "full"):
        names |= {k: next(iter(owners)) for k, owners in meant[way].items() if k and len(owners) == 1 and (way != "begins" or len(k) >= 5)}
    unclear = {k for k, owners in meant["cut"].items() if len(owners) > 1}
    return ColumnLookup(names, frozenset(unclear - set(sure)))


def build_layers(layers: Iterable, variables: Iterable, domains: Iterable) -> dict[str, Layer]:
    """Layers in catalogue order from collected dictionary rows."""
    values: dict[tuple[str, str], list] = {}
    for d in domains:
        values.setdefault((d["layer"], d["variable"]), []).append((int(d["ordre"]), d["value"]))
    fields: dict[str, list] = {}
    for v in variables:
        fields.setdefault(v["layer"], []).append((int(v["ordre"]), v))
    out = {}
    for row in layers:
        name = row["layer"]
        vs = []
        for _, v in sorted(fields.get(name, []), key=lambda p: p[0]):
            var = v["variable"]
            level = "E" if var == row["id_var"] or var in REQUIRED.get(name, ()) else \
                "W" if var in RECOMMENDED.get(name, ()) else None
            vs.append(Variable(
                var, v["label"] or "", v["type"], bool(v["obligatoire"]) and str(v["obligatoire"]).upper() == "TRUE",
                float(v["min"]) if v["min"] else None, float(v["max"]) if v["max"] else None, v["json_name"],
                tuple(x for _, x in sorted(values.get((name, var), []))), level))
        out[name] = Layer(name, row["geometry"], row["id_var"], row["name_var"], tuple(vs),
                          LAYER_ALIASES.get(name, ()))
    return out


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    # a byte-order mark at the start of the header is harmless: the schema is positional
    return spark.read.csv(path, header=True, schema=schema, nullValue="", enforceSchema=True, quote='"', escape='"')


def dictionary_tables(spark: SparkSession, folder: str, layers="layers.csv", variables="variables.csv",
                      domains="domains.csv") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three dictionary tables with typed order and required flag."""
    lay = _csv(spark, f"{folder}/{layers}", LAYERS_SCHEMA)
    var = _csv(spark, f"{folder}/{variables}", VARIABLES_SCHEMA)
    dom = _csv(spark, f"{folder}/{domains}", DOMAINS_SCHEMA)
    return (lay,
            var.withColumns({"ordre": F.col("ordre").cast("int"),
                             "obligatoire": F.coalesce(F.upper("obligatoire") == "TRUE", F.lit(False))}),
            dom.withColumn("ordre", F.col("ordre").cast("int")))


def load_dictionary(spark: SparkSession, folder: str, **files: str) -> dict[str, Layer]:
    lay, var, dom = dictionary_tables(spark, folder, **files)
    # catalogue order decides ties in layer recognition: one small file, read as one ordered partition
    return build_layers(lay.coalesce(1).collect(), var.collect(), dom.collect())


def json_domains(files: DataFrame) -> DataFrame:
    """Value lists from parsed JSON dictionaries (columns ``name`` and ``fields``)."""
    fields = files.select(F.col("name").alias("layer"), F.explode("fields").alias("f"))
    return fields.select("layer", F.col("f.name").alias("field"), F.col("f.dataType").alias("data_type"),
                         F.posexplode_outer("f.values").alias("ordre", "value")) \
        .withColumn("ordre", F.col("ordre") + 1)


def read_json_dictionaries(spark: SparkSession, path: str) -> DataFrame:
    return json_domains(spark.read.schema(JSON_SCHEMA).option("multiLine", True).json(path))


def with_json_values(layers: dict[str, Layer], domains: DataFrame) -> dict[str, Layer]:
    """Take the value lists of the variables from JSON dictionaries, found by their JSON name."""
    lists: dict[tuple[str, str], list] = {}
    for r in domains.filter("value is not null").collect():
        lists.setdefault((r["layer"], r["field"]), []).append((r["ordre"], r["value"]))
    out = {}
    for name, layer in layers.items():
        out[name] = replace(layer, variables=tuple(
            replace(v, values=tuple(x for _, x in sorted(lists.get((name, v.json_name), []))))
            if v.json_name and v.type in ("text", "multiselect") else v for v in layer.variables))
    return out


def dictionary_gaps(layers: DataFrame, fields: DataFrame, domains: DataFrame) -> DataFrame:
    """Layers without a JSON dictionary, and fields whose JSON name the dictionary of their layer lacks.

    ``fields`` has (layer, field, json_name), ``domains`` (layer, field).
    """
    known = domains.select("layer").distinct()
    no_dictionary = layers.select("layer").join(known, "layer", "left_anti") \
        .select("layer", F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("json_name"),
                F.lit("dictionnaire absent").alias("probleme"))
    names = domains.select("layer", F.col("field").alias("json_name")).distinct()
    missing = fields.filter("json_name is not null").join(known, "layer", "left_semi") \
        .join(names, ["layer", "json_name"], "left_anti") \
        .select("layer", "field", "json_name", F.lit("champ introuvable").alias("probleme"))
    return no_dictionary.unionByName(missing)
