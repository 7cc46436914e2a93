"""KML in and out. Reading stays in the JVM: placemarks are cut out of splits of a file and parsed with regex and from_xml."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldlens.functions import geo
from fieldlens.functions.text import xml_text
from fieldlens.operators.distribution import staged

# A tag name may have a namespace prefix; "/" ends an opening tag only before ">". Loops are possessive, so long texts need no stack.
_PREFIX = r"(?:[A-Za-z_][\w.-]*+:)?"
_INSIDE = r"(?:\s(?:[^>/]|/(?!>))*+)?"
PLACEMARK = rf"(?s)<Placemark{_INSIDE}(?:/>|>.*?</Placemark>)"
DATA_SCHEMA = ("struct<Data:array<struct<_name:string,value:string>>,"
               "SchemaData:array<struct<SimpleData:array<struct<_name:string,_VALUE:string>>>>>")
#: Encodings that need no decoding.
_UTF8 = ("", "utf-8", "utf8", "us-ascii", "ascii")


@F.pandas_udf(T.StringType())
def _by_codec(content: pd.Series, encoding: pd.Series) -> pd.Series:
    """Text of bytes in any encoding that Python knows; null for others."""
    def text(raw, name):
        try:
            return None if raw is None else bytes(raw).decode(name, "replace")
        except LookupError:
            return None

    return pd.Series([text(c, e) for c, e in zip(content, encoding)], dtype=object)


@F.pandas_udf(T.BooleanType())
def _is_codec(encoding: pd.Series) -> pd.Series:
    def known(name):
        try:
            return codecs.lookup(name) is not None
        except LookupError:
            return False

    return pd.Series([known(e) for e in encoding], dtype=object)


def _latin(content: Column) -> Column:
    """Every byte as one character."""
    return F.decode(content, "ISO-8859-1")


def _is_wide(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 2)).isin("FFFE", "FEFF")


def declared_encoding(content: Column) -> Column:
    """Encoding that the XML declaration at the head of a file names, in lower case; empty without one."""
    return F.lower(F.regexp_extract(_latin(F.substring(content, 1, 200)), r"^(?:\xEF\xBB\xBF)?\s*<\?xml[^>]*?encoding\s*=\s*[\"']([^\"']+)", 1))


def _text(content: Column, encoding: Column) -> Column:
    plain = F.when(encoding.isin(*_UTF8), content.cast("string"))
    return F.coalesce(plain, _by_codec(F.when(~encoding.isin(*_UTF8), content), encoding))


def decoded(content: Column) -> Column:
    """Text of a file by the encoding that it declares, UTF-8 without one; null if no such encoding is known."""
    text = F.when(_is_wide(content), F.decode(content, "UTF-16")).otherwise(_text(F.when(~_is_wide(content), content), declared_encoding(content)))
    return F.regexp_replace(text, "^\ufeff", "")


def _without_prefixes(xml: Column) -> Column:
    """Drop namespace prefixes and declarations in tags, so that names match whatever the file declares; values stay as they are.

    The text is looked at tag by tag, from "<" to the ">" outside quotes, so the cost is linear in its length."""
    quoted = r"\"[^\"]*+\"|'[^']*+'"

    def clean(part: Column) -> Column:
        tag = F.regexp_extract(part, rf"^(?:[^>\"']|{quoted})*+(?=>)", 0)
        new = F.regexp_replace(F.regexp_replace(tag, rf"^(/?){_PREFIX}", "$1"),
                               rf"\sxmlns(?::[\w.-]+)?\s*=\s*(?:{quoted})|({quoted})|(\s)[A-Za-z_][\w.-]*+:(?=[\w.-]+\s*=)", "$1$2")
        rest = F.substring(part, F.length(tag) + 1, F.length(part))
        return F.when(F.contains(tag, F.lit(":")) & ~F.startswith(part, F.lit("!")), F.concat(new, rest)).otherwise(part)

    parts = F.split(xml, "<", -1)
    return F.array_join(F.transform(parts, lambda part, i: F.when(i == 0, part).otherwise(clean(part))), "<")


def placemarks(files: DataFrame, text: str = "value", keep: list[str] = (), empty: bool = False) -> DataFrame:
    """One row per placemark of each file's text, numbered from 1 in document order, as XML in ``_xml``.

    With ``empty`` a file without placemarks gives one row without number."""
    found = F.regexp_extract_all(_without_prefixes(F.col(text)), F.lit(PLACEMARK), F.lit(0))
    return files.select(*keep, (F.posexplode_outer if empty else F.posexplode)(found).alias("_at", "_xml")).withColumn("_row_src", (F.col("_at") + 1).cast("long")).drop("_at")


KML_NAMES = "*.[kK][mM][lL]"


def _kml_files(spark: SparkSession, format: str, names: str):
    return spark.read.format(format).option("recursiveFileLookup", "true").option("pathGlobFilter", names)


def split_placemarks(spark: SparkSession, path: str, names: str = KML_NAMES) -> tuple[DataFrame, DataFrame]:
    """Placemarks of the KML files below a path, files of any size read by many tasks, and the encodings that are not UTF-8.

    The first table has one row per placemark: ``_path``, ``_file_date``, ``_row_src`` (from 1 in document order) and ``_xml``. The second has
    ``_path``, ``encoding`` and ``known``; files in an unknown encoding have no placemarks.

    A record ends at "Placemark>", so it holds at most one placemark with content, the one that it closes, besides empty ones. What comes first
    in a split is numbered from the counts of the splits before it. UTF-16 files have no such bytes and are one record. A text that holds
    "Placemark>" with a bare ">" is cut there."""
    piece, raw = _latin(F.col("value").cast("binary")), F.col("value").cast("binary")
    bytes_of = lambda x: F.encode(x, "ISO-8859-1")
    none = F.array().cast("array<binary>")
    wide = F.transform(F.regexp_extract_all(_without_prefixes(F.decode(raw, "UTF-16")), F.lit(PLACEMARK), F.lit(0)), lambda x: F.encode(x, "UTF-8"))
    empty = F.transform(F.regexp_extract_all(piece, F.lit(rf"<{_PREFIX}Placemark{_INSIDE}/>"), F.lit(0)), bytes_of)
    opened = F.regexp_extract(piece, rf"(?s)^.*(<{_PREFIX}Placemark\s(?:[^>/]|/(?!>))*+>.*)$", 1)
    closed = F.when(piece.rlike(rf"</{_PREFIX}$"), F.array(bytes_of(F.concat(
        F.when(opened != "", opened).otherwise(F.concat(F.lit("<Placemark>"), piece)), F.lit("Placemark>"))))).otherwise(none)
    head = declared_encoding(raw)
    file = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:///", "file:/")
    records = _kml_files(spark, "text", names).option("lineSep", "Placemark>").load(path).select(
        file.alias("_path"), F.to_date("_metadata.file_modification_time").alias("_file_date"), F.col("_metadata.file_block_start").alias("_block"),
        F.when(_is_wide(raw), wide).otherwise(F.concat(empty, closed)).alias("found"),
        F.when((F.col("_metadata.file_block_start") == 0) & ~_is_wide(raw) & ~head.isin(*_UTF8), head).alias("encoding"))
    cut = staged(records.withColumn("encoding_row", F.when(F.col("encoding").isNotNull(), F.array(F.lit(None).cast("binary")))).select(
        "_path", "_file_date", "_block", "encoding",
        F.posexplode(F.concat(F.coalesce("encoding_row", none), "found")).alias("_k", "data")).select(
            "_path", "_file_date", "_block", F.when(F.col("data").isNull(), F.col("encoding")).alias("encoding"), "data",
            F.monotonically_increasing_id().alias("_at")), "placemarks")
    heads = cut.filter("encoding is not null").select("_path", "encoding").withColumn("known", _is_codec("encoding"))
    rows = cut.filter("data is not null").drop("encoding")
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split of a file
    blocks = rows.groupBy("_path", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")) \
        .select("_path", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = rows.join(blocks, ["_path", "_block"]).withColumn("_row_src", F.col("_at") - F.col("_first") + F.col("_before") + 1)
    text = _text(F.col("data"), F.coalesce("encoding", F.lit("")))
    out = numbered.join(heads.filter("known").drop("known"), "_path", "left") \
        .join(heads.filter("not known").select("_path"), "_path", "left_anti")
    return out.select("_path", "_file_date", "_row_src", _without_prefixes(text).alias("_xml")), heads


def _element(tag: str, inner: str) -> Column:
    """Inner text of the first ``inner`` element below the first ``tag`` element."""
    return F.regexp_extract("_xml", rf"(?s)<{tag}[\s>].*?<{inner}(?:\s[^>]*)?>(.*?)</{inner}>", 1)


def placemark_geometry() -> Column:
    """First point, else first line, else first outer ring; unreadable coordinates give an empty geometry."""
    spot = geo.parse_coordinates(_element("Point", "coordinates"))
    path = geo.parse_coordinates(_element("LineString", "coordinates"))
    ring = geo.parse_coordinates(_element("outerBoundaryIs", "coordinates"))
    has = lambda tag: F.col("_xml").rlike(rf"<{tag}[\s>]")
    none = F.array().cast("array<array<struct<x:double,y:double>>>")

    def build(gtype, parts, good):
        return F.struct(F.lit(gtype).alias("gtype"), F.when(good, parts).otherwise(none).alias("parts")).cast(geo.GEOMETRY)

    return F.when(has("Point"), build("Point", F.array(F.slice(spot, 1, 1)), spot.isNotNull())) \
        .when(has("LineString"), build("LineString", F.array(path), path.isNotNull() & (F.size(path) > 1))) \
        .when(has("outerBoundaryIs"), build("Polygon", F.array(ring), ring.isNotNull() & (F.size(ring) > 3))) \
        .otherwise(build("Point", none, F.lit(False)))


def parse_placemarks(rows: DataFrame) -> DataFrame:
    """Attributes (map), geometry and the flag for several geometries of each placemark."""
    extended = F.regexp_extract("_xml", r"(?s)<ExtendedData(?:\s[^>]*)?>.*</ExtendedData>", 0)
    data = F.from_xml(F.when(extended != "", extended), DATA_SCHEMA, {"ignoreSurroundingSpaces": "false"})
    pair = "array<struct<k:string,v:string>>"
    plain = F.transform(data["Data"], lambda d: F.struct(d["_name"].alias("k"), d["value"].alias("v")))
    simple = F.transform(F.flatten(F.transform(data["SchemaData"], lambda s: s["SimpleData"])),
                         lambda d: F.struct(d["_name"].alias("k"), d["_VALUE"].alias("v")))
    both = F.concat(F.coalesce(plain.cast(pair), F.array().cast(pair)), F.coalesce(simple.cast(pair), F.array().cast(pair)))
    named = F.filter(both, lambda p: p["k"].isNotNull())
    # a repeated name keeps its last value
    last = F.filter(named, lambda p, i: ~F.exists(F.slice(named, i + 2, F.greatest(F.size(named) - i - 1, F.lit(0))),
                                                  lambda q: q["k"] == p["k"]))
    name = F.regexp_extract("_xml", r"(?s)^<Placemark[^>]*>(?:(?!<(?:ExtendedData|Point|LineString|Polygon|MultiGeometry)[\s>]).)*?<name(?:\s[^>]*)?>(.*?)</name>", 1)
    # The parser resolves CDATA sections and character references.
    name = F.coalesce(F.from_xml(F.concat(F.lit("<r><name>"), name, F.lit("</name></r>")), "struct<name:string>", {"ignoreSurroundingSpaces": "false"})["name"], name)
    shapes = F.size(F.regexp_extract_all("_xml", F.lit(r"<(Point|LineString|Polygon)[\s>]"), F.lit(1)))
    return rows.select(*[c for c in rows.columns if c != "_xml"], F.when(name != "", name).alias("placemark_name"),
                       F.map_from_entries(last).alias("attributes"), placemark_geometry().alias("geom"),
                       F.when(shapes > 1, "True").otherwise("False").alias("_multigeom"))


def read_kml(spark: SparkSession, path: str, empty: bool = False, names: str = KML_NAMES) -> DataFrame:
    """Placemarks of all KML files below a path with their provenance; values stay in ``attributes``. ``names`` is the pattern of file names.

    With ``empty`` a file without placemarks gives one row without number, whose ``_encoding`` is set if that is what can't be read."""
    found, heads = split_placemarks(spark, path, names)
    rows = parse_placemarks(found)
    if empty:
        files = _kml_files(spark, "binaryFile", names).load(path).select(F.col("path").alias("_path"), F.to_date("modificationTime").alias("_file_date"))
        rows = rows.withColumn("_encoding", F.lit(None).cast("string")).unionByName(
            files.join(found.select("_path").distinct(), "_path", "left_anti").join(
                heads.filter("not known").select("_path", F.col("encoding").alias("_encoding")), "_path", "left"), allowMissingColumns=True)
    return rows.withColumns({"_source": F.element_at(F.split("_path", "/"), -1), "_fmt": F.lit("kml"), "_crs_assumed": F.lit(False)})


def attribute_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Attributes spread to text columns; ``names`` is the file's list of attribute names."""
    rest = [c for c in df.columns if c != "attributes"]
    return df.select(*[F.col("attributes")[n].alias(n) for n in names], *rest)


def attribute_names(df: DataFrame) -> DataFrame:
    """(_path, name) of every attribute that occurs in a file."""
    return df.select("_path", F.explode(F.map_keys("attributes")).alias("name")).distinct()


def placemark_text(df: DataFrame, id_var: str, attributes: list[str] | None = None) -> Column:
    """KML element of a row: label, non-empty attributes and geometry."""
    attributes = attributes or [c for c in df.columns if c != "geom"]
    data = [F.when(F.col(f"`{c}`").isNotNull() & (F.col(f"`{c}`").cast("string") != ""), F.concat(
        F.lit('<Data name="'), xml_text(F.lit(c)), F.lit('"><value>'), xml_text(F.col(f"`{c}`").cast("string")),
        F.lit("</value></Data>"))).otherwise("") for c in attributes]
    label = F.coalesce(F.col(id_var).cast("string"), F.lit(""))
    return F.concat(F.lit("<Placemark><name>"), xml_text(label), F.lit("</name><ExtendedData>"), *data,
                    F.lit("</ExtendedData>"), geo.kml_geometry(F.col("geom")), F.lit("</Placemark>"))


def kml_lines(df: DataFrame, layer: str, id_var: str) -> DataFrame:
    """Placemarks of a layer as text, rows without a position left out."""
    return df.filter(~geo.is_empty(F.col("geom"))).select(F.lit(layer).alias("layer"), placemark_text(df, id_var).alias("value"))


HEAD = '<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>'


def write_kml(df: DataFrame, layer: str, id_var: str, path: str) -> None:
    """KML documents of a layer: every task writes one well-formed document, so any size is exported in parallel."""
    lines = kml_lines(df, layer, id_var)
    head, foot = f"{HEAD}{layer}</name><Folder><name>{layer}</name>", "</Folder></Document></kml>"

    def wrap(batches):
        first = True
        for batch in batches:
            values = batch["value"]
            if len(values):
                if first:
                    values = values.copy()
                    values.iloc[0] = head + values.iloc[0]
                    first = False
                yield values.to_frame()
        if not first:
            import pandas as pd
            yield pd.DataFrame({"value": [foot]})

    lines.select("value").mapInPandas(wrap, "value string").write.mode("overwrite") \
        .option("maxRecordsPerFile", 0).text(path)
