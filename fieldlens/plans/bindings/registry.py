"""Query registry and the survey data derived from the given tables.

The derivations are SQL in the dialect Spark and DuckDB share, so both sides start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dealt_out(rows: DataFrame) -> DataFrame:
    """Rows in as many partitions as shuffles have. A file of one row group, a million rows, is read by one task, and all work on its rows up to the
    next shuffle would stay in it."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def derived(spark: SparkSession, sf: str, sql: str, *tables: str) -> DataFrame:
    """Rows of a shared derivation over the given tables."""
    return spark.sql(sql, **{t: table(spark, sf, t) for t in tables}) if "{" in sql else _with_views(spark, sf, sql, tables)


def _with_views(spark, sf, sql, tables):
    for t in tables:
        table(spark, sf, t).createOrReplaceTempView(t)
    return spark.sql(sql)


# Position of a customer or supplier: spread over the corridor, with missing, zero and swapped ones.
def position(key: str) -> tuple[str, str]:
    lon = f"(8 + (({key} * 7919) % 9500) / 1000.0)"
    lat = f"(2 + (({key} * 104729) % 12500) / 1000.0)"
    x = f"CASE WHEN {key} % 97 = 0 THEN 0.0 WHEN {key} % 89 = 0 THEN NULL WHEN {key} % 83 = 0 THEN {lat} ELSE {lon} END"
    y = f"CASE WHEN {key} % 97 = 0 THEN 0.0 WHEN {key} % 89 = 0 THEN NULL WHEN {key} % 83 = 0 THEN {lon} ELSE {lat} END"
    return f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"


_X, _Y = position("c_custkey")

# One received row per customer, with the usual dirt.
_BASE = f"""
SELECT c_custkey AS k,
 CASE WHEN c_custkey % 53 = 0 THEN ' n/a '
      WHEN c_custkey % 31 = 0 THEN concat('zone', CAST(c_nationkey + 1 AS STRING), 'CL', CAST(c_custkey + 1 AS STRING))
      WHEN c_custkey % 23 = 0 THEN concat('ZONE', CAST(c_nationkey + 1 AS STRING), 'CL1')
      ELSE concat('ZONE', CAST(c_nationkey + 1 AS STRING), 'CL', CAST(c_custkey + 1 AS STRING)) END AS id_client,
 CASE WHEN c_custkey % 41 = 0 THEN 'NULL' WHEN c_custkey % 3 = 0 THEN concat('"', c_name, '"') ELSE concat('  ', c_name, ' ') END AS nom_client,
 CASE WHEN c_custkey % 37 = 0 THEN ''
      WHEN c_custkey % 4 = 0 THEN c_mktsegment
      WHEN c_custkey % 4 = 1 THEN concat(' ', lower(c_mktsegment), '  ')
      WHEN c_custkey % 4 = 2 THEN concat(substring(c_mktsegment, 1, 1), '.', lower(substring(c_mktsegment, 2, 20)))
      ELSE concat(substring(c_mktsegment, 1, 1), lower(substring(c_mktsegment, 2, 20))) END AS segment,
 CASE WHEN c_custkey % 6 = 0 THEN 'Eau; Gaz, fioul' WHEN c_custkey % 6 = 1 THEN 'GAZ, FIOUL, électricité'
      WHEN c_custkey % 6 = 2 THEN 'Eau, Bois' WHEN c_custkey % 6 = 3 THEN 'eau; Eau' WHEN c_custkey % 6 = 4 THEN 'Vapeur' END AS services,
 CASE WHEN c_custkey % 19 = 0 THEN 'inconnu' WHEN c_custkey % 2 = 0 THEN replace(CAST(c_acctbal AS STRING), '.', ',')
      ELSE concat(' ', CAST(c_acctbal AS STRING)) END AS solde,
 CASE WHEN c_custkey % 13 = 0 THEN concat(CAST(c_custkey % 60 AS STRING), '.5') WHEN c_custkey % 7 = 0 THEN NULL
      ELSE CAST(c_custkey % 60 AS STRING) END AS effectif,
 CASE WHEN c_custkey % 8 = 0 THEN 'Oui' WHEN c_custkey % 8 = 1 THEN 'false' WHEN c_custkey % 8 = 2 THEN 'peut-être'
      WHEN c_custkey % 8 = 3 THEN '1' WHEN c_custkey % 8 = 4 THEN 'NON' END AS actif,
 concat('agent ', CAST(c_custkey % 12 AS STRING)) AS agent,
 CASE WHEN c_custkey % 10 = 0 THEN '2031-02-03' WHEN c_custkey % 10 = 1 THEN '05/04/2024 10:30'
      WHEN c_custkey % 10 = 2 THEN '2024-03-09T08:15:00+01:00' WHEN c_custkey % 10 = 3 THEN NULL
      ELSE concat('2024-01-', CAST(10 + c_custkey % 15 AS STRING)) END AS created,
 {_X} AS x, {_Y} AS y
FROM customer"""

# The same objects received again: exact copies written differently, changed copies, and points one metre off.
SURVEY = f"""
SELECT concat('/in/zone', CAST(k % 7 AS STRING), '/clients.kml') AS _path, 'clients.kml' AS _source, k + 1 AS _row_src,
 CAST('2024-05-01' AS DATE) AS _file_date, 'kml' AS _fmt, k, id_client, nom_client, segment, services, solde, effectif, actif,
 agent, created, x, y FROM ({_BASE}) b
UNION ALL
SELECT '/in/copies.shp', 'copies.shp', k + 1, CAST('2024-05-02' AS DATE), 'shp', k, trim(id_client), trim(nom_client),
 upper(segment), services, replace(solde, ',', '.'), effectif, actif, agent, created, x, y FROM ({_BASE}) b WHERE k % 5 = 0
UNION ALL
SELECT '/in/updates.shp', 'updates.shp', k + 1, CAST('2024-05-03' AS DATE), 'shp', k, id_client, nom_client, segment, NULL,
 solde, '7', actif, agent, created, x, y FROM ({_BASE}) b WHERE k % 11 = 0
UNION ALL
SELECT '/in/shifted.kml', 'shifted.kml', k + 1, CAST('2024-05-04' AS DATE), 'kml', k, id_client, nom_client, segment, services,
 solde, effectif, actif, agent, created, x + 0.00001, y FROM ({_BASE}) b WHERE k % 29 = 0"""


# DuckDB spellings of the shared text functions, written independently of the Spark columns.
def sql_value_key(c: str) -> str:
    folded = f"lower(strip_accents(replace(replace(coalesce({c}, ''), '<', ' lt '), '>', ' gt ')))"
    return f"trim(regexp_replace({folded}, '[^a-z0-9]+', ' ', 'g'))"


def sql_clean(c: str) -> str:
    t = f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
    u = f"CASE WHEN length({t}) >= 2 AND starts_with({t}, '\"') AND ends_with({t}, '\"') THEN trim(substring({t}, 2, length({t}) - 2)) ELSE {t} END"
    return f"CASE WHEN lower({u}) IN ('', 'n/a', 'na', 'null', 'none', 'nan') THEN NULL ELSE {u} END"


def sql_number(c: str) -> str:
    t = f"replace(regexp_replace({c}, '\\s', '', 'g'), ',', '.')"
    return f"CASE WHEN regexp_matches({t}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN CAST({t} AS DOUBLE) END"


def sql_phrase_key(c: str) -> str:
    t = f"lower(strip_accents(replace(replace(replace(replace(coalesce({c}, ''), '’', chr(39)), 'œ', 'oe'), 'Œ', 'oe'), '×', 'x')))"
    t = f"regexp_replace({t}, '\\s*[-–—−‐]\\s*', '-', 'g')"
    return f"trim(regexp_replace({t}, '\\s+', ' ', 'g'))"


def sql_utm(source: str, lon: str, lat: str, zone: int, extra: str = "*") -> str:
    """Subquery adding east (e) and north (n) in metres to the rows of ``source``."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    a = 6378137.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    al = (n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440,
          61 * n ** 3 / 240 - 103 * n ** 4 / 140, 49561 * n ** 4 / 161280)
    q = 2 * n ** 0.5 / (1 + n)
    s1 = f"SELECT {extra}, sinh(atanh(sin(radians({lat}))) - {q!r} * atanh({q!r} * sin(radians({lat})))) AS _t, radians({lon} - {6 * zone - 183}) AS _l FROM {source}"
    s2 = f"SELECT *, atan2(_t, cos(_l)) AS _xi, atanh(sin(_l) / sqrt(1 + _t * _t)) AS _eta FROM ({s1})"
    e = " + ".join(["_eta"] + [f"{v!r} * cos({2 * j} * _xi) * sinh({2 * j} * _eta)" for j, v in enumerate(al, 1)])
    m = " + ".join(["_xi"] + [f"{v!r} * sin({2 * j} * _xi) * cosh({2 * j} * _eta)" for j, v in enumerate(al, 1)])
    return f"(SELECT *, 500000 + {0.9996 * a!r} * ({e}) AS e, {0.9996 * a!r} * ({m}) AS n FROM ({s2}))"
