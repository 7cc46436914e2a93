"""Incremental jobs: copy flags from keyed state and counts of closed days over events that arrive in three parts, and archives opened once.

Each part of the events is written as files and the job is run on what is there, so the second and third run go on from the checkpoint of the first.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldlens.operators.distribution import shared_path
from fieldlens.plans.bindings.registry import query, table
from fieldlens.sources import archive
from fieldlens.streaming import landing


def in_parts(rows: DataFrame, part: Column, job: Callable[[DataFrame, str], StreamingQuery]) -> str:
    """Run ``job`` after each part (0, 1, 2) of ``rows`` has arrived; returns the folder that the job writes below."""
    spark = rows.sparkSession
    base = shared_path(spark, "stream")
    for k in range(3):
        rows.filter(part == k).write.mode("append").parquet(f"{base}/in")
        job(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), base).awaitTermination()
    return base


# An event sent again: the same user and hour.
KEYS = ["user_id", "heure"]


@query("copies_streamed", "SELECT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS heure, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def copies_streamed(spark, sf):
    rows = table(spark, sf, "events").select("user_id", F.floor(F.unix_timestamp("ts") / 3600).alias("heure"), "event_id")
    base = in_parts(rows, F.col("event_id") % 3, lambda stream, at: landing.flag_copies(stream, KEYS, f"{at}/flags", f"{at}/checkpoint", timedelta(days=1)))
    return landing.copies(spark, f"{base}/flags", KEYS)


# Events arrive in thirds of the month, each seventh one a part late; a day is closed two days after it for later parts.
PARTS = """SELECT *, least(2, CAST(floor((day(ts) - 1) / 10) AS INT) + CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END) AS part FROM events"""


@query("daily_counts_streamed", f"""WITH p AS ({PARTS}), w AS (SELECT b.k, max(ts) - INTERVAL 2 DAY AS mark FROM p, (VALUES (0), (1), (2)) b(k) WHERE part <= b.k GROUP BY b.k)
 SELECT CAST(ts AS DATE) AS jour, event_type, count(*) AS entites FROM p WHERE date_trunc('day', ts) + INTERVAL 1 DAY > coalesce((SELECT mark FROM w WHERE k = part - 1), TIMESTAMP '1970-01-01')
 AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT mark FROM w WHERE k = 2) GROUP BY ALL""")
def daily_counts_streamed(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("events")
    rows = spark.sql(PARTS).select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "part")
    base = in_parts(rows, F.col("part"), lambda stream, at: landing.write_daily_counts(stream, "ts", "event_type", f"{at}/days", f"{at}/checkpoint"))
    return spark.read.parquet(f"{base}/days")


def zipped(parts: DataFrame) -> DataFrame:
    """One zip archive per ``path`` and ``modificationTime`` with the texts as members, as a file source gives it."""
    import io
    import zipfile

    import pandas as pd

    def pack(key, rows):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            for member, text in zip(rows["member"], rows["text"]):
                z.writestr(zipfile.ZipInfo(member, (2024, 1, 1, 10, 0, 0)), text)
        return pd.DataFrame([(*key, len(buffer.getvalue()), buffer.getvalue())], columns=["path", "modificationTime", "length", "content"])

    return parts.groupBy("path", "modificationTime").applyInPandas(pack, "path string, modificationTime timestamp, length long, content binary")


@query("archives_opened_once", """WITH d AS (SELECT doc_id, doc_id // 25 AS a, coalesce(text, '') AS t FROM documents)
 SELECT '/in/a' || CAST(a AS VARCHAR) || '.zip' AS archive, 'lot/d' || CAST(doc_id AS VARCHAR) || '.kml' AS member, CAST(octet_length(encode(t)) + CASE WHEN a % 5 = 2 THEN 3 ELSE 0 END AS BIGINT) AS size,
  CASE WHEN a % 4 = 3 OR a % 5 = 2 THEN 'second' ELSE 'first' END AS opened_in FROM d""")
def archives_opened_once(spark, sf):
    number = F.floor(F.col("doc_id") / 25)
    members = table(spark, sf, "documents").select(
        number.alias("a"), F.concat(F.lit("/in/a"), number.cast("string"), F.lit(".zip")).alias("path"),
        F.concat(F.lit("lot/d"), F.col("doc_id").cast("string"), F.lit(".kml")).alias("member"), F.coalesce("text", F.lit("")).alias("text"))
    store, changed = shared_path(spark, "members"), F.col("a") % 5 == 2
    # of the second listing every fourth archive is new and every fifth has been sent again with longer texts
    first = members.filter("a % 4 <> 3").withColumn("modificationTime", F.timestamp_seconds(F.lit(1704103200)))
    second = members.withColumns({"modificationTime": F.timestamp_seconds(F.when(changed, 1704189600).otherwise(1704103200)),
                                  "text": F.concat("text", F.when(changed, " v2").otherwise(""))})
    for listing in (zipped(first), zipped(second)):
        earlier = archive.stored_members(spark, store).select("update").distinct().withColumnRenamed("update", "_met")
        now = archive.update_store(listing.select(*archive.KEY), lambda new, files=listing: files.join(new, archive.KEY, "left_semi"), store)
    return now.join(F.broadcast(earlier), F.col("update") == F.col("_met"), "left").select(  # one row per update
        "archive", "member", "size", F.when(F.col("_met").isNull(), "second").otherwise("first").alias("opened_in"))
