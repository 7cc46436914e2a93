"""Structured Streaming jobs: new files through the row checks, copy flags, and counts per day."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from fieldlens.functions.steps import spread
from fieldlens.operators import checks
from fieldlens.operators.align import harmonise
from fieldlens.operators.checks import Settings
from fieldlens.sources import kml
from fieldlens.sources.dictionary import Layer


def file_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """KML files as they arrive; the checkpoint of the query remembers which were read."""
    return spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary") \
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[kK][mM][lL]") \
        .option("maxFilesPerTrigger", max_files).load(folder)


def feature_stream(files: DataFrame) -> DataFrame:
    named = files.select(F.col("path").alias("_path"), F.to_date("modificationTime").alias("_file_date"),
                         kml.decoded(F.col("content")).alias("value"))
    return kml.parse_placemarks(kml.placemarks(named, "value", ["_path", "_file_date"])) \
        .withColumns({"_source": F.element_at(F.split("_path", "/"), -1), "_fmt": F.lit("kml")})


def row_local_issues(rows: DataFrame, layer: Layer, settings: Settings) -> DataFrame:
    """Issues that need no other row (lists, types, ranges, id format, dates, geometry, rules); batch or stream."""
    work = checks.add_position(checks.add_meta(harmonise(rows, layer), settings))
    done = checks.row_checks(checks.canonicalise(work, layer), layer, settings)
    return spread(done, ["_path", "_row_src", F.col(layer.id_var).alias("id")], "_issues", "seq")


def check_arrivals(rows: DataFrame, layer: Layer, settings: Settings, target: str, checkpoint: str) -> StreamingQuery:
    """Write the row-local issues of arriving rows; runs until what is there has been read."""
    return row_local_issues(rows, layer, settings).writeStream.format("parquet").option("path", target) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_per_task(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key and Arrow batch as ``n_rows``, so that a key sent very often reaches its state as a few rows."""
    def count(batches):
        for batch in batches:
            batch = batch.dropna(subset=keys)
            if len(batch):
                yield batch.groupby(keys, as_index=False).size().rename(columns={"size": "n_rows"})

    return rows.select(*keys).mapInPandas(count, f"{_types(rows, keys)}, n_rows long")


def _types(rows: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)


#: Keys share their state with those of the same hash; the number holds for all runs of a checkpoint, so it is no setting.
BUCKETS = 1024


def _counter(keys: list[str], keep_ms: int):
    """State of a bucket: its keys with their number so far and last arrival, as an Arrow table. All keys of a bucket are counted at once."""
    def stored(table: pd.DataFrame) -> bytes:
        sink = pa.BufferOutputStream()
        arrow = pa.Table.from_pandas(table, preserve_index=False)
        with pa.ipc.new_stream(sink, arrow.schema) as out:
            out.write_table(arrow)
        return sink.getvalue().to_pybytes()

    def count(key, parts, state):
        held = pa.ipc.open_stream(state.get[0]).read_all().to_pandas() if state.exists else None
        if not state.hasTimedOut:
            new = pd.concat([p[[*keys, "n_rows", "arrived_ms"]] for p in parts]).rename(columns={"n_rows": "n", "arrived_ms": "_last"})
            new = new.groupby(keys, as_index=False, sort=False).agg({"n": "sum", "_last": "max"})
            arrived = new[keys].assign(_now=True)
            if held is not None:
                new = pd.concat([held, new]).groupby(keys, as_index=False, sort=False).agg({"n": "sum", "_last": "max"})
                flags = new[new["n"] > 1].merge(arrived, on=keys)
            else:
                flags = new[new["n"] > 1]
            held = new
            if len(flags):
                yield flags[[*keys, "n"]]
        held = held[held["_last"] + keep_ms > state.getCurrentWatermarkMs()]
        if len(held):
            state.update((stored(held),))
            state.setTimeoutTimestamp(int(held["_last"].min()) + keep_ms)
        elif state.exists:
            state.remove()

    return count


def flag_copies(rows: DataFrame, keys: list[str], target: str, checkpoint: str, keep: timedelta | None = None) -> StreamingQuery:
    """Write to ``target`` the keys that arrived more than once, with their number so far, each time they arrive again.

    The numbers are keyed state, so a batch reads its own rows and the state of its own keys, however many batches came before. With ``keep`` a
    timer forgets a key that has not arrived for that long; that state is held for ``BUCKETS`` groups of keys, so that Python is called for groups
    and not for every key, and a batch reads the groups of its keys. Without it the state is a plain streaming aggregate. Rows with a null key are no copies of anything. Every batch writes under its own number, so a repeated batch overwrites itself.
    State beyond memory needs the RocksDB provider, ``spark.sql.streaming.stateStore.providerClass``."""
    if keep is None:
        flags = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    else:
        # The clock of the timers is the time of arrival, so that no row is ever late.
        timed = counts_per_task(rows, keys).withColumn("arrived", F.current_timestamp()).withColumn("arrived_ms", F.unix_millis("arrived"))
        timed = timed.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)))
        flags = timed.withWatermark("arrived", "0 seconds").groupBy("_bucket").applyInPandasWithState(
            _counter(keys, int(keep.total_seconds() * 1000)), f"{_types(rows, keys)}, n long", "counts binary", "update",
            GroupStateTimeout.EventTimeTimeout)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return flags.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def copies(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The keys flagged so far with the number of their latest batch."""
    return spark.read.parquet(target).groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))


def daily_counts(events: DataFrame, time: str, key: str, lateness: str = "2 days") -> DataFrame:
    """Rows per day and key with a watermark, so that state of closed days is dropped; rows later than that are left out, and those without time."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, "1 day").alias("w"), key) \
        .agg(F.count("*").alias("entites")).select(F.to_date("w.start").alias("jour"), key, "entites")


def write_daily_counts(events: DataFrame, time: str, key: str, target: str, checkpoint: str, lateness: str = "2 days") -> StreamingQuery:
    """Append each day's counts once, when the watermark has closed the day."""
    return daily_counts(events, time, key, lateness).writeStream.format("parquet").outputMode("append").option("path", target) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
