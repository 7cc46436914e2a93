"""Zip archives of survey files, expanded by Spark tasks and each only once.

Archives are handed out as paths with their size; each task opens its archives one at a time and emits their members, so no content passes through
the driver. A store keeps the members under path, size and change time of their archive: a later run opens only archives that the store does not
have, and reads the members of all archives that are there now. Older versions of an archive stay in the store unread.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

#: An archive with another size or change time is another archive.
KEY = ["path", "length", "modificationTime"]
MEMBER_SCHEMA = ("archive string, member string, flat_name string, size long, modified timestamp, content binary, error string, "
                 "length long, modificationTime timestamp")


def _flat_name(member: str) -> str:
    """Member name without folders, so that nothing can be written outside the target folder."""
    return re.sub(r"[^\w.\-]+", "_", member.replace("/", "__"))


def _members(archive: str, content: bytes, limit: int | None) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            entries = [i for i in z.infolist() if not i.is_dir()]
            if limit is not None and sum(i.file_size for i in entries) > limit:
                yield archive, None, None, None, None, None, "Archive trop volumineuse"
                return
            for i in entries:
                if "__MACOSX" not in i.filename:
                    yield archive, i.filename, _flat_name(i.filename), i.file_size, pd.Timestamp(*i.date_time), z.read(i), None
    except Exception as e:  # an unreadable archive is reported, the others go on
        yield archive, None, None, None, None, None, f"ZIP illisible : {type(e).__name__}"


def expand_archives(archives: DataFrame, limit: int | None = None) -> DataFrame:
    """Members of zip archives given as (path, length, modificationTime, content); one row with ``error`` for an archive that fails, and one without
    member for an archive that has none.

    Nothing is too large by itself; ``limit`` bounds the unpacked bytes where a user sets it.

    Members are emitted in small batches: memory holds one archive and one batch, not a partition.
    """
    columns = [c.split()[0] for c in MEMBER_SCHEMA.split(", ")]

    def expand(batches):
        for batch in batches:
            for path, length, changed, content in zip(*(batch[c] for c in (*KEY, "content"))):
                rows, held, empty = [], 0, True
                for row in _members(path, bytes(content), limit):
                    rows.append((*row, length, changed))
                    held += row[3] or 0
                    empty = False
                    if held > 64 * 1024 ** 2:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
                if empty:
                    rows.append((path, *(None,) * 6, length, changed))
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return archives.select(*KEY, "content").mapInPandas(expand, MEMBER_SCHEMA)


def _zip_files(spark: SparkSession) -> DataFrameReader:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[zZ][iI][pP]")


def read_archives(spark: SparkSession, folder: str, store: str | None = None) -> DataFrame:
    """Members of the zip archives below a folder. With a ``store`` only archives that it does not have are opened, and their members added to it."""
    files = _zip_files(spark).load(folder)
    if store is None:
        return expand_archives(files)

    def contents(new: DataFrame) -> DataFrame | None:
        # Names only, of the new archives; the listing of a folder is on the driver in any case.
        paths = [re.sub(r"([\\\[\]{}*?,^])", r"\\\1", r["path"]) for r in new.select("path").toLocalIterator()]
        return spark.read.format("binaryFile").load(paths) if paths else None

    return update_store(files.select(*KEY), contents, store)


def update_store(listing: DataFrame, contents: Callable[[DataFrame], DataFrame | None], store: str, limit: int | None = None) -> DataFrame:
    """Members of all archives of ``listing``, after those that ``store`` lacks have been expanded and added to it.

    ``contents`` gives the rows of some listed archives with their content, or None if there are none. An update is one write, so after a
    failure the next run finds either all of it or nothing."""
    spark = listing.sparkSession
    new = unseen(listing, stored_members(spark, store).select(F.col("archive").alias("path"), "length", "modificationTime").distinct())
    found = contents(new)
    if found is not None:
        expand_archives(found, limit).write.parquet(f"{store}/update={uuid.uuid4().hex}")
    known = listing.select(F.col("path").alias("archive"), "length", "modificationTime").distinct()
    return stored_members(spark, store).join(known, ["archive", "length", "modificationTime"], "left_semi")


def stored_members(spark: SparkSession, store: str) -> DataFrame:
    """All members that a store has, of any version of their archives; none if it has not been written yet."""
    try:
        return spark.read.parquet(store)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], f"{MEMBER_SCHEMA}, update string")


def unseen(archives: DataFrame, done: DataFrame) -> DataFrame:
    """Archives not expanded before, known by path, size and change time."""
    return archives.join(done, KEY, "left_anti")


def archive_errors(members: DataFrame) -> DataFrame:
    """(path, error) of the archives that could not be read."""
    return members.filter("error is not null").select(F.col("archive").alias("path"), "error")


def member_kind(members: DataFrame) -> DataFrame:
    """Members with their extension and the ``archive!member`` origin."""
    return members.filter("error is null and member is not null").select(
        F.concat_ws("!", "archive", "member").alias("path"), F.lower(F.regexp_extract("member", r"\.([^.]*)$", 1)).alias("ext"),
        "size", F.to_date("modified").alias("file_date"), "content")
