"""Copy flags over several arrivals, with and without forgetting, and counts of closed days."""

import time
from datetime import datetime, timedelta

from fieldlens.streaming import landing


def _arrive(spark, tmp_path, rows, schema, job):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
    job(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).awaitTermination()


def _flags(spark, tmp_path, arrivals, keep, wait=0.0):
    target = str(tmp_path / "flags")
    for rows in arrivals:
        _arrive(spark, tmp_path, rows, "k long, v string",
                lambda s: landing.flag_copies(s, ["k", "v"], target, str(tmp_path / "check"), keep))
        time.sleep(wait)
    return {(r.k, r.v): r.n for r in landing.copies(spark, target, ["k", "v"]).collect()}


def test_copies_over_arrivals(spark, tmp_path):
    arrivals = [[(1, "a")] * 40 + [(2, "a"), (None, "a"), (3, None)], [(2, "a"), (4, "b"), (None, "a"), (3, None)], [(1, "a"), (5, "c"), (4, "B")]]
    want = {(1, "a"): 41, (2, "a"): 2}
    (tmp_path / "plain").mkdir()
    (tmp_path / "timed").mkdir()
    assert _flags(spark, tmp_path / "plain", arrivals, None) == want
    assert _flags(spark, tmp_path / "timed", arrivals, timedelta(days=1)) == want


def test_keys_are_forgotten(spark, tmp_path):
    # the second arrival moves the clock on, the third comes after the timer of (1, a)
    got = _flags(spark, tmp_path, [[(1, "a")], [(2, "b")], [(1, "a"), (2, "b"), (2, "b")]], timedelta(milliseconds=1), wait=0.2)
    assert (1, "a") not in got and got[2, "b"] >= 2


def test_days_close_once(spark, tmp_path):
    day = lambda d, h=12: datetime(2024, 1, d, h)
    schema, target = "t timestamp, k string", str(tmp_path / "days")
    job = lambda s: landing.write_daily_counts(s, "t", "k", target, str(tmp_path / "check"), "1 day")
    _arrive(spark, tmp_path, [(day(1), "a"), (day(1), "a"), (day(2), "b"), (day(4), "a"), (None, "a")], schema, job)
    _arrive(spark, tmp_path, [(day(2), "b"), (day(3), "b"), (day(4), "a"), (day(9), "a")], schema, job)  # the second of January is closed
    got = sorted((str(r.jour), r.k, r.entites) for r in spark.read.parquet(target).collect())
    assert got == [("2024-01-01", "a", 2), ("2024-01-02", "b", 1), ("2024-01-03", "b", 1), ("2024-01-04", "a", 2)]
