"""Copy flags whose keys share a state: many keys a call, key by key forgotten."""

import time
from datetime import date, timedelta

import pandas as pd

from fieldlens.streaming import landing


def test_python_is_called_for_groups_of_keys(spark, tmp_path):
    class State:
        """What the counter asks of a state."""
        exists, hasTimedOut, get, timer = False, False, None, None

        def update(self, value):
            self.get, self.exists = value, True

        def setTimeoutTimestamp(self, at):
            self.timer = at

        def getCurrentWatermarkMs(self):
            return self.clock

        def remove(self):
            self.exists = False

    state, count = State(), landing._counter(["k", "d"], 100)
    rows = lambda *r: iter([pd.DataFrame([x], columns=["k", "d", "n_rows", "arrived_ms"]) for x in r])
    first, other = date(2024, 1, 1), date(2024, 1, 2)
    state.clock = 0
    got = pd.concat(count((0,), rows(("a", first, 1, 50), ("a", other, 2, 50), ("b", first, 1, 50), ("b", first, 3, 50)), state))
    assert sorted(got.itertuples(index=False, name=None)) == [("a", other, 2), ("b", first, 4)] and state.timer == 150
    state.clock = 50
    got = pd.concat(count((0,), rows(("a", first, 1, 120)), state))
    assert list(got.itertuples(index=False, name=None)) == [("a", first, 2)] and state.timer == 150
    # the timer of (a, other) and (b, first) is over, that of (a, first) is not
    state.clock, state.hasTimedOut = 150, True
    assert list(count((0,), iter([]), state)) == [] and state.exists and state.timer == 220
    state.hasTimedOut = False
    got = pd.concat(count((0,), rows(("a", first, 1, 160), ("b", first, 2, 160)), state))
    assert sorted(got.itertuples(index=False, name=None)) == [("a", first, 3), ("b", first, 2)]
    state.clock, state.hasTimedOut = 300, True
    assert list(count((0,), iter([]), state)) == [] and not state.exists


def test_many_keys_over_arrivals(spark, tmp_path):
    target = str(tmp_path / "flags")
    calls = len(spark.range(5000).selectExpr("pmod(xxhash64(id), 1024) AS b").distinct().collect())
    assert calls <= landing.BUCKETS
    for part in range(2):
        spark.range(5000 - 1000 * part).selectExpr("id AS k", "cast(id % 3 AS string) AS v").write.mode("append").parquet(str(tmp_path / "in"))
        landing.flag_copies(spark.readStream.schema("k long, v string").parquet(str(tmp_path / "in")), ["k", "v"], target, str(tmp_path / "check"),
                            timedelta(days=1)).awaitTermination()
        time.sleep(0.01)
    got = landing.copies(spark, target, ["k", "v"]).collect()
    assert len(got) == 4000 and {r.n for r in got} == {2} and max(r.k for r in got) == 3999
