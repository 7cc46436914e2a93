"""Distance operators on a metric grid.

Cells have a side of ``distance / sqrt(2)``: two points of one cell are always within the distance, so a
crowded cell is settled by counting. Only pairs of neighbouring non-empty cells are compared, position by
position after copies of one position have been folded into a weight.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.distribution import attach, durable, shuffled

OFFSETS = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if (i, j) != (0, 0)]


def cell_of(east: Column, north: Column, side: float) -> dict[str, Column]:
    return {"_i": F.floor(east / side), "_j": F.floor(north / side)}


def _around(cells: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of neighbouring cells: keys, _i, _j and the neighbour's _ni, _nj."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in OFFSETS])
    reach = cells.select(*keys, "_i", "_j", F.explode(steps).alias("s")) \
        .select(*keys, "_i", "_j", (F.col("_i") + F.col("s.i")).alias("_ni"), (F.col("_j") + F.col("s.j")).alias("_nj"))
    target = others.select(*keys, F.col("_i").alias("_ni"), F.col("_j").alias("_nj")).distinct()
    return reach.join(shuffled(target), [*keys, "_ni", "_nj"])


def _close(distance: float) -> Column:
    dx, dy = F.col("_e") - F.col("_oe"), F.col("_n") - F.col("_on")
    return dx * dx + dy * dy <= distance * distance


def same_object_nearby(points: DataFrame, distance: float, key: str = "_same", group: str = "_grp") -> DataFrame:
    """Mark points with another point of the same key within the distance, other than their own copies.

    ``points`` has the key (empty = never compared), metric ``_e``/``_n`` and ``group`` (null outside
    duplicate groups; members of one group are not reported against each other). Adds ``near``.
    """
    side = distance / math.sqrt(2)
    pts = points.withColumn("_g", F.coalesce(F.col(group), F.lit(-1)).cast("long"))
    spots = pts.filter((F.col(key) != "") & F.col("_e").isNotNull()) \
        .withColumns(cell_of(F.col("_e"), F.col("_n"), side)) \
        .groupBy(key, "_i", "_j", "_e", "_n", "_g").agg(F.count("*").alias("_w"))
    cells = spots.groupBy(key, "_i", "_j").agg(
        F.sum(F.when(F.col("_g") < 0, F.col("_w")).otherwise(0)).alias("loose"),
        F.min(F.when(F.col("_g") >= 0, F.col("_g"))).alias("g0"), F.max(F.when(F.col("_g") >= 0, F.col("_g"))).alias("g1"))
    crowded = (F.col("loose") >= 2) | ((F.col("loose") >= 1) & F.col("g0").isNotNull()) | (F.col("g0") != F.col("g1"))
    cells = cells.select(key, "_i", "_j", F.coalesce(crowded, F.lit(False)).alias("crowded"))
    pairs = _around(cells.filter("not crowded"), cells, [key])
    near_cells = spots.join(shuffled(pairs), [key, "_i", "_j"])
    other = spots.select(key, F.col("_i").alias("_ni"), F.col("_j").alias("_nj"), F.col("_e").alias("_oe"),
                         F.col("_n").alias("_on"), F.col("_g").alias("_og"))
    across = near_cells.join(shuffled(other), [key, "_ni", "_nj"]) \
        .filter(_close(distance) & ((F.col("_g") < 0) | (F.col("_g") != F.col("_og"))))
    inside = spots.join(shuffled(cells.filter("crowded").select(key, "_i", "_j")), [key, "_i", "_j"])
    spot = [key, "_e", "_n", "_g"]
    found = inside.select(*spot, "_w").unionByName(across.select(*spot, "_w")) \
        .groupBy(*spot).agg(F.max("_w").alias("_w"))
    marked = attach(pts, found, spot, "_w")
    return marked.select(*points.columns, F.col("_w").isNotNull().alias("near"))


def neighbours(points: DataFrame, distance: float, order: list[str], label: str) -> DataFrame:
    """Points with at least one other point within the distance: ``n_near`` and one ``partner``.

    ``n_near`` counts every other point in reach, copies included. ``partner`` is the label of the first
    of them in row order (for the first point itself, of the last), so no pair list is produced.
    """
    side = distance / math.sqrt(2)
    points = durable(points)  # read several times below; its metres are costly to repeat
    row = F.struct(*order, F.col(label).alias("_label"))
    spots = points.filter(F.col("_e").isNotNull()).withColumns(cell_of(F.col("_e"), F.col("_n"), side)) \
        .groupBy("_i", "_j", "_e", "_n").agg(F.count("*").alias("_w"), F.min(row).alias("lo"), F.max(row).alias("hi"))
    cells = spots.groupBy("_i", "_j").agg(F.sum("_w").alias("cw"), F.min("lo").alias("clo"), F.max("hi").alias("chi"))
    pairs = _around(cells, cells, [])
    other = spots.select(F.col("_i").alias("_ni"), F.col("_j").alias("_nj"), F.col("_e").alias("_oe"),
                         F.col("_n").alias("_on"), F.col("_w").alias("ow"), F.col("lo").alias("olo"), F.col("hi").alias("ohi"))
    across = spots.join(shuffled(pairs), ["_i", "_j"]).join(shuffled(other), ["_ni", "_nj"]).filter(_close(distance)) \
        .groupBy("_e", "_n").agg(F.sum("ow").alias("ow"), F.min("olo").alias("olo"), F.max("ohi").alias("ohi"))
    reach = spots.join(shuffled(cells), ["_i", "_j"]).join(shuffled(across), ["_e", "_n"], "left").select(
        "_e", "_n", "_w", (F.col("cw") + F.coalesce("ow", F.lit(0)) - 1).alias("n_near"),
        F.least("clo", "olo").alias("lo"), F.greatest("chi", "ohi").alias("hi")).filter("n_near > 0")
    marked = attach(points, reach, ["_e", "_n"], "_w", "inner")
    is_first = F.lit(True)
    for c in order:
        is_first = is_first & F.col(c).eqNullSafe(F.col(f"lo.{c}"))
    return marked.select(*points.columns, "n_near", F.when(is_first, F.col("hi._label")).otherwise(F.col("lo._label")).alias("partner"))


def without_neighbour(source: DataFrame, target: DataFrame, distance: float) -> DataFrame:
    """Rows of ``source`` (metric ``_e``/``_n``) with no row of ``target`` within the distance."""
    side = distance / math.sqrt(2)
    source, target = durable(source), durable(target.select("_e", "_n").distinct())
    spots = source.groupBy("_e", "_n").agg(F.count("*").alias("_w")) \
        .withColumns(cell_of(F.col("_e"), F.col("_n"), side))
    goals = target.select(F.col("_e").alias("_oe"), F.col("_n").alias("_on")).distinct() \
        .withColumns(cell_of(F.col("_oe"), F.col("_on"), side))
    goal_cells = goals.select("_i", "_j").distinct()
    lone = spots.join(shuffled(goal_cells), ["_i", "_j"], "left_anti")
    pairs = _around(lone.select("_i", "_j").distinct(), goal_cells, [])
    near = lone.join(shuffled(pairs), ["_i", "_j"]) \
        .join(shuffled(goals.select(F.col("_i").alias("_ni"), F.col("_j").alias("_nj"), "_oe", "_on")), ["_ni", "_nj"]) \
        .filter(_close(distance)).select("_e", "_n").distinct()
    alone = lone.join(shuffled(near), ["_e", "_n"], "left_anti").select("_e", "_n", "_w")
    return attach(source, alone.withColumn("_alone", F.lit(True)), ["_e", "_n"], "_w", "inner").select(*source.columns)


STEP = 4  # grid levels between two refinements of the nearest-neighbour search


def _shift(column: str, by) -> Column:
    return F.expr(f"shiftright({column}, {by})")


def _block(reach: int) -> Column:
    span = range(-reach, reach + 1)
    return F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in span for j in span]))


def _beatable(pairs: DataFrame, base: float) -> DataFrame:
    """Target cells that may hold the nearest target of some point of the source cell.

    A cell is kept when its nearest possible point is not farther than the farthest possible point of
    another candidate; both follow from the tight extent of the targets in a cell.
    """
    left, low = F.col("_i") * base, F.col("_j") * base
    gap = F.hypot(F.greatest(F.col("x0") - left - base, left - F.col("x1"), F.lit(0.0)),
                  F.greatest(F.col("y0") - low - base, low - F.col("y1"), F.lit(0.0)))
    far = F.hypot(F.greatest(F.col("x1") - left, left + base - F.col("x0")),
                  F.greatest(F.col("y1") - low, low + base - F.col("y0")))
    measured = pairs.select("_i", "_j", "ta", "tb", gap.alias("gap"), far.alias("far"))
    limit = measured.groupBy("_i", "_j").agg(F.min("far").alias("limit"))
    return measured.join(shuffled(limit), ["_i", "_j"]).filter("gap <= limit + 0.001").select("_i", "_j", "ta", "tb")


def nearest_distance(source: DataFrame, target: DataFrame, base: float = 1000.0, levels: int = 16) -> DataFrame:
    """Distance in metres from every source row to its nearest target row, whatever the distance.

    1. For every source cell the smallest of a series of doubling grids whose 3x3 block holds a target
       gives a search radius; all levels are tried in one equi-join on cells.
    2. Target cells in that radius are refined from coarse to fine, keeping those that can still win.
    3. Positions of the kept cells are compared exactly.
    Steps 1 and 2 work on distinct cells, step 3 on distinct positions; a row never meets the targets
    outside the few cells kept for it. With the defaults a search spans 32,000 cells in each direction.
    """
    source, target = durable(source), durable(target.select("_e", "_n").distinct())
    located = F.col("_e").isNotNull() & F.col("_n").isNotNull()
    spots = source.filter(located).groupBy("_e", "_n").agg(F.count("*").alias("_w")) \
        .withColumns(cell_of(F.col("_e"), F.col("_n"), base))
    goals = target.filter(located).select(F.col("_e").alias("_oe"), F.col("_n").alias("_on")).distinct() \
        .withColumns(cell_of(F.col("_oe"), F.col("_on"), base))
    extent = [F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1")]
    grid = {0: goals.groupBy(F.col("_i").alias("ta"), F.col("_j").alias("tb")).agg(
        F.min("_oe").alias("x0"), F.max("_oe").alias("x1"), F.min("_on").alias("y0"), F.max("_on").alias("y1"))}
    for top in range(STEP, levels, STEP):
        grid[top] = grid[top - STEP].groupBy(_shift("ta", STEP).alias("ta"), _shift("tb", STEP).alias("tb")).agg(*extent)

    scale = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("k")
    occupied = grid[0].select("ta", "tb", scale).select("k", _shift("ta", "k").alias("a"), _shift("tb", "k").alias("b")).distinct()
    tried = spots.select("_i", "_j").distinct().select("_i", "_j", scale).select(
        "_i", "_j", "k", _block(1).alias("s")).select(
        "_i", "_j", "k", (_shift("_i", "k") + F.col("s.i")).alias("a"), (_shift("_j", "k") + F.col("s.j")).alias("b"))
    level = tried.join(shuffled(occupied), ["k", "a", "b"], "left_semi").groupBy("_i", "_j").agg(F.min("k").alias("k"))
    # a point of the centre cell reaches every point of its 3x3 block within 2*sqrt(2) cell sides, so its
    # nearest target lies in the 7x7 block of that level
    level = durable(level)
    search = level.select("_i", "_j", "k", _block(3).alias("s")).select(
        "_i", "_j", "k", (_shift("_i", "k") + F.col("s.i")).alias("a"), (_shift("_j", "k") + F.col("s.j")).alias("b"))

    kept = None
    for low in sorted(grid, reverse=True):
        own = F.explode(F.sequence(F.lit(low), F.lit(low + STEP - 1))).alias("k")
        cells = grid[low].select("*", own).withColumns(
            {"a": F.expr(f"shiftright(ta, k - {low})"), "b": F.expr(f"shiftright(tb, k - {low})")})
        pairs = search.filter(F.col("k").between(low, low + STEP - 1)).join(shuffled(cells), ["k", "a", "b"]) \
            .select("_i", "_j", "ta", "tb", "x0", "x1", "y0", "y1")
        if kept is not None:
            parents = kept.select("_i", "_j", F.col("ta").alias("pa"), F.col("tb").alias("pb"))
            children = grid[low].withColumns({"pa": _shift("ta", STEP), "pb": _shift("tb", STEP)})
            pairs = pairs.unionByName(parents.join(shuffled(children), ["pa", "pb"]).select(*pairs.columns))
        kept = durable(_beatable(pairs, base))
    final = spots.join(shuffled(kept), ["_i", "_j"]).join(
        shuffled(goals.select(F.col("_i").alias("ta"), F.col("_j").alias("tb"), "_oe", "_on")), ["ta", "tb"])
    nearest = final.groupBy("_e", "_n").agg(
        F.min(F.hypot(F.col("_e") - F.col("_oe"), F.col("_n") - F.col("_on"))).alias("distance_m"),
        F.max("_w").alias("_w"))
    return attach(source, nearest, ["_e", "_n"], "_w", "left").drop("_w")
