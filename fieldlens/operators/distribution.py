"""Building blocks that keep group work spread over the cluster when one key dominates.

A single key may hold a third of all rows. Group facts are therefore computed with aggregates (partial
aggregation shrinks a hot key before the shuffle) and brought back to the rows with ``attach``; no group is
ever collected in a task or sorted as one window partition.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# At most this many keys are broadcast as hot. A key outside the list holds < 1/1000 of the rows.
HOT_KEYS = 1000
# Below this many rows a key is not worth special treatment.
HOT_ROWS = 100_000
SALTS = 256


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage (``spark.checkpoint.dir``)."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="fieldlens-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        durable(spark.range(0))  # sets the folder of a local session
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet on shared storage and read back, so that every consumer reads the columns it needs."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast. Spark's estimate does not know how many rows ``explode`` makes of one or how far a file
    is compressed, so a table that grows with the rows would pass through the driver as long as its source is small."""
    return df.hint("merge")


def _same(left: DataFrame, right: DataFrame, pairs) -> Column:
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & (left[a] == right[b])
    return condition


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, how: str = "left") -> DataFrame:
    """Join one-row-per-key ``facts`` back to ``rows`` without moving a hot key to one task.

    ``weight`` is the facts column with the number of rows behind a key. The heaviest keys (at most
    ``HOT_KEYS``, so the broadcast is bounded by construction) meet their rows in a map-side join; the
    rows of those keys get random-like salts in the shuffled join for all other keys, where nothing
    matches them. Keys must be non-null in facts; rows with a null key simply do not match.
    """
    facts = facts.filter(" and ".join(f"`{k}` is not null" for k in keys))
    values = [c for c in facts.columns if c not in keys]
    hot = facts.filter(F.col(weight) >= HOT_ROWS).orderBy(F.desc(weight), *keys).limit(HOT_KEYS)
    hot = hot.select(*[F.col(k).alias(f"_hk_{k}") for k in keys],
                     F.struct(*values).alias("_hot"))
    rows_h = rows.join(F.broadcast(hot), _same(rows, hot, [(k, f"_hk_{k}") for k in keys]), "left") \
        .drop(*[f"_hk_{k}" for k in keys])
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)).cast("int") + 1
    rows_h = rows_h.withColumn("_salt", F.when(F.col("_hot").isNotNull() | null_key, spread).otherwise(0))
    # never a constant for the optimiser: a folded salt would leave the join keys skewed
    cold = facts.select(*[F.col(k).alias(f"_ck_{k}") for k in keys],
                        F.when(F.col(weight) < 0, -1).otherwise(0).alias("_csalt"),
                        F.struct(*values).alias("_cold"))
    joined = rows_h.join(cold, _same(rows_h, cold, [(k, f"_ck_{k}") for k in keys] + [("_salt", "_csalt")]), "left")
    out = joined.withColumn("_fact", F.coalesce("_hot", "_cold"))
    if how == "inner":
        out = out.filter(F.col("_fact").isNotNull())
    return out.select(*rows.columns, *[F.col(f"_fact.{v}").alias(v) for v in values if v not in rows.columns])


def number_in_order(df: DataFrame, order: list[Column], per: list[str] = (), name: str = "n") -> DataFrame:
    """Number rows 1..n following ``order`` (restarting for every ``per`` value) without a one-task window.

    Rows are range-partitioned and sorted; a partition's first number is the count of rows in the
    partitions before it. The placement is written to reliable storage first, since the counts and the
    rows must see the same one even after a lost executor.
    """
    spark: SparkSession = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(p) for p in per] + list(order)
    placed = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    placed = durable(placed.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_block", F.shiftright("_at", 33))
    blocks = placed.groupBy("_block", *per).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    # one row per partition and `per` value in it: partitions + number of values, not rows
    before = Window.partitionBy(*per).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))) \
        .select(*[F.col(p).alias(f"_p_{p}") for p in per], F.col("_block").alias("_b"), "_first", "_before")
    condition = placed["_block"] == blocks["_b"]
    for p in per:
        condition = condition & placed[p].eqNullSafe(blocks[f"_p_{p}"])
    if not per:
        blocks = F.broadcast(blocks)  # as many rows as range partitions
    out = placed.join(blocks, condition)
    return out.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias(name))


def with_salt(rows: DataFrame, counts: DataFrame, keys: list[str], weight: str, many: bool) -> DataFrame:
    """Add ``_salt`` for an equi-join whose ``many`` side has hot keys.

    On the many side rows of a hot key are spread over ``SALTS`` values, on the other side they are
    repeated for each of them; every other key gets salt 0 on both sides.
    """
    hot = counts.filter(F.col(weight) >= HOT_ROWS).orderBy(F.desc(weight), *keys).limit(HOT_KEYS) \
        .select(*[F.col(k).alias(f"_hk_{k}") for k in keys], F.lit(True).alias("_is_hot"))
    out = rows.join(F.broadcast(hot), _same(rows, hot, [(k, f"_hk_{k}") for k in keys]), "left")
    if many:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)).cast("int")
        salt = F.when(F.col("_is_hot"), spread).otherwise(0)
    else:
        salt = F.explode(F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    return out.select(*rows.columns, salt.alias("_salt"))
