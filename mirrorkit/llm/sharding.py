"""Uniform shuffle into shards of exact sizes, by a drawn communication matrix.

A uniform random deal of N rows to K shards of given sizes sends random counts
from each input partition to each shard. Those counts follow a multivariate
hypergeometric law, so they are drawn first, exactly, from the partition sizes
alone; rows follow them afterwards:

1. *Permute locally*: each task sorts its rows by a random number and numbers
   them. The rows are written with their numbers, which fixes the draw.
2. *Draw the matrix*: partitions are halved again and again (a binary tree);
   a node's counts per shard are split between its halves by hypergeometric
   draws. A level is one small join, and no task sees all partitions.
3. *Exchange*: a row's number within its partition and the partition's counts
   tell its shard.
4. *Permute again*: in a shard, rows fall into blocks by a second random
   number and are sorted by it within the block; offsets come from block
   counts. Blocks hold about ``block_rows`` rows at any size, so no shard is
   ever sorted by one task.

All steps are DataFrame operations and SQL expressions.

Defined results: every row, repeated or with nulls, takes exactly one slot;
shard sizes differ by at most one; an empty table gives no rows. Input columns
are carried in a struct, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mirrorkit.llm.common import written

BLOCK_ROWS = 100_000
_TASK_SHIFT = 33  # monotonically_increasing_id: task in the upper bits, row number below


def _hypergeometric(good: str, bad: str, draws: str, u: str) -> str:
    """SQL: how many of ``draws`` rows, drawn without replacement, are ``good``.

    Inversion from the mode outwards with the ratio of neighbouring weights,
    over all of the support that has weight in double precision (10 standard
    deviations and 30 more): no factorials, hence no rounding at large counts.
    """
    return f"""
    transform(array(named_struct('g', double({good}), 'b', double({bad}), 'n', double({draws}), 'u', {u})), q ->
      transform(array(named_struct('lo', greatest(0D, q.n - q.b), 'hi', least(q.n, q.g),
        'mode', least(least(q.n, q.g), greatest(greatest(0D, q.n - q.b), floor((q.n + 1) * (q.g + 1) / (q.g + q.b + 2)))),
        'w', 30 + ceil(10 * sqrt(greatest(0D, q.n * (q.g / greatest(1D, q.g + q.b)) * (q.b / greatest(1D, q.g + q.b))))))), s ->
        transform(array(named_struct(
          'up', aggregate(sequence(0L, bigint(least(s.w, s.hi - s.mode))), named_struct('p', 1D, 'sum', 0D), (a, i) ->
            named_struct('p', a.p * (q.g - (s.mode + i)) * (q.n - (s.mode + i)) / ((s.mode + i + 1) * (q.b - q.n + s.mode + i + 1)),
                         'sum', a.sum + a.p), a -> a.sum),
          'down', aggregate(sequence(0L, bigint(least(s.w, s.mode - s.lo))), named_struct('p', 1D, 'sum', 0D), (a, i) ->
            named_struct('p', a.p * (s.mode - i) * (q.b - q.n + s.mode - i) / ((q.g - (s.mode - i) + 1) * (q.n - (s.mode - i) + 1)),
                         'sum', a.sum + a.p), a -> a.sum - 1))), t ->
          CASE WHEN q.u * (t.up + t.down) < t.up THEN
            bigint(aggregate(sequence(0L, bigint(least(s.w, s.hi - s.mode))), named_struct('p', 1D, 'sum', 0D, 'x', 0D), (a, i) ->
              named_struct('p', a.p * (q.g - (s.mode + i)) * (q.n - (s.mode + i)) / ((s.mode + i + 1) * (q.b - q.n + s.mode + i + 1)),
                           'sum', a.sum + a.p,
                           'x', CASE WHEN a.sum <= q.u * (t.up + t.down) THEN s.mode + i ELSE a.x END), a -> a.x))
          ELSE
            bigint(aggregate(sequence(0L, bigint(least(s.w, s.mode - s.lo))), named_struct('p', 1D, 'sum', t.up - 1, 'x', s.mode), (a, i) ->
              named_struct('p', a.p * (s.mode - i) * (q.b - q.n + s.mode - i) / ((q.g - (s.mode - i) + 1) * (q.n - (s.mode - i) + 1)),
                           'sum', a.sum + a.p,
                           'x', CASE WHEN i > 0 AND a.sum <= q.u * (t.up + t.down) THEN s.mode - i ELSE a.x END), a -> a.x))
          END)[0])[0])[0]"""


def _left_counts(seed: int) -> str:
    """SQL: counts per shard of a node's left half, from ``counts`` and ``n_left``."""
    u = f"(shiftrightunsigned(xxhash64({seed}L, level, node, k), 11) + 0.5D) / 9007199254740992D"
    draw = _hypergeometric("counts[k]", "a.rest - counts[k]", "a.todo", u)
    total = "aggregate(counts, 0L, (x, y) -> x + y)"
    return f"""aggregate(sequence(0, size(counts) - 1),
        named_struct('todo', n_left, 'rest', {total}, 'out', cast(array() as array<bigint>)),
        (a, k) -> transform(array({draw}), x -> named_struct(
            'todo', a.todo - x, 'rest', a.rest - counts[k], 'out', concat(a.out, array(x))))[0],
        a -> a.out)"""


def communication_matrix(spark: SparkSession, sizes: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(part, counts): rows each partition sends to each shard.

    ``sizes`` has (part, n) with parts from 0. Column sums are the shard sizes
    (at most one apart), row sums the partition sizes; the draw is uniform
    over all deals of rows to shards.
    """
    top = sizes.agg(F.max("part").alias("last"), F.sum("n").alias("rows")).first()
    if top["rows"] is None:
        return spark.createDataFrame([], "part bigint, counts array<bigint>")
    levels = int(top["last"]).bit_length()
    shard_sizes = [top["rows"] // n_shards + (k < top["rows"] % n_shards) for k in range(n_shards)]
    nodes = spark.range(1).select(
        F.col("id").alias("node"), F.array(*[F.lit(s).cast("bigint") for s in shard_sizes]).alias("counts"))
    for level in range(levels - 1, -1, -1):
        halves = sizes.groupBy(F.shiftright("part", level).alias("child")).agg(F.sum("n").alias("n_left"))
        nodes = nodes.join(halves, F.col("child") == F.col("node") * 2, "left").select(
            "node", "counts", F.coalesce("n_left", F.lit(0)).alias("n_left"), F.lit(level).alias("level"))
        nodes = nodes.select("node", "counts", F.expr(_left_counts(seed)).alias("left"))
        nodes = nodes.select("node", "counts", "left", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).select(
            (F.col("node") * 2 + F.col("side")).alias("node"),
            F.when(F.col("side") == 0, F.col("left")).otherwise(
                F.zip_with("counts", "left", lambda all_, left: all_ - left)).alias("counts"))
    return nodes.withColumnRenamed("node", "part")


def shuffle_to_shards(rows: DataFrame, n_shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """row (struct of the input columns), shard (0 to n_shards - 1), slot (gapless from 0 in each shard)."""
    spark = rows.sparkSession
    local = rows.select(F.struct("*").alias("row"), F.rand(seed).alias("u"), F.rand(seed + 1).alias("v"))
    local = local.sortWithinPartitions("u").withColumn("at", F.monotonically_increasing_id()).drop("u")
    local = written(local, "shard-rows")

    part = F.shiftright("at", _TASK_SHIFT)
    sizes = written(local.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")), "shard-sizes")
    matrix = written(communication_matrix(spark, sizes, n_shards, seed), "shard-matrix")
    bounds = matrix.select(
        "part", F.expr("transform(counts, (c, k) -> aggregate(slice(counts, 1, k + 1), 0L, (x, y) -> x + y))").alias("bounds"))
    number = F.col("at").bitwiseAND(F.lit((1 << _TASK_SHIFT) - 1))
    sent = local.withColumn("part", part).withColumn("number", number).join(bounds, "part").withColumn(
        "shard", F.expr("size(filter(bounds, b -> b <= number))")).select("row", "v", "at", "shard")

    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // (n_shards * block_rows)))
    sent = sent.withColumn("block", F.least(F.floor(F.col("v") * blocks), F.lit(blocks - 1)).cast("int"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = sent.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("rows")).select(
        "shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("shard", "block").orderBy("v", "at")
    return sent.withColumn("slot", F.row_number().over(order).cast("bigint") - 1).join(
        first, ["shard", "block"]).select("row", "shard", (F.col("slot") + F.col("first")).alias("slot"))
