"""Connected components of a large edge list, by alternating stars.

Each round hangs every vertex's larger neighbours (large star), then its
smaller ones (small star), on the least vertex it knows. Rounds are written
tables, so a lost executor costs its part of one round. Least neighbours are
partial aggregates; a vertex with very many neighbours is one row per task
there, and its join partners are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorkit.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): least vertex reachable, for vertices of ``edges`` (a, b: bigint).

    Rows with a null end and loops are ignored; repeated edges are harmless;
    no edges give no rows.
    """
    now = written(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            now.select("u", "v").groupBy("u").agg(F.min("v").alias("v"))).filter("u <> v").distinct()
        # Now u > v in every row; hang v and u on the least neighbour of u.
        large = written(large, "edges")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(
            root.select("u", F.col("m").alias("v"))).distinct()
        now = written(small, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == tuple(seen):
            break
        seen = state
    roots = now.select("v").distinct().select(F.col("v").alias("vertex"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(roots)
