"""Before/after comparison of a mirror's files: touched, new and stale.

All inputs are file manifests (one row per file, see
``sources.listing.file_manifest``). Comparisons are anti/semi joins on the
relative path or on the partition folder text, which also matches the null
partition exactly, and on the table name where manifests of several tables
are united. Which join Spark uses is left to it: manifests and folder lists
are small, but nothing here proves it. A partition with a great many files
is split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION_KEY = "partition_dir"


def _keys(manifest: DataFrame, column: str) -> list[str]:
    """The column with the table name, where the manifest covers several tables."""
    return ["table_name", column] if "table_name" in manifest.columns else [column]


def partitions_of(manifest: DataFrame, partitions: Sequence[str] = ()) -> DataFrame:
    """Distinct partition folders (with their parsed key values) of a manifest."""
    extra = [c for c in ("table_name", *partitions) if c in manifest.columns]
    return manifest.select(*extra, PARTITION_KEY).distinct()


def written_files(after: DataFrame, before: DataFrame) -> DataFrame:
    """Files present after a write that were not there before."""
    keys = _keys(after, "rel_path")
    return after.join(before.select(*keys), keys, "left_anti")


def touched_partitions(after: DataFrame, before: DataFrame, partitions: Sequence[str] = ()) -> DataFrame:
    """Partitions the write put files into (and so replaced)."""
    return partitions_of(written_files(after, before), partitions)


def new_partitions(after: DataFrame, before: DataFrame, partitions: Sequence[str] = ()) -> DataFrame:
    """Partitions that did not exist before; these need a catalog refresh."""
    keys = _keys(after, PARTITION_KEY)
    return partitions_of(after, partitions).join(
        before.select(*keys).distinct(), keys, "left_anti"
    )


def stale_files(after: DataFrame, before: DataFrame) -> DataFrame:
    """Files of touched partitions that the write removed (or must remove).

    Limited to touched partitions: a partition the write did not produce
    keeps its files, even when its source rows are gone.
    """
    keys = _keys(after, PARTITION_KEY)
    files = _keys(after, "rel_path")
    touched = written_files(after, before).select(*keys).distinct()
    return before.join(touched, keys, "left_semi").join(after.select(*files), files, "left_anti")


def orphan_partitions(
    after: DataFrame,
    before: DataFrame,
    partitions: Sequence[str],
    in_scope: Column | None = None,
) -> DataFrame:
    """Partitions inside the job's scope that the write did not produce.

    A job writes every partition its filter still finds rows for, so a
    partition in scope that received no files has lost all its source rows;
    its old files stay in place (nothing replaces them). ``in_scope`` is the
    job filter on the partition columns (values as text in a manifest).
    """
    keys = _keys(after, PARTITION_KEY)
    touched = written_files(after, before).select(*keys).distinct()
    candidates = partitions_of(after, partitions)
    if in_scope is not None:
        candidates = candidates.where(in_scope)
    return candidates.join(touched, keys, "left_anti")


#: Partition folders (a row each) up to which a report is broadcast.
BROADCAST_PARTITIONS = 100_000


def rows_in(mirror: DataFrame, report: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of the mirror in the partitions that a report names (touched, new, orphan ...).

    A join on the partition columns: Spark prunes the mirror's folders while
    the query runs by the report's values (dynamic partition pruning), so no
    other partition is opened. Null values are matched in a branch of their
    own, which reads null partitions only.
    """
    types = {f.name: f.dataType for f in mirror.schema.fields}
    named = report.where(F.col(PARTITION_KEY) != "").select(*[F.col(p).cast(types[p]).alias(p) for p in partitions]).distinct()
    if named.count() <= BROADCAST_PARTITIONS:
        named = F.broadcast(named)
    found = mirror.join(named, list(partitions), "left_semi")
    some_null = reduce(lambda a, b: a | b, [F.col(p).isNull() for p in partitions])
    other = named.where(some_null).select(*[F.col(p).alias(f"__{p}") for p in partitions])
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in partitions])
    return found.unionByName(mirror.where(some_null).join(other, same, "left_semi").select(*found.columns))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name (reports of several jobs)."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), frames)


def partition_status(after: DataFrame, before: DataFrame, partitions: Sequence[str] = ()) -> DataFrame:
    """One row per partition folder seen before or after a write.

    ``existed_before``, ``exists_after``, ``touched`` (received new files)
    and ``removed_files``, from a single full outer join of the two
    manifests on the relative path.
    """
    keep = [c for c in ("table_name", *partitions) if c in after.columns]
    a = after.select("rel_path", PARTITION_KEY, *keep, F.lit(True).alias("in_after"))
    b = before.select(
        F.col("rel_path").alias("b_path"), F.col(PARTITION_KEY).alias("b_dir"), *[F.col(c).alias(f"b_{c}") for c in keep],
        F.lit(True).alias("in_before"),
    )
    in_after = F.coalesce(F.col("in_after"), F.lit(False))
    in_before = F.coalesce(F.col("in_before"), F.lit(False))
    same = F.col("rel_path") == F.col("b_path")
    if "table_name" in keep:
        same = same & (F.col("table_name") == F.col("b_table_name"))
    joined = a.join(b, same, "full_outer").select(
        F.coalesce(F.col(PARTITION_KEY), F.col("b_dir")).alias(PARTITION_KEY),
        *[F.coalesce(F.col(c), F.col(f"b_{c}")).alias(c) for c in keep],
        in_after.alias("in_after"),
        in_before.alias("in_before"),
    )
    return joined.groupBy(PARTITION_KEY, *keep).agg(
        F.max("in_before").alias("existed_before"),
        F.max("in_after").alias("exists_after"),
        F.max(F.col("in_after") & ~F.col("in_before")).alias("touched"),
        F.count_if(F.col("in_before") & ~F.col("in_after")).alias("removed_files"),
    )


def report_counts(
    after: DataFrame,
    before: DataFrame,
    partitions: Sequence[str] = (),
    in_scope: Column | None = None,
) -> dict[str, int | None]:
    """Counts of new partitions, stale files and orphan partitions, in one action
    (one join of the manifests, one aggregate per partition, one global aggregate)."""
    status = partition_status(after, before, partitions)
    scope = F.lit(True) if in_scope is None else F.coalesce(in_scope, F.lit(False))
    row = status.agg(
        F.count_if(F.col("exists_after") & ~F.col("existed_before")).alias("new_partitions"),
        F.coalesce(F.sum(F.when(F.col("touched"), F.col("removed_files"))), F.lit(0)).alias("stale_files"),
        F.count_if(F.col("exists_after") & ~F.col("touched") & scope).alias("orphan_partitions"),
    ).collect()[0]
    return {
        "new_partitions": int(row["new_partitions"]),
        "stale_files": int(row["stale_files"]),
        "orphan_partitions": int(row["orphan_partitions"]) if partitions else None,
    }
