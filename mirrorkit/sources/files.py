"""Reading mirrors back: staged output, final output, pruned reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from mirrorkit.functions.columns import source_column
from mirrorkit.functions.fixed import STATUS_COLUMN, YEAR_COLUMN
from mirrorkit.sources.listing import list_files

# Declared types of the partition columns. Declaring them stops Spark from
# guessing (status values such as "01" would otherwise come back as ints).
PARTITION_TYPES = {YEAR_COLUMN: "int", STATUS_COLUMN: "string"}


def mirror_schema(
    data_schema: StructType,
    partitions: tuple[str, ...] | list[str],
    partition_types: Mapping[str, str] | None = None,
) -> StructType:
    """Full read schema: data columns, then partition columns with declared types."""
    types = dict(PARTITION_TYPES)
    types.update(partition_types or {})
    by_name = {f.name: f for f in data_schema.fields}
    fields = [f for f in data_schema.fields if f.name not in partitions]
    for name in partitions:
        if name in by_name:
            fields.append(StructField(name, by_name[name].dataType, True))
        else:
            fields.append(StructField(name, DataType.fromDDL(types.get(name, "string")), True))
    return StructType(fields)


def read_mirror(
    spark: SparkSession,
    path: str,
    partitions: tuple[str, ...] | list[str] = (),
    *,
    schema: StructType | None = None,
    partition_types: Mapping[str, str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Read a Hive-partitioned mirror with partition discovery.

    With ``schema`` (the written frame's schema) the read needs no inference
    and an empty or absent mirror reads as an empty frame. Without it, the
    data schema is taken from the files (``merge_schema`` reads every
    footer, for mirrors whose partitions were written with different column
    sets) and partition columns get their declared types. Filters on
    partition columns become ``PartitionFilters``.
    """
    if schema is not None:
        full = mirror_schema(schema, partitions, partition_types)
        if not _has_files(spark, path):
            return spark.createDataFrame([], full)
        return spark.read.schema(full).option("basePath", path).parquet(path)
    inferred = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path).schema
    full = mirror_schema(
        StructType([f for f in inferred.fields if f.name not in partitions]),
        partitions,
        partition_types,
    )
    return spark.read.schema(full).option("basePath", path).parquet(path)


#: Keys per pass of ``read_keys``: the reader tests up to this many values against Bloom filters and page bounds.
KEYS_PER_PASS = 10


def read_keys(mirror: DataFrame, column: str, keys: Sequence) -> DataFrame:
    """Rows of ``mirror`` with one of the given keys (null: rows without a key).

    Sorted keys go in groups of ``KEYS_PER_PASS``, each an ``IN`` filter that
    reaches the Parquet reader; row groups and pages that cannot hold a key are
    skipped (best on mirrors written with ``point_key``). For very many keys,
    join a frame of keys instead.
    """
    wanted = sorted({k for k in keys if k is not None})
    passes = [wanted[at : at + KEYS_PER_PASS] for at in range(0, len(wanted), KEYS_PER_PASS)]
    parts = [mirror.where(source_column(column).isin(some)) for some in passes]
    if None in keys:
        parts.append(mirror.where(source_column(column).isNull()))
    return reduce(DataFrame.unionByName, parts) if parts else mirror.limit(0)


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether a listing of ``path`` finds at least one data file."""
    return not list_files(spark, path).isEmpty()
