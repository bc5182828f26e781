"""File manifests of a mirror, built by Spark's own file listing.

The ``binaryFile`` source lists files in parallel (many folders are listed
by a Spark job) and, with only ``path``, ``length`` and ``modificationTime``
selected, never opens a file. It works the same on a local folder and on an
object-store URI. Spark holds the list of files (names and sizes, not their
content) on the driver, as it does for every file scan.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

# Spark's text for a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

MANIFEST_SCHEMA = StructType([
    StructField("path", StringType()),
    StructField("rel_path", StringType()),
    StructField("partition_dir", StringType()),
    StructField("length", LongType()),
    StructField("modified", TimestampType()),
])

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def path_part(uri: str) -> str:
    """The path of a URI without scheme and authority, no trailing slash."""
    return re.sub(_SCHEME, "", uri).rstrip("/")


def hadoop_file_system(spark: SparkSession, path: str):
    """``(file system, path)`` of the Hadoop file system that serves ``path``."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the file system that serves it."""
    try:
        fs, hadoop_path = hadoop_file_system(spark, path)
    except AttributeError:  # no JVM gateway (remote session): let the reader decide
        return True
    return bool(fs.exists(hadoop_path))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on the file system that serves it."""
    fs, hadoop_path = hadoop_file_system(spark, path)
    return bool(fs.delete(hadoop_path, True))


def qualified_path(spark: SparkSession, path: str) -> str:
    """``path`` fully qualified by its file system (scheme and authority added)."""
    fs, hadoop_path = hadoop_file_system(spark, path)
    return str(fs.makeQualified(hadoop_path).toString()).rstrip("/")


def canonical_path(spark: SparkSession, path: str) -> str:
    """``qualified_path`` with ``.`` and ``..`` segments resolved and doubled slashes gone."""
    qualified = qualified_path(spark, path)
    scheme = re.match(_SCHEME, qualified)
    head = scheme.group(0) if scheme else ""
    return head + "/" + posixpath.normpath(qualified[len(head):] or "/").lstrip("/")


def list_files(
    spark: SparkSession, root: str, glob: str = "*.parquet", within: str | None = None
) -> DataFrame:
    """``(path, rel_path, partition_dir, length, modified)`` for files under ``root``.

    ``rel_path`` is relative to ``root``; ``partition_dir`` is its folder part
    (empty for an unpartitioned table). ``within`` limits the listing to the
    folders matching a path glob below ``root`` (e.g. ``taxyr={2023,2024}``).
    An absent root, or no matching folder, lists as empty.
    """
    empty = spark.createDataFrame([], MANIFEST_SCHEMA)
    if not path_exists(spark, root):
        return empty
    # One spelling of the root, as the listing reports it: absolute, with
    # scheme, without doubled or dotted segments.
    root = canonical_path(spark, root)
    target = f"{root}/{within}" if within else root
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .load(target)
            .select("path", "length", F.col("modificationTime").alias("modified"))
        )
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":  # e.g. no such container: an error, not an empty folder
            raise
        return empty
    prefix = path_part(root) + "/"
    local = F.regexp_replace(F.col("path"), _SCHEME, "")
    outside = F.raise_error(F.concat(F.lit(f"listed file is not under {root}: "), F.col("path"))).cast("string")
    rel = F.when(local.startswith(prefix), F.expr("substring(local, prefix_length + 1)")).otherwise(outside)
    return (
        files.withColumn("local", local)
        .withColumn("prefix_length", F.lit(len(prefix)))
        .withColumn("rel_path", rel)
        .withColumn("partition_dir", F.regexp_extract(F.col("rel_path"), r"^(.*)/[^/]*$", 1))
        .select(*MANIFEST_SCHEMA.fieldNames())
    )


def partition_value(rel_path: Column, name: str) -> Column:
    """Text value of Hive partition ``name`` in a relative path; null when absent or null."""
    raw = F.regexp_extract(rel_path, rf"(^|/){re.escape(name)}=([^/]*)/", 2)
    # Spark percent-escapes special characters in folder names; '+' is literal.
    decoded = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when((raw == "") | (raw == NULL_PARTITION), None).otherwise(decoded)


def file_manifest(
    spark: SparkSession,
    root: str,
    partitions: Sequence[str] = (),
    table: str | None = None,
    within: str | None = None,
) -> DataFrame:
    """``list_files`` plus one text column per partition key (and ``table_name``)."""
    files = list_files(spark, root, within=within)
    cols = [F.col(c) for c in files.columns]
    if table is not None:
        cols.insert(0, F.lit(table).alias("table_name"))
    cols += [partition_value(F.col("rel_path"), p).alias(p) for p in partitions]
    return files.select(*cols)
