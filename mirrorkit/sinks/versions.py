"""Versioned mirrors: runs write beside the old files, then the mirror is switched.

A run writes its partitions into a folder of its own, ``_runs/<run>``, which
nobody reads yet. Publishing is one record in the manifest log (readers by
path) and one location per touched partition in the catalog (readers by name):
no file is renamed, replaced or deleted, so readers see a partition's old rows
or its new ones, on any store. A run that fails before its record leaves the
mirror as it was; one that fails before the catalog is switched is made good by
the next ``switch_catalog``, since the log says where every partition lies.

Old versions stay until ``collect_old`` removes them, so queries that began
before a switch can finish.

Each run keeps its schema. Reading several versions casts every column to the
least type that holds all of them (``functions.types.least_common_type``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mirrorkit.functions.columns import source_column
from mirrorkit.functions.types import merged_schema
from mirrorkit.operators.reconcile import union_all
from mirrorkit.sinks.catalog import publish_locations
from mirrorkit.sinks.manifest_log import FILES_SCHEMA, RUNS_FOLDER, Commit, append, commits, files_at, manifest
from mirrorkit.sources.listing import delete_path, hadoop_file_system, path_exists


def new_run() -> str:
    """A run id that sorts by time."""
    return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def run_folder(mirror: str, run: str) -> str:
    return f"{mirror.rstrip('/')}/{RUNS_FOLDER}/{run}"


def _run_files(spark: SparkSession, mirror: str, run: str) -> DataFrame:
    """The files of a run with their row counts, from the files themselves (footers only)."""
    folder = run_folder(mirror, run)
    if not path_exists(spark, folder):
        return spark.createDataFrame([], FILES_SCHEMA)
    # No column is asked for, so only footers are read; a file that cannot be read fails the publish.
    found = spark.read.schema(StructType()).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(
        folder).select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_size").alias("length"))
    path = F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B")))  # the metadata column holds an escaped path
    rel = F.expr(f"substring(path, instr(path, '{RUNS_FOLDER}/{run}/'))")
    inside = F.expr(f"substring(rel_path, {len(RUNS_FOLDER) + len(run) + 3})")
    return found.groupBy("uri", "length").agg(F.count(F.lit(1)).alias("rows")).withColumn("path", path).withColumn("rel_path", rel).select(
        F.lit(run).alias("run"), "rel_path", F.regexp_extract(inside, r"^(.*)/[^/]*$", 1).alias("partition_dir"), "length", "rows")


def publish_run(spark: SparkSession, mirror: str, run: str, schema: StructType, partitions: Sequence[str] = ()) -> Commit:
    """Commit what a run has written to ``run_folder(mirror, run)``."""
    mirror = mirror.rstrip("/")
    files = _run_files(spark, mirror, run).checkpoint(eager=True)  # read once, one row a file
    return append(spark, mirror, run, schema, partitions, files)


def versions(spark: SparkSession, mirror: str, number: int | None = None, where: Column | None = None) -> list:
    """Rows (run, partition_dir, *partition values as text) of the mirror, a row per partition."""
    known = commits(spark, mirror)
    if not known:
        return []
    partitions = known[-1].partitions
    rows = manifest(spark, mirror, partitions, number, known=known).select("run", "partition_dir", *partitions).distinct()
    return (rows if where is None else rows.where(where)).orderBy("run", "partition_dir").collect()


def read_versioned(spark: SparkSession, mirror: str, where: Column | None = None, as_of: int | None = None) -> DataFrame:
    """The mirror's rows now, or after commit ``as_of``.

    ``where`` restricts the partitions (over the partition columns, as text, as
    in a manifest): only their folders are opened.
    """
    mirror = mirror.rstrip("/")
    known = commits(spark, mirror)
    if not known:
        raise FileNotFoundError(f"{mirror}: no run has been published")
    by_run = {c.run: c for c in known}
    folders: dict[str, list[str]] = {}
    for row in versions(spark, mirror, as_of, where):
        folders.setdefault(row["run"], []).append(f"{run_folder(mirror, row['run'])}/{row['partition_dir']}")
    last = known[-1] if as_of is None else [c for c in known if c.number <= as_of][-1]
    schema = merged_schema([last.struct(), *[by_run[run].struct() for run in folders]])
    parts = [spark.read.schema(by_run[run].struct()).option("basePath", run_folder(mirror, run)).parquet(*paths)
             for run, paths in folders.items()]
    if not parts:
        return spark.createDataFrame([], schema)
    return union_all([part.select(*[
        (source_column(f.name) if f.name in part.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
        for part in parts])


def switch_catalog(spark: SparkSession, name: str, mirror: str) -> str:
    """Point the catalog's partitions to where the log says they lie; return what was done."""
    mirror = mirror.rstrip("/")
    known = commits(spark, mirror)
    last, by_run = known[-1], {c.run: c for c in known}
    rows = versions(spark, mirror)
    actions = []
    for run in sorted({r["run"] for r in rows} or {last.run}, key=lambda r: by_run[r].number):
        located = [(r, f"{run_folder(mirror, run)}/{r['partition_dir']}".rstrip("/")) for r in rows if r["run"] == run]
        actions.append(publish_locations(spark, name, run_folder(mirror, run), by_run[run].struct(), last.partitions, located))
    return max(actions, key=["unchanged", "refreshed", "replaced", "created"].index)


def collect_old(spark: SparkSession, mirror: str, keep: int = 2, failed_after_seconds: float = 86_400.0) -> list[str]:
    """Delete run folders (or partitions of them) that the last ``keep`` states of the mirror don't need.

    Folders of runs that were never published go once they are older than
    ``failed_after_seconds`` (a run may be writing still). Returns the folders
    deleted. Commit records and entries stay: they are the mirror's history.
    """
    mirror = mirror.rstrip("/")
    known = commits(spark, mirror)
    fs, root = hadoop_file_system(spark, f"{mirror}/{RUNS_FOLDER}")
    if not known or not fs.exists(root):
        return []
    needed = union_all([files_at(spark, mirror, c.number, known) for c in known[-max(1, keep):]]).select(
        "run", "partition_dir").distinct()
    ever = union_all([spark.read.parquet(f"{mirror}/{c.entries}") for c in known]).where("action = 'add'").select(
        "run", "partition_dir").distinct()
    gone = [run_folder(mirror, r["run"]) + (f"/{r['partition_dir']}" if r["partition_dir"] else "")
            for r in ever.exceptAll(needed).orderBy("run", "partition_dir").collect()]
    published, now = {c.run for c in known}, time.time()
    for status in fs.listStatus(root):  # one entry per run
        run = status.getPath().getName()
        if run not in published and now - status.getModificationTime() / 1000 > failed_after_seconds:
            gone.append(run_folder(mirror, run))
    return [path for path in gone if delete_path(spark, path)]
