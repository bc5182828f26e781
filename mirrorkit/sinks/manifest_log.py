"""Append-only log of the files a versioned mirror consists of.

Under the mirror's ``_log`` folder each run appends

* one Parquet folder of entries: the files it added, and the files of the
  partitions it touched that are no longer part of the mirror, then
* one small commit record, created under the next free number. The file system
  creates it only if it does not exist, so of two runs that finish at once one
  is first and the other one takes the next number, with its entries made
  again. A run without a record does not exist for readers.

Every ``SNAPSHOT_EVERY``-th commit also writes the files of the mirror as a
whole, so a reader takes the last snapshot and the few runs after it. What
changed in a run, and what the mirror consisted of before and after any run,
are reads of this log: no folder of the mirror is listed. ``audit`` compares
the log with a listing.

Stores on which "create if absent" is only a check followed by a write need one
writer per mirror at a time (a batch has one job per mirror anyway).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mirrorkit.sources.listing import hadoop_file_system, list_files, partition_value, path_exists

LOG_FOLDER = "_log"
RUNS_FOLDER = "_runs"
SNAPSHOT_EVERY = 20
ATTEMPTS = 5

FILE_FIELDS = [
    StructField("run", StringType()),
    StructField("rel_path", StringType()),
    StructField("partition_dir", StringType()),
    StructField("length", LongType()),
    StructField("rows", LongType()),
]
FILES_SCHEMA = StructType(FILE_FIELDS)
ENTRY_SCHEMA = StructType([StructField("action", StringType()), *FILE_FIELDS])
ADD, REMOVE = "add", "remove"


class PublishConflict(RuntimeError):
    """Other runs kept taking the next commit number."""


@dataclass(frozen=True)
class Commit:
    number: int
    run: str
    schema: str
    partitions: tuple[str, ...]
    entries: str
    snapshot: str | None = None

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _commit_path(mirror: str, number: int) -> str:
    return f"{mirror}/{LOG_FOLDER}/commits/{number:08d}.json"


def _records(spark: SparkSession, mirror: str) -> dict[int, str]:
    """Texts of the commit records by number (one small record per run), empty for one that is being written."""
    folder = f"{mirror}/{LOG_FOLDER}/commits"
    if not path_exists(spark, folder):
        return {}
    fs, hadoop_path = hadoop_file_system(spark, folder)
    taken = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    found = spark.read.text(folder, wholetext=True).select("value", F.col("_metadata.file_name").alias("name")).collect()
    texts = {r["name"]: r["value"] for r in found}  # Spark skips empty files
    return {int(name.split(".")[0]): texts.get(name, "") for name in taken if name.endswith(".json")}


def _parsed(records: dict[int, str]) -> list[Commit]:
    """The commits, oldest first. A record that is not whole (its writer is at it, or died) is none."""
    found = []
    for number in sorted(records):
        try:
            fields = json.loads(records[number])
        except ValueError:
            continue
        found.append(Commit(**{**fields, "partitions": tuple(fields["partitions"])}))
    return found


def commits(spark: SparkSession, mirror: str) -> list[Commit]:
    """All commits, oldest first."""
    return _parsed(_records(spark, mirror))


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; false if there is one already."""
    fs, hadoop_path = hadoop_file_system(spark, path)
    try:
        out = fs.create(hadoop_path, False)
    except Py4JJavaError:
        if fs.exists(hadoop_path):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def _upto(known: list[Commit], number: int | None) -> list[Commit]:
    return known if number is None else [c for c in known if c.number <= number]


def files_at(spark: SparkSession, mirror: str, number: int | None = None, known: list[Commit] | None = None) -> DataFrame:
    """(run, rel_path, partition_dir, length, rows) of the mirror's files after commit ``number`` (default: now)."""
    known = _upto(commits(spark, mirror) if known is None else known, number)
    base = max((c for c in known if c.snapshot), key=lambda c: c.number, default=None)
    later = [c for c in known if base is None or c.number > base.number]
    files = spark.createDataFrame([], FILES_SCHEMA)
    if base is not None:
        files = spark.read.schema(FILES_SCHEMA).parquet(f"{mirror}/{base.snapshot}")
    if not later:
        return files
    entries = spark.read.schema(ENTRY_SCHEMA).parquet(*[f"{mirror}/{c.entries}" for c in later])
    gone = entries.where(F.col("action") == REMOVE).select("rel_path")
    return files.unionByName(entries.where(F.col("action") == ADD).drop("action")).join(gone, "rel_path", "left_anti").select(
        *FILES_SCHEMA.fieldNames())


def changes_of(spark: SparkSession, mirror: str, commit: Commit) -> DataFrame:
    """The entries of one run: action, and the file it added or removed."""
    return spark.read.schema(ENTRY_SCHEMA).parquet(f"{mirror}/{commit.entries}")


def touched_by(spark: SparkSession, mirror: str, commit: Commit) -> DataFrame:
    """(partition_dir, *partition values as text) of the partitions a run put files into."""
    inside = F.concat("partition_dir", F.lit("/"))
    return changes_of(spark, mirror, commit).where(F.col("action") == ADD).select(
        "partition_dir", *[partition_value(inside, p).alias(p) for p in commit.partitions]).distinct()


def append(spark: SparkSession, mirror: str, run: str, schema: StructType, partitions: Sequence[str], added: DataFrame) -> Commit:
    """Make a run's files part of the mirror, in place of all files of the partitions they are in.

    An unpartitioned mirror is replaced whole, also by a run without files.
    """
    for attempt in range(ATTEMPTS):
        records = _records(spark, mirror)
        known, number = _parsed(records), max(records, default=0) + 1
        before = files_at(spark, mirror, known=known)
        replaced = before
        if partitions:
            replaced = before.join(added.select("partition_dir").distinct(), "partition_dir", "left_semi")
        entries = f"{LOG_FOLDER}/entries/{run}-{attempt}"
        rows = added.withColumn("action", F.lit(ADD)).unionByName(replaced.withColumn("action", F.lit(REMOVE)))
        rows.select(*ENTRY_SCHEMA.fieldNames()).write.parquet(f"{mirror}/{entries}")
        commit = Commit(number, run, schema.json(), tuple(partitions), entries)
        if number % SNAPSHOT_EVERY == 0:
            snapshot = f"{LOG_FOLDER}/snapshots/{run}-{attempt}"
            files_at(spark, mirror, known=[*known, commit]).write.parquet(f"{mirror}/{snapshot}")
            commit = Commit(number, run, schema.json(), tuple(partitions), entries, snapshot)
        if _create(spark, _commit_path(mirror, number), json.dumps(asdict(commit))):
            return commit
    raise PublishConflict(f"{mirror}: {ATTEMPTS} commit numbers in a row were taken by other runs")


def manifest(spark: SparkSession, mirror: str, partitions: Sequence[str] = (), number: int | None = None,
             table: str | None = None, known: list[Commit] | None = None) -> DataFrame:
    """The log's files in the shape of a listing, for ``operators.reconcile``.

    ``number`` 0 is the state before any run.
    """
    files = files_at(spark, mirror, number, known)
    columns = [F.concat(F.lit(f"{mirror}/"), F.col("rel_path")).alias("path"), "rel_path", "partition_dir", "length", "rows", "run"]
    if table is not None:
        columns.insert(0, F.lit(table).alias("table_name"))
    inside = F.concat("partition_dir", F.lit("/"))
    return files.select(*columns, *[partition_value(inside, p).alias(p) for p in partitions])


def audit(spark: SparkSession, mirror: str) -> DataFrame:
    """(rel_path, finding) where the log and a listing of the mirror differ.

    ``missing``: part of the mirror but not stored; ``resized``: stored with
    another length; ``unreferenced``: stored but not part of the mirror (old
    versions that ``versions.collect_old`` has not removed, failed runs).
    """
    logged = files_at(spark, mirror).select("rel_path", F.col("length").alias("logged"))
    stored = list_files(spark, f"{mirror}/{RUNS_FOLDER}").select(
        F.concat(F.lit(f"{RUNS_FOLDER}/"), F.col("rel_path")).alias("rel_path"), F.col("length").alias("stored"))
    finding = F.when(F.col("stored").isNull(), "missing").when(F.col("logged").isNull(), "unreferenced").when(
        F.col("stored") != F.col("logged"), "resized")
    return logged.join(stored, "rel_path", "full_outer").select("rel_path", finding.alias("finding")).where("finding IS NOT NULL")
