"""Ship closed job-log files as events.

The batch form (``sources.logs.read_log_events``) reads a finished log once.
This is the same parse as a Structured Streaming query over a folder of log
files: each run picks up only files it has not seen, the checkpoint
remembers them across runs and executor losses, and the Parquet sink commits
each micro-batch exactly once. ``availableNow`` processes what is there and
stops, so the shipper can run at the end of every batch of jobs.

A file is shipped once, so it must be complete: lines appended later would
never be seen. Writers close a log (or roll it) before they move it into the
folder. A run compares the size of every shipped file with the size at which
it was shipped and fails, before shipping anything, if one has grown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorkit.sources.listing import path_exists
from mirrorkit.sources.logs import parse_log_lines


class LogFileGrown(RuntimeError):
    """Files of the log folder got lines after they were shipped."""


def log_event_stream(spark: SparkSession, log_dir: str, *, max_files_per_trigger: int | None = None,
                     zone: str | None = None) -> DataFrame:
    """Streaming ``(ts_ms, message, source_file, source_size)`` from the text files in ``log_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(log_dir).select("value", F.col("_metadata.file_path").alias("source_file"),
                                       F.col("_metadata.file_size").alias("source_size"))
    return parse_log_lines(lines, line_numbers=False, keep=("source_file", "source_size"), zone=zone)


def grown_files(spark: SparkSession, log_dir: str, sink_dir: str) -> DataFrame:
    """(path) of files that are larger now than when their lines were shipped."""
    shipped = spark.read.parquet(sink_dir).groupBy("source_file").agg(F.max("source_size").alias("shipped_size"))
    now = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(log_dir).select(
        F.col("_metadata.file_path").alias("source_file"), "length")
    return now.join(shipped, "source_file").where(F.col("length") > F.col("shipped_size")).select(
        F.col("source_file").alias("path"))


def ship_log_events(
    spark: SparkSession,
    log_dir: str,
    sink_dir: str,
    checkpoint_dir: str | None = None,
    zone: str | None = None,
) -> int:
    """Append the events of log files not shipped yet to ``sink_dir``; return the events appended.

    The checkpoint defaults to a sibling of the sink (it must outlive runs).
    """
    def events() -> int:
        return spark.read.parquet(sink_dir).count() if path_exists(spark, f"{sink_dir.rstrip('/')}/_spark_metadata") else 0

    before = events()
    if before and (grown := grown_files(spark, log_dir, sink_dir).limit(10).collect()):
        raise LogFileGrown("shipped log files have grown since: " + ", ".join(r["path"] for r in grown))
    checkpoint = checkpoint_dir or sink_dir.rstrip("/") + "_checkpoint"
    query = (
        log_event_stream(spark, log_dir, zone=zone)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(sink_dir)
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return events() - before
