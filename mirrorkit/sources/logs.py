"""Job log text as timestamped events.

A log line is ``<yyyy-MM-dd_HH:mm:ss.SSS> <rest>``: the first space splits
the time from the message. Lines whose first word is not a time (a traceback,
a wrapped message) are kept with a null time instead of failing the run.
White space of any kind at the ends of a message is dropped, and lines of
nothing else. Times are wall clock; ``zone`` names the clock's time zone
(default: the session's).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorkit.functions.columns import log_line_time_ms
from mirrorkit.operators.ordering import with_position

_WHITE_SPACE = " \t\n\x0b\f\r"


def _stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITE_SPACE))


def parse_log_lines(
    lines: DataFrame, text_column: str = "value", *, line_numbers: bool = True, keep: tuple[str, ...] = (),
    zone: str | None = None,
) -> DataFrame:
    """``(line_no, ts_ms, message, *keep)`` from a frame of raw lines (blank lines dropped).

    ``line_no`` follows scan order (files are read in order, each split in
    order), so sorting on ``(ts_ms, line_no)`` keeps equal times in file order.
    """
    parts = F.split(F.col(text_column), " ", 2)
    ts_ms = log_line_time_ms(parts.getItem(0), zone)
    message = F.when(ts_ms.isNotNull(), _stripped(F.coalesce(parts.getItem(1), F.lit("")))).otherwise(
        _stripped(F.col(text_column)))
    cols = [ts_ms.alias("ts_ms"), message.alias("message"), *keep]
    if line_numbers:
        cols.insert(0, F.monotonically_increasing_id().alias("line_no"))
    return lines.where(_stripped(F.col(text_column)) != "").select(*cols)


def _events_and_order(spark: SparkSession, path: str, zone: str | None) -> tuple[DataFrame, list[Column]]:
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    order = [F.col("ts_ms").asc_nulls_last(), F.col("source_file").asc(), F.col("block_start").asc(), F.col("line_no").asc()]
    return parse_log_lines(lines, keep=("source_file", "block_start"), zone=zone), order


def read_log_events(spark: SparkSession, path: str, zone: str | None = None) -> DataFrame:
    """Events of the log file(s) at ``path``, sorted by time.

    Equal times keep file order: file, then split offset, then position in
    the split (Spark packs splits by size, so scan order alone is not file
    order when there are several files).
    """
    events, order = _events_and_order(spark, path, zone)
    return events.orderBy(*order).drop("block_start")


def numbered_log_events(spark: SparkSession, path: str, zone: str | None = None) -> DataFrame:
    """The same events with their ``position`` in that order (from 0), as an unsorted frame."""
    events, order = _events_and_order(spark, path, zone)
    return with_position(events, order).drop("block_start")
