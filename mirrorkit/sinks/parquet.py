"""Partitioned, compacted Parquet writes of a mirror.

Compaction is one hash exchange on the partition keys in front of the
writer (a ``REBALANCE`` hint): every Hive partition lands in one writer task
and becomes one file, unless it is larger than the advisory partition size,
in which case adaptive execution splits it over several tasks (and so several
files) instead of letting one task write a third of the table. The per-file
row cap bounds every file on top of that. Partitions not present in the
written frame are left alone (dynamic overwrite); an unpartitioned table is
replaced whole.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from mirrorkit.functions.columns import source_column
from mirrorkit.functions.fixed import (
    FINAL_COMPRESSION,
    MAX_ROWS_PER_FILE,
    STAGED_COMPRESSION,
)
from mirrorkit.sources.files import read_mirror


#: Rows of a page in files for point reads: what a read of one key decodes.
POINT_PAGE_ROWS = 2_000
_PARALLELISM_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def compacted(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The frame behind one exchange that groups each Hive partition together."""
    return df.hint("rebalance", *partitions)


_MERGING: dict[str, int] = {}
_MERGING_LOCK = threading.Lock()


@contextmanager
def merged_small_tasks(spark: SparkSession):
    """While writing, merge tasks up to the advisory size; Spark would keep one (and so one small file) per core.

    ``build_session`` sets this for good. In a session that does not say either
    way it holds while any write of this process runs, and is undone after.
    """
    session = spark.sparkContext.applicationId
    with _MERGING_LOCK:
        mine = bool(_MERGING.get(session)) or spark.conf.get(_PARALLELISM_FIRST, None) is None
        if mine:
            _MERGING[session] = _MERGING.get(session, 0) + 1
            spark.conf.set(_PARALLELISM_FIRST, "false")
    try:
        yield
    finally:
        with _MERGING_LOCK:
            if mine:
                _MERGING[session] -= 1
                if not _MERGING[session]:
                    spark.conf.unset(_PARALLELISM_FIRST)


def write_mirror(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    *,
    compression: str = FINAL_COMPRESSION,
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
    compact: bool = True,
    replace_touched_only: bool = True,
    before_exchange: Callable[[DataFrame], DataFrame] | None = None,
    after_exchange: Callable[[DataFrame], DataFrame] | None = None,
    observation: Observation | None = None,
    metrics: Sequence[Column] = (),
    drop_after_observe: Sequence[str] = (),
    point_key: str | None = None,
    distinct_keys_per_file: int = MAX_ROWS_PER_FILE,
) -> None:
    """Write ``df`` as Hive-partitioned Parquet at ``path`` (one action).

    ``point_key`` prepares the mirror for reads of single keys: rows are dealt
    to files by ranges of (partition, key) and sorted in them, so files, row
    groups and pages (``POINT_PAGE_ROWS`` rows) hold narrow ranges of it, and
    each row group gets a Bloom filter on it (about 1.2 bytes per key of
    ``distinct_keys_per_file``). See ``sources.files.read_keys``.

    ``before_exchange`` and ``after_exchange`` are row-wise projections on
    either side of the exchange: conversions that shrink rows go before it,
    those that widen rows (text renderings, constants) after it, so each
    column crosses the shuffle in its smallest form. ``observation``/``metrics`` are computed by the
    writer tasks too, so a retried map task cannot count twice and no extra
    pass is needed. Columns in ``drop_after_observe`` feed the metrics only.
    """
    out = before_exchange(df) if before_exchange is not None else df
    if compact and point_key is not None:
        keys = [source_column(c) for c in (*partitions, point_key)]
        out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    elif compact:
        out = compacted(out, partitions)
    if after_exchange is not None:
        out = after_exchange(out)
    if observation is not None and metrics:
        out = out.observe(observation, *metrics)
    if drop_after_observe:
        out = out.drop(*drop_after_observe)
    writer = (
        out.write.mode("overwrite")
        .option("compression", compression)
        .option("maxRecordsPerFile", max_rows_per_file)
    )
    if point_key is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{point_key}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{point_key}", distinct_keys_per_file).option(
            "parquet.page.row.count.limit", POINT_PAGE_ROWS)
    if partitions:
        writer = writer.partitionBy(*partitions).option(
            "partitionOverwriteMode", "dynamic" if replace_touched_only else "static"
        )
    with merged_small_tasks(df.sparkSession):
        writer.parquet(path)


def stage_extract(df: DataFrame, path: str, **kwargs) -> None:
    """First pass of a two-pass mirror: each task writes one snappy file (more
    beyond the row cap), without exchange or partition folders, replacing the
    whole staging folder."""
    write_mirror(
        df, path, (),
        compression=STAGED_COMPRESSION, compact=False, replace_touched_only=False, **kwargs,
    )


def compact_staged(
    spark: SparkSession,
    staged_path: str,
    dest: str,
    schema: StructType,
    partitions: Sequence[str] = (),
    **kwargs,
) -> None:
    """Second pass: read staged files with an explicit schema, write compacted files."""
    staged = read_mirror(spark, staged_path, (), schema=schema)
    write_mirror(staged.select(*[source_column(n) for n in schema.fieldNames()]), dest, partitions, **kwargs)
