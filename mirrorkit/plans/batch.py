"""Running mirror jobs: one lazy plan and one write action per job.

Per job: scan (chunked) -> normalise -> filter -> compacting exchange ->
partitioned write at the destination, replacing only touched partitions.
Row and overflow counts are observed by the writer tasks, so the summary
costs no extra pass. Manifests of the destination before and after the
write give the new partitions (catalog refresh) and the stale files removed.
Several jobs run at once on the shared session, each from its own thread, the
largest first. A job past its deadline is cancelled by its Spark job tag; the
others go on.
"""

from __future__ import annotations

import threading
import time
import traceback
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from mirrorkit.functions.fixed import PARALLEL_JOBS, YEAR_COLUMN
from mirrorkit.operators.chunks import chunked_scan
from mirrorkit.operators.filters import apply_predicate
from mirrorkit.operators.normalize import convert, narrow_numbers, prepare, render_text
from mirrorkit.operators.reconcile import report_counts, touched_partitions
from mirrorkit.plans.job import MirrorJob, check_batch, mirror_name
from mirrorkit.session import ensure_checkpoint_dir
from mirrorkit.sinks import manifest_log
from mirrorkit.sinks.catalog import sync_mirror_table
from mirrorkit.sinks.parquet import compact_staged, stage_extract, write_mirror
from mirrorkit.sinks.versions import new_run, publish_run, run_folder, switch_catalog
from mirrorkit.sources.listing import delete_path, file_manifest, path_exists

OVERFLOW = "__narrow_overflow"


class TableSource:
    """A source for batches built from named DataFrame factories.

    By default a job's chunk predicates are applied in Spark with ``UNION
    ALL`` semantics, so the rows are exactly those a chunked database scan
    would return (gaps lose rows, overlaps duplicate them). With
    ``chunk_semantics=False`` the chunk list is ignored, which saves one
    evaluation of every predicate per row when the list is known to be sound.
    """

    def __init__(self, tables: Mapping[str, Callable[[], DataFrame]], *, chunk_semantics: bool = True):
        self.tables = dict(tables)
        # "applies_chunks" means: the source itself has dealt with the chunks.
        self.applies_chunks = not chunk_semantics

    def __call__(self, job: MirrorJob) -> DataFrame:
        for name in (job.table_name, mirror_name(job.table_name)):
            if name in self.tables:
                return self.tables[name]()
        raise KeyError(f"no source for table {job.table_name!r}")


def extract_plan(job: MirrorJob, source: Callable[[MirrorJob], DataFrame]) -> DataFrame:
    """The lazy extract of a job before type conversion: chunked scan,
    lowercase names and declared types, then the job filter.

    The filter is written on the mirror's column names; Catalyst moves it
    below the renames into the scan (``PushedFilters``, or the ``WHERE`` of
    every JDBC chunk query).
    """
    raw = source(job)
    if not getattr(source, "applies_chunks", False):
        raw = chunked_scan(raw, job.predicates)
    return apply_predicate(prepare(raw, job.overrides), job.predicate)


def mirror_frame(
    job: MirrorJob,
    source: Callable[[MirrorJob], DataFrame],
    *,
    stamp: bool = True,
    overflow_column: str | None = None,
) -> DataFrame:
    """The rows of a job's mirror, fully normalised (what ``run_job`` writes)."""
    return convert(extract_plan(job, source), job.overrides, stamp=stamp, overflow_column=overflow_column)


@dataclass
class JobResult:
    job: str
    table_name: str
    description: str
    status: str
    rows: int | None = None
    overflow_rows: int | None = None
    min_year: int | None = None
    max_year: int | None = None
    partitions: str = ""
    new_partitions: int | None = None
    stale_files: int | None = None
    orphan_partitions: int | None = None
    catalog: str | None = None
    attempts: int = 1
    write_seconds: float | None = None
    report_seconds: float | None = None
    seconds: float = 0.0
    error: str | None = None


SUMMARY_SCHEMA = StructType([
    StructField("job", StringType()),
    StructField("table_name", StringType()),
    StructField("description", StringType()),
    StructField("status", StringType()),
    StructField("rows", LongType()),
    StructField("overflow_rows", LongType()),
    StructField("min_year", LongType()),
    StructField("max_year", LongType()),
    StructField("partitions", StringType()),
    StructField("new_partitions", LongType()),
    StructField("stale_files", LongType()),
    StructField("orphan_partitions", LongType()),
    StructField("catalog", StringType()),
    StructField("attempts", LongType()),
    StructField("write_seconds", DoubleType()),
    StructField("report_seconds", DoubleType()),
    StructField("seconds", DoubleType()),
    StructField("error", StringType()),
])


def run_job(
    spark: SparkSession,
    job: MirrorJob,
    source: Callable[[MirrorJob], DataFrame],
    dest_root: str,
    *,
    staging_root: str | None = None,
    catalog_database: str | None = None,
    retries: int = 0,
    versioned: bool = False,
    deadline: float | None = None,
) -> JobResult:
    """Mirror one table into ``dest_root/<mirror name>``; never raises.

    ``versioned``: write beside the old files and switch by the manifest log
    and the catalog (``sinks.versions``) instead of replacing folders; reports
    then come from the log and no folder of the mirror is listed.

    ``deadline``: seconds after which the job (all attempts together) is
    cancelled; its status is then ``"cancelled"``.

    A failed job is run again up to ``retries`` times: the write replaces
    exactly the partitions it produces, so a repeated run is idempotent.
    (Lost executors are handled inside one run by Spark's task retries.)
    """
    def once() -> JobResult:
        return _run_job_once(spark, job, source, dest_root, staging_root, catalog_database, versioned)

    with _deadline(spark, job, deadline) as expired:
        result, attempts = once(), 1
        while result.status != "ok" and attempts <= retries and not expired.is_set():
            attempts += 1
            result = once()
    if result.status != "ok" and expired.is_set():
        result.status = "cancelled"
        result.error = f"cancelled after {deadline} s"
    result.attempts = attempts
    return result


@contextmanager
def _deadline(spark: SparkSession, job: MirrorJob, seconds: float | None):
    """Cancels this thread's Spark jobs once ``seconds`` are over; the event says whether that happened.

    Spark jobs are tagged, so no other thread's are touched. A job may start
    further Spark jobs after one is cancelled (a retry of a step), so
    cancelling goes on until the block is left.
    """
    expired, done = threading.Event(), threading.Event()
    if seconds is None:
        yield expired
        return
    sc = spark.sparkContext
    tag = f"mirror-{job.mirror_name}-{uuid.uuid4().hex[:8]}"

    def watch() -> None:
        if done.wait(seconds):
            return
        expired.set()
        while not done.is_set():
            sc.cancelJobsWithTag(tag)
            done.wait(0.5)

    watcher = threading.Thread(target=watch, daemon=True)
    sc.addJobTag(tag)
    sc.setInterruptOnCancel(True)
    watcher.start()
    try:
        yield expired
    finally:
        done.set()
        watcher.join()
        sc.removeJobTag(tag)
        sc.setInterruptOnCancel(False)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a frame's size, from file sizes and plan statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def largest_first(jobs: Sequence[MirrorJob], source: Callable[[MirrorJob], DataFrame]) -> list[MirrorJob]:
    """Jobs by falling estimated extract size, so that the longest does not start last.

    A source that cannot be read comes first: its job fails at once.
    """
    def size(job: MirrorJob) -> float:
        try:
            return estimated_bytes(extract_plan(job, source))
        except Exception:  # reported when the job runs
            return float("inf")

    return sorted(jobs, key=lambda job: -size(job))


def _run_job_once(
    spark: SparkSession,
    job: MirrorJob,
    source: Callable[[MirrorJob], DataFrame],
    dest_root: str,
    staging_root: str | None,
    catalog_database: str | None,
    versioned: bool,
) -> JobResult:
    started = time.time()
    result = JobResult(job.name, job.table_name, job.description, "ok",
                       partitions=",".join(job.partitions))
    try:
        ensure_checkpoint_dir(spark)
        spark.sparkContext.setJobDescription(job.description)
        dest = f"{dest_root.rstrip('/')}/{job.mirror_name}"
        parts = list(job.partitions)
        # Only folders inside the job's scope can be created, replaced or
        # orphaned by this write, so only those are listed (before and after).
        # Materialised now: the listing must show the state before the write.
        target, run = dest, new_run()
        if versioned:
            target = run_folder(dest, run)
        else:
            before = file_manifest(spark, dest, parts, within=job.scope_glob)
            if path_exists(spark, dest):  # a first write has nothing to preserve
                before = before.checkpoint(eager=True)

        extracted = extract_plan(job, source)

        def shrink(df: DataFrame) -> DataFrame:
            return narrow_numbers(df, job.overrides, overflow_column=OVERFLOW)

        def widen(df: DataFrame) -> DataFrame:
            return render_text(df, job.overrides)

        observed = Observation(f"mirror-{job.name}")
        metrics = [
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(OVERFLOW), F.lit(0)).cast("long").alias("overflow_rows"),
        ]
        if YEAR_COLUMN in extracted.columns:
            metrics += [F.min(YEAR_COLUMN).cast("long").alias("min_year"),
                        F.max(YEAR_COLUMN).cast("long").alias("max_year")]
        schema = widen(shrink(extracted)).drop(OVERFLOW).schema
        write_started = time.time()
        if staging_root:
            # A folder per run: batches with one staging root don't meet.
            staged = f"{staging_root.rstrip('/')}/{job.mirror_name}-{uuid.uuid4().hex[:12]}"
            # Pass 1 lands the extract as is, one file per task (no exchange,
            # no partition folders); pass 2 compacts it and converts around
            # its exchange, like the one-pass write.
            stage_extract(extracted, staged)
            compact_staged(spark, staged, target, extracted.schema, parts, before_exchange=shrink,
                           after_exchange=widen, observation=observed, metrics=metrics,
                           drop_after_observe=[OVERFLOW])
            # The staged copy is as large as the extract; drop it once compacted.
            delete_path(spark, staged)
        else:
            # Numbers are narrowed before the compacting exchange, text is
            # rendered after it, in the writer tasks.
            write_mirror(extracted, target, parts, before_exchange=shrink, after_exchange=widen,
                         observation=observed, metrics=metrics, drop_after_observe=[OVERFLOW])
        stats = observed.get
        result.rows = int(stats.get("rows", 0))
        result.overflow_rows = int(stats.get("overflow_rows", 0))
        result.min_year = stats.get("min_year")
        result.max_year = stats.get("max_year")
        report_started = time.time()
        result.write_seconds = round(report_started - write_started, 3)

        if versioned:
            commit = publish_run(spark, dest, run, schema, parts)
            before = manifest_log.manifest(spark, dest, parts, commit.number - 1)  # as of the commit before
            after = manifest_log.manifest(spark, dest, parts, commit.number)
        else:
            after = file_manifest(spark, dest, parts, within=job.scope_glob)
        counts = report_counts(after, before, parts, job.partition_scope)
        result.new_partitions = counts["new_partitions"]
        result.stale_files = counts["stale_files"]
        result.orphan_partitions = counts["orphan_partitions"]
        table = f"{catalog_database}.{job.mirror_name}"
        if catalog_database and versioned:
            result.catalog = switch_catalog(spark, table, dest)
        elif catalog_database:
            touched = touched_partitions(after, before, parts).collect() if parts else None  # a row per partition written
            result.catalog = sync_mirror_table(spark, table, dest, schema, parts, touched)
        result.report_seconds = round(time.time() - report_started, 3)
    except Exception as err:  # reported per job; the batch decides to raise
        result.status = "failed"
        result.error = f"{type(err).__name__}: {err}\n{traceback.format_exc(limit=3)}"
    finally:
        spark.sparkContext.setJobDescription(None)
    result.seconds = round(time.time() - started, 3)
    return result


class BatchFailed(RuntimeError):
    def __init__(self, summary: DataFrame, failed: list[str]):
        super().__init__(f"{len(failed)} job(s) failed: {', '.join(failed)}")
        self.summary = summary


def run_batch(
    spark: SparkSession,
    jobs: Sequence[MirrorJob],
    source: Callable[[MirrorJob], DataFrame],
    dest_root: str,
    *,
    staging_root: str | None = None,
    parallelism: int = PARALLEL_JOBS,
    catalog_database: str | None = None,
    retries: int = 0,
    raise_on_failure: bool = True,
    versioned: bool = False,
    deadline: float | Mapping[str, float] | None = None,
) -> DataFrame:
    """Run the jobs, ``parallelism`` at a time, largest first; return one summary row per job.

    Failures do not stop the other jobs; they are reported in the summary and,
    with ``raise_on_failure``, raised once all jobs have finished. ``deadline``
    is in seconds from a job's start, for all jobs or by job name.
    """
    check_batch(jobs)
    ensure_checkpoint_dir(spark)

    def run(job: MirrorJob) -> JobResult:
        # One pool per job: with spark.scheduler.mode=FAIR, concurrent jobs
        # share the executors instead of queueing behind the largest one.
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"mirror-{job.mirror_name}")
        return run_job(spark, job, source, dest_root, staging_root=staging_root,
                       catalog_database=catalog_database, retries=retries, versioned=versioned,
                       deadline=deadline.get(job.name) if isinstance(deadline, Mapping) else deadline)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        running = {job.mirror_name: pool.submit(run, job) for job in largest_first(jobs, source)}
        results = [running[job.mirror_name].result() for job in jobs]
    summary = spark.createDataFrame([tuple(asdict(r).values()) for r in results], SUMMARY_SCHEMA)
    failed = [r.job for r in results if r.status != "ok"]
    if failed and raise_on_failure:
        raise BatchFailed(summary, failed)
    return summary
