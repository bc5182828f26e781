"""Chunked JDBC extraction.

One query per chunk predicate, run as one input partition each; Spark
appends the pushed-down job filter to every chunk's ``WHERE``. Type
overrides are applied by the reader (``customSchema``), so an overridden
integer year is compared as an integer inside the database.

Consistency note: the chunks are separate queries, hence separate source
transactions; a chunked extract is not a snapshot of the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from mirrorkit.functions.fixed import FETCH_SIZE
from mirrorkit.functions.types import overrides_ddl
from mirrorkit.operators.chunk_sql import chunks_from_source
from mirrorkit.operators.chunks import ChunkList


def jdbc_properties(
    properties: Mapping[str, str] | None = None,
    overrides: Mapping[str, str] | None = None,
    fetch_size: int = FETCH_SIZE,
) -> dict[str, str]:
    """Connection properties plus fetch size and the override schema."""
    props = {k: str(v) for k, v in (properties or {}).items()}
    props.setdefault("fetchsize", str(fetch_size))
    if overrides:
        props["customSchema"] = overrides_ddl(overrides)
    return props


def check_time_zone(spark: SparkSession) -> None:
    """Fail where timestamps would be shifted.

    A database's wall-clock timestamp becomes an instant in the zone of the
    JVM that reads it, and text again in the session's zone. ``build_session``
    starts driver and executors in the session's zone; a session made
    otherwise must do the same (``-Duser.timezone``).
    """
    session = spark.conf.get("spark.sql.session.timeZone")
    zones = spark.sparkContext._jvm.java.util.TimeZone
    host = zones.getDefault()
    if not host.hasSameRules(zones.getTimeZone(session)):
        raise RuntimeError(
            f"the JVM's time zone {host.getID()} differs from the session's {session}: timestamps read over JDBC "
            "would be shifted; start driver and executors with -Duser.timezone set to the session's zone")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    predicates: Sequence[str] | None = None,
    properties: Mapping[str, str] | None = None,
    overrides: Mapping[str, str] | None = None,
    fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """Scan ``table``; with ``predicates``, one partition (and query) per chunk.

    Chunks are taken as given, so overlapping chunks duplicate rows and gaps
    lose them; check a list with ``operators.chunks.chunk_coverage`` first.
    Without predicates the scan is one partition.
    """
    check_time_zone(spark)
    props = jdbc_properties(properties, overrides, fetch_size)
    if predicates is not None:
        if any(not p.strip() for p in predicates):
            raise ValueError("empty chunk predicate")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    return spark.read.jdbc(url, table, properties=props)


class JdbcSource:
    """A table source for batches: ``source(job)`` gives the job's raw extract."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str] | None = None,
                 fetch_size: int = FETCH_SIZE):
        self.spark = spark
        self.url = url
        self.properties = dict(properties or {})
        self.fetch_size = fetch_size

    # Chunks are applied by the database queries themselves.
    applies_chunks = True

    def __call__(self, job) -> DataFrame:
        return read_jdbc(
            self.spark, self.url, job.table_name,
            predicates=job.predicates, properties=self.properties,
            overrides=job.overrides, fetch_size=self.fetch_size,
        )

    def derived_chunks(self, table: str, column: str, chunks: int, *, split_column: str | None = None) -> ChunkList:
        """Balanced chunks of a table, counted by the database itself (no mirror needed yet)."""
        def run_sql(sql: str) -> list:
            # Rows come back in the query's order: one partition, a row per chunk.
            return [tuple(r) for r in read_jdbc(self.spark, self.url, f"({sql}) bounds", properties=self.properties).collect()]

        return chunks_from_source(run_sql, table, column, chunks, split_column=split_column)
