"""Registered queries over the driver's tables, each with a DuckDB oracle.

Sources are views over the given tables shaped like the relational tables a
mirror extracts: upper-case names, a DECIMAL(38,10) amount, a timestamp, a
14-digit text key, a year and a status column, plus planted traps (null
keys, null partition values, keys that fall between inclusive chunks,
amounts that overflow when narrowed). The view text is plain SQL that runs
unchanged in Spark and in DuckDB, so both sides start from the same rows.

Queries that write (mirrors, manifests, log text) write into a fresh folder
under the session's checkpoint directory and return a DataFrame that reads
the written result back.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorkit.functions.columns import log_line_text
from mirrorkit.functions.fixed import DEFAULT_CUR, GLOBAL_SCHEMA_OVERRIDES
from mirrorkit.functions.types import merge_overrides
from mirrorkit.operators import chunks as ch
from mirrorkit.operators.checks import definition_profile
from mirrorkit.operators.filters import apply_predicate, job_predicate
from mirrorkit.operators.infer import lost_values, proposed_overrides, type_profile
from mirrorkit.operators.normalize import lowercase_columns, normalize
from mirrorkit.operators.reconcile import (
    new_partitions,
    orphan_partitions,
    partition_status,
    partitions_of,
    rows_in,
    stale_files,
    touched_partitions,
    union_all,
)
from mirrorkit.plans.batch import TableSource, mirror_frame, run_batch, run_job
from mirrorkit.plans.job import MirrorJob, job_from_spec, jobs_from_specs
from mirrorkit.session import work_dir
from mirrorkit.sinks import manifest_log
from mirrorkit.sinks.parquet import compact_staged, stage_extract, write_mirror
from mirrorkit.sinks.versions import read_versioned
from mirrorkit.sources.files import read_keys, read_mirror
from mirrorkit.sources.listing import file_manifest, qualified_path
from mirrorkit.sources.logs import numbered_log_events, read_log_events
from mirrorkit.streaming.logs import ship_log_events

# ---------------------------------------------------------------------------
# Source views (same SQL text for Spark and DuckDB)
# ---------------------------------------------------------------------------

ORDERS_SOURCE_COLUMNS = (
    "CASE WHEN o_orderkey % 250 = 249 THEN lpad(CAST(o_orderkey AS STRING), 14, '0') || 'A' "
    "WHEN o_orderkey % 101 = 0 THEN NULL "
    "ELSE lpad(CAST(o_orderkey AS STRING), 14, '0') END AS PARID",
    "CASE WHEN o_orderkey % 107 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS TAXYR",
    "CASE WHEN o_orderkey % 109 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Y' "
    "WHEN o_orderstatus = 'O' THEN 'N' ELSE 'D' END AS CUR",
    "CAST(CAST(o_totalprice AS DECIMAL(28,2)) * CASE WHEN o_orderkey % 113 = 0 THEN 1000000 ELSE 1 END "
    "AS DECIMAL(38,10)) AS AMOUNT",
    "o_orderdate AS WHEN_TS",
    "o_custkey AS CUSTKEY",
    "o_orderpriority AS ORDERPRIORITY",
)

LINEITEM_SOURCE_COLUMNS = (
    "lpad(CAST(l_orderkey AS STRING), 14, '0') AS PARID",
    "l_linenumber AS LINENO",
    "CAST(year(l_shipdate) AS INT) AS TAXYR",
    "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS CUR",
    "CAST(l_quantity AS DECIMAL(38,10)) AS QUANTITY",
    "CAST(CAST(l_extendedprice AS DECIMAL(28,2)) AS DECIMAL(38,10)) AS EXTENDEDPRICE",
    "CAST(l_discount AS DECIMAL(15,2)) AS DISCOUNT",
    "l_returnflag AS RETURNFLAG",
    "l_shipdate AS SHIPDATE",
    "l_partkey AS PARTKEY",
    "l_suppkey AS SUPPKEY",
    "l_tax AS TAX",
)

EVENTS_SOURCE_COLUMNS = (
    "event_id AS EVENT_ID",
    "ts AS TS",
    "user_id AS USER_ID",
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 'Y' WHEN event_type = 'error' THEN 'D' "
    "ELSE 'N' END AS CUR",
    "event_type AS EVENT_TYPE",
    "value AS VALUE",
    "props AS PROPS",
)

CUSTOMER_SOURCE_COLUMNS = (
    "lpad(CAST(c_custkey AS STRING), 14, '0') AS PARID",
    "c_name AS NAME",
    "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Y' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'D' "
    "ELSE 'N' END AS CUR",
    "CAST(CAST(c_acctbal AS DECIMAL(28,2)) AS DECIMAL(38,10)) AS ACCTBAL",
    "c_nationkey AS NATIONKEY",
)

SUPPLIER_SOURCE_COLUMNS = (
    "s_suppkey AS SUPPKEY",
    "s_name AS NAME",
    "CASE WHEN s_acctbal < 0 THEN 'D' ELSE 'Y' END AS CUR",
    "CAST(CAST(s_acctbal AS DECIMAL(28,2)) AS DECIMAL(38,10)) AS ACCTBAL",
    "s_nationkey AS NATIONKEY",
)

SOURCES = {
    "orders_src": ("orders", ORDERS_SOURCE_COLUMNS),
    "lineitem_src": ("lineitem", LINEITEM_SOURCE_COLUMNS),
    "events_src": ("events", EVENTS_SOURCE_COLUMNS + ("CAST(year(ts) AS INT) AS TAXYR",)),
    "customer_src": ("customer", CUSTOMER_SOURCE_COLUMNS),
    "supplier_src": ("supplier", SUPPLIER_SOURCE_COLUMNS),
}


def source_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in SOURCES:
        table, columns = SOURCES[name]
        return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*columns)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_source(spark: SparkSession, sf_dir: str) -> TableSource:
    names = list(SOURCES) + ["region", "nation", "part", "documents", "embeddings"]
    return TableSource({n: (lambda n=n: source_frame(spark, sf_dir, n)) for n in names})


def _with_sources(sql: str, *names: str) -> str:
    ctes = [f"{n} AS (SELECT {', '.join(SOURCES[n][1])} FROM {SOURCES[n][0]})" for n in names]
    return f"WITH {', '.join(ctes)} {sql}"


# DuckDB spellings of the mirror conversions.
SQL_TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"
SQL_NARROW = "TRY_CAST({c} AS DECIMAL(10,0))"
ORDERS_NORMALIZED = (
    "PARID AS parid, TAXYR AS taxyr, CUR AS cur, "
    + SQL_NARROW.format(c="AMOUNT") + " AS amount, "
    + SQL_TS_TEXT.format(c="WHEN_TS") + " AS when_ts, CUSTKEY AS custkey, ORDERPRIORITY AS orderpriority"
)

YEAR_NOW = _dt.date.today().year
CUR_SQL = "('Y', 'N', 'D')"

# Inclusive chunk list in the hand-kept style: 6 ranges of 2,500 keys.
INCLUSIVE_CHUNKS = ch.inclusive_range_chunks("PARID", width=2500, count=6)
DERIVED_CHUNK_COUNT = 8


def _orders(spark, sf):
    return source_frame(spark, sf, "orders_src")


def _normalized_orders(spark, sf, overrides=GLOBAL_SCHEMA_OVERRIDES):
    return normalize(_orders(spark, sf), overrides, stamp=False)


def _filtered(years, cur):
    def run(spark, sf):
        return apply_predicate(_normalized_orders(spark, sf), job_predicate(years, cur))
    return run


def _filtered_sql(where: str | None) -> str:
    clause = f" WHERE {where}" if where else ""
    return _with_sources(f"SELECT {ORDERS_NORMALIZED} FROM orders_src{clause}", "orders_src")


def _default_filter(spark, sf):
    job = job_from_spec("default", {"table_name": "orders_src", "predicates_path": None})
    return apply_predicate(_normalized_orders(spark, sf), job.predicate)


# ---------------------------------------------------------------------------
# Scalar conversions
# ---------------------------------------------------------------------------

def _timestamp_to_string(spark, sf):
    return normalize(spark.read.parquet(f"{sf}/events.parquet"), stamp=False)


def _decimal_narrow(spark, sf):
    return normalize(_orders(spark, sf).select("PARID", "AMOUNT"), stamp=False)


SCHEMA_OVERRIDE_TABLE = {"AMOUNT": "DECIMAL(18,2)", "when_ts": "STRING"}


def _schema_override(spark, sf):
    overrides = merge_overrides(GLOBAL_SCHEMA_OVERRIDES, SCHEMA_OVERRIDE_TABLE)
    return normalize(_orders(spark, sf), overrides, stamp=False)


def _normalize_source(name):
    def run(spark, sf):
        return normalize(source_frame(spark, sf, name), GLOBAL_SCHEMA_OVERRIDES, stamp=False)
    return run


NORMALIZED_SQL = {
    "lineitem_src": (
        "SELECT PARID AS parid, LINENO AS lineno, TAXYR AS taxyr, CUR AS cur, "
        + SQL_NARROW.format(c="QUANTITY") + " AS quantity, "
        + SQL_NARROW.format(c="EXTENDEDPRICE") + " AS extendedprice, DISCOUNT AS discount, "
        "RETURNFLAG AS returnflag, " + SQL_TS_TEXT.format(c="SHIPDATE") + " AS shipdate, "
        "PARTKEY AS partkey, SUPPKEY AS suppkey, TAX AS tax FROM lineitem_src"
    ),
    "customer_src": (
        "SELECT PARID AS parid, NAME AS name, CUR AS cur, "
        + SQL_NARROW.format(c="ACCTBAL") + " AS acctbal, NATIONKEY AS nationkey FROM customer_src"
    ),
}


# ---------------------------------------------------------------------------
# Chunks
# ---------------------------------------------------------------------------

def _chunked_scan(spark, sf):
    return lowercase_columns(ch.chunked_scan(_orders(spark, sf), INCLUSIVE_CHUNKS, "CHUNK"))


def _chunked_scan_sql() -> str:
    cols = ("PARID AS parid, TAXYR AS taxyr, CUR AS cur, AMOUNT AS amount, WHEN_TS AS when_ts, "
            "CUSTKEY AS custkey, ORDERPRIORITY AS orderpriority")
    parts = [f"SELECT {i} AS chunk, {cols} FROM orders_src WHERE {p}" for i, p in enumerate(INCLUSIVE_CHUNKS)]
    return _with_sources(" UNION ALL ".join(parts), "orders_src")


def _coverage_sql(predicates) -> str:
    hits = " + ".join(f"(CASE WHEN {p} THEN 1 ELSE 0 END)" for p in predicates)
    return _with_sources(
        f"SELECT hits, count(*) AS n FROM (SELECT {hits} AS hits FROM orders_src) t GROUP BY hits",
        "orders_src",
    )


def _chunk_counts_sql() -> str:
    parts = [f"SELECT {i} AS chunk FROM orders_src WHERE {p}" for i, p in enumerate(INCLUSIVE_CHUNKS)]
    return _with_sources(
        f"SELECT chunk, count(*) AS n FROM ({' UNION ALL '.join(parts)}) t GROUP BY chunk", "orders_src"
    )


def _derived_chunks(spark, sf):
    return ch.derived_chunks(_orders(spark, sf), "PARID", DERIVED_CHUNK_COUNT)


def _chunk_bounds(spark, sf):
    return ch.derive_chunk_bounds(_orders(spark, sf), "PARID", DERIVED_CHUNK_COUNT)


def _chunk_bounds_sql() -> str:
    return _with_sources(
        "SELECT CAST(before * 8 // total AS INTEGER) AS part, min(key) AS lower FROM ("
        "SELECT key, sum(n) OVER (ORDER BY key) - n AS before, sum(n) OVER () AS total FROM ("
        "SELECT PARID AS key, count(*) AS n FROM orders_src WHERE PARID IS NOT NULL GROUP BY PARID)) GROUP BY part",
        "orders_src")


def _coverage_of(column, chunks):
    """Coverage of a list derived on ``column``: every row in exactly one chunk."""
    def run(spark, sf):
        return ch.chunk_coverage(_orders(spark, sf), ch.derived_chunks(_orders(spark, sf), column, chunks))
    return run


def _chunk_coverage_derived(spark, sf):
    return ch.chunk_coverage(_orders(spark, sf), _derived_chunks(spark, sf))


def _hot_key_chunks(spark, sf):
    """Chunks on a key whose three values each hold a third of the rows
    (``RETURNFLAG``), split further on ``PARID``."""
    return ch.derived_chunks(source_frame(spark, sf, "lineitem_src"), "RETURNFLAG", DERIVED_CHUNK_COUNT,
                             split_column="PARID")


def _chunk_coverage_hot(spark, sf):
    return ch.chunk_coverage(source_frame(spark, sf, "lineitem_src"), _hot_key_chunks(spark, sf))


def _chunk_counts_hot(spark, sf):
    return ch.chunk_counts(source_frame(spark, sf, "lineitem_src"), _hot_key_chunks(spark, sf))


def _chunk_counts_hot_sql() -> str:
    """Each of the three keys is hot: its chunks are ranges of PARID at exact
    cumulative counts, then its IS NULL chunk; chunk 0 (no hot key) is empty."""
    return _with_sources(
        ", total AS (SELECT count(*) // 8 AS per FROM lineitem_src), "
        "k AS (SELECT RETURNFLAG AS f, count(*) AS n, (count(*) + per - 1) // per AS parts "
        "FROM lineitem_src, total GROUP BY RETURNFLAG, per), "
        "p AS (SELECT RETURNFLAG AS f, PARID, count(*) AS n FROM lineitem_src GROUP BY ALL), "
        "c AS (SELECT p.f, p.n, (sum(p.n) OVER (PARTITION BY p.f ORDER BY PARID) - p.n) * parts // k.n AS part "
        "FROM p JOIN k ON p.f = k.f), "
        "d AS (SELECT f, part, sum(n) AS n, row_number() OVER (PARTITION BY f ORDER BY part) - 1 AS place "
        "FROM c GROUP BY f, part), "
        "w AS (SELECT f, 1 + coalesce(sum(count(*) + 1) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS first FROM d GROUP BY f) "
        "SELECT CAST(first + place AS INTEGER) AS chunk, CAST(n AS BIGINT) AS n FROM d JOIN w ON d.f = w.f",
        "lineitem_src")


# ---------------------------------------------------------------------------
# Mirrors: write, read back, replace, prune
# ---------------------------------------------------------------------------

def _orders_job(name, years, cur=DEFAULT_CUR, predicates=None):
    return MirrorJob(name, "orders_src", years, cur, predicates, tuple(GLOBAL_SCHEMA_OVERRIDES.items()))


def _mirror_orders(spark, sf, job, root=None, staging=False, source=None):
    root = root or work_dir(spark, "mirror")
    staging_root = work_dir(spark, "staging") if staging else None
    result = run_job(spark, job, source or table_source(spark, sf), root, staging_root=staging_root)
    if result.status != "ok":
        raise RuntimeError(result.error)
    return root, result


def _mirror_roundtrip(spark, sf):
    job = _orders_job("roundtrip", (1996, 2000))
    root, _ = _mirror_orders(spark, sf, job)
    return read_mirror(spark, f"{root}/{job.mirror_name}", job.partitions).drop("loaded_at")


def _staged_mirror(spark, sf):
    job = _orders_job("staged", (1996, 2000), predicates=tuple(_derived_chunks(spark, sf)))
    root, _ = _mirror_orders(spark, sf, job, staging=True)
    return read_mirror(spark, f"{root}/{job.mirror_name}", job.partitions).drop("loaded_at")


def _partition_replace(spark, sf):
    full = _orders_job("full", (1995, 2001))
    root, _ = _mirror_orders(spark, sf, full)
    # Second run: one partition again, from a source whose null-key rows are gone.
    shrunk = TableSource({"orders_src": lambda: _orders(spark, sf).where(F.col("PARID").isNotNull())})
    _mirror_orders(spark, sf, _orders_job("one", (1998, 1998), ("Y",)), root=root, source=shrunk)
    return read_mirror(spark, f"{root}/{full.mirror_name}", full.partitions).drop("loaded_at")


def _partition_replace_sql() -> str:
    kept = (f"SELECT {ORDERS_NORMALIZED} FROM orders_src WHERE TAXYR BETWEEN 1995 AND 2001 "
            f"AND CUR IN {CUR_SQL} AND NOT (TAXYR = 1998 AND CUR = 'Y')")
    redone = (f"SELECT {ORDERS_NORMALIZED} FROM orders_src WHERE TAXYR = 1998 AND CUR = 'Y' "
              "AND PARID IS NOT NULL")
    return _with_sources(f"{kept} UNION ALL {redone}", "orders_src")


def _mirror_pruned_read(spark, sf):
    job = _orders_job("pruned", (1995, 2001))
    root, _ = _mirror_orders(spark, sf, job)
    mirror = read_mirror(spark, f"{root}/{job.mirror_name}", job.partitions)
    return mirror.where((F.col("taxyr") == 1997) & (F.col("cur") == "N")).drop("loaded_at")


def _mirror_partition_counts(spark, sf):
    """Flagship: mirror the whole table with defaults and derived chunks, then
    count rows per partition of the mirror."""
    job = job_from_spec(
        "orders", {"table_name": "orders_src", "predicates_path": "derived"},
        predicate_sets={"derived": _derived_chunks(spark, sf)},
    )
    root, _ = _mirror_orders(spark, sf, job)
    mirror = read_mirror(spark, f"{root}/{job.mirror_name}", job.partitions)
    return mirror.groupBy("taxyr", "cur").agg(F.count(F.lit(1)).alias("n"))


def _catalog_mirror(spark, sf):
    """Mirror, register in the session catalog, then query the table by name."""
    job = _orders_job("catalog", (1996, 1998))
    root = work_dir(spark, "catalog")
    result = run_job(spark, job, table_source(spark, sf), root, catalog_database="default")
    if result.status != "ok":
        raise RuntimeError(result.error)
    return spark.table(f"default.{job.mirror_name}").groupBy("taxyr", "cur").agg(
        F.count(F.lit(1)).alias("n")
    )


def _catalog_mirror_retry(spark, sf):
    """A run whose catalog refresh never happened (1997), then a run that sees no new folder."""
    root = work_dir(spark, "catalog-retry")
    source = table_source(spark, sf)

    def mirror(years, database):
        job = MirrorJob("retry", "lineitem_src", years, ("Y", "N"), None, tuple(GLOBAL_SCHEMA_OVERRIDES.items()))
        result = run_job(spark, job, source, root, catalog_database=database)
        if result.status != "ok":
            raise RuntimeError(result.error)
        return job

    mirror((1996, 1996), "default")
    mirror((1997, 1997), None)
    job = mirror((1997, 1997), "default")
    return spark.table(f"default.{job.mirror_name}").groupBy("taxyr", "cur").agg(F.count(F.lit(1)).alias("n"))


def _default_predicates_mirror(spark, sf):
    """The shortest spec: a table name and nothing else."""
    job = job_from_spec("short", {"table_name": "orders_src"})
    root, _ = _mirror_orders(spark, sf, job)
    return read_mirror(spark, f"{root}/{job.mirror_name}", job.partitions).drop("loaded_at")


def _pass_through(table):
    """A table without year, status or chunks, mirrored whole and read back."""
    def run(spark, sf):
        job = job_from_spec(table, {"table_name": table, "min_year": None, "max_year": None, "cur": None,
                                    "predicates_path": None})
        root = work_dir(spark, "mirror")
        result = run_job(spark, job, table_source(spark, sf), root)
        if result.status != "ok":
            raise RuntimeError(result.error)
        return read_mirror(spark, f"{root}/{job.mirror_name}", ()).drop("loaded_at")
    return run


def _embeddings_mirror(spark, sf):
    """Nested values survive: one row per component."""
    return _pass_through("embeddings")(spark, sf).select(
        "vec_id", "label", F.posexplode("embedding").alias("place", "component"))


def _null_partition_roundtrip(spark, sf):
    """Unfiltered rows, so null years and statuses become partitions."""
    path = f"{work_dir(spark, 'mirror')}/nulls"
    write_mirror(_normalized_orders(spark, sf), path, ("taxyr", "cur"))
    return read_mirror(spark, path, ("taxyr", "cur"))


ROW_CAP = 1000


def _row_cap_files(spark, sf):
    """Files of an unpartitioned mirror with a row cap, and the most rows in one."""
    path = f"{work_dir(spark, 'mirror')}/capped"
    write_mirror(_normalized_orders(spark, sf), path, max_rows_per_file=ROW_CAP)
    rows = read_mirror(spark, path, ()).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(F.count(F.lit(1)).alias("files"), F.max("n").alias("most"), F.sum("n").alias("n"))


def _unpartitioned_files(spark, sf):
    """An unpartitioned table far below the file size is one file, whatever the cores."""
    path = f"{work_dir(spark, 'mirror')}/whole"
    write_mirror(normalize(source_frame(spark, sf, "lineitem_src"), stamp=False), path)
    rows = read_mirror(spark, path, ()).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("n"))


def _old_dates(spark, sf):
    """Dates three centuries back keep their calendar value through a mirror."""
    path = f"{work_dir(spark, 'mirror')}/old"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    old = orders.select(F.col("o_orderkey").alias("parid"), F.add_months("o_orderdate", -3600).alias("old_date"))
    write_mirror(old, path)
    return read_mirror(spark, path, ()).select("parid", F.date_format("old_date", "yyyy-MM-dd").alias("old_date"))


def _override_precedence(spark, sf):
    """Two layers name the amount column, in different case: the later one wins."""
    overrides = merge_overrides(GLOBAL_SCHEMA_OVERRIDES, {"amount": "STRING"}, {"AMOUNT": "DECIMAL(18,2)"})
    return normalize(_orders(spark, sf), overrides, stamp=False).select("parid", "amount")


def _unpartitioned_replace(spark, sf):
    """An unpartitioned mirror is replaced whole by the next run."""
    root = work_dir(spark, "mirror")
    job = job_from_spec("orders", {"table_name": "orders_src", "min_year": None, "max_year": None, "cur": None,
                                   "predicates_path": None})
    for source in (table_source(spark, sf),
                   TableSource({"orders_src": lambda: _orders(spark, sf).where("TAXYR >= 1998")})):
        result = run_job(spark, job, source, root)
        if result.status != "ok":
            raise RuntimeError(result.error)
    return read_mirror(spark, f"{root}/{job.mirror_name}", ()).drop("loaded_at")


def _compacted_file_counts(spark, sf):
    """Files per Hive partition after compaction: one each, at this scale
    (every partition is far below the split size and the row cap)."""
    job = _orders_job("files", (1995, 2001))
    root, _ = _mirror_orders(spark, sf, job)
    manifest = file_manifest(spark, f"{root}/{job.mirror_name}", job.partitions)
    return manifest.groupBy(F.col("taxyr").cast("int").alias("taxyr"), "cur").agg(
        F.count(F.lit(1)).alias("files")
    )


def _compacted_file_counts_sql() -> str:
    return _with_sources(
        "SELECT TAXYR AS taxyr, CUR AS cur, CAST(1 AS BIGINT) AS files FROM orders_src "
        f"WHERE TAXYR BETWEEN 1995 AND 2001 AND CUR IN {CUR_SQL} GROUP BY TAXYR, CUR",
        "orders_src",
    )


# ---------------------------------------------------------------------------
# Reconciliation: published mirror vs a new run into the same folder
# ---------------------------------------------------------------------------

PUBLISHED_YEARS = {"orders_src": (1995, 1998), "lineitem_src": (1995, 1997)}
RUN_YEARS = {"orders_src": (1997, 2001), "lineitem_src": (1996, 2001)}
CUR_BY_SOURCE = {"orders_src": DEFAULT_CUR, "lineitem_src": ("Y", "N")}


def _publish(spark, sf, table, spelling="{root}"):
    root = spelling.format(root=work_dir(spark, "publish"))
    source = table_source(spark, sf)
    overrides = tuple(GLOBAL_SCHEMA_OVERRIDES.items())
    cur = CUR_BY_SOURCE[table]
    published = MirrorJob("published", table, PUBLISHED_YEARS[table], cur, None, overrides)
    rerun = MirrorJob("run", table, RUN_YEARS[table], cur, None, overrides)
    first = run_job(spark, published, source, root)
    if first.status != "ok":
        raise RuntimeError(first.error)
    dest = f"{root}/{rerun.mirror_name}"
    before = file_manifest(spark, dest, rerun.partitions, table=table).checkpoint(eager=True)
    result = run_job(spark, rerun, source, root)
    if result.status != "ok":
        raise RuntimeError(result.error)
    after = file_manifest(spark, dest, rerun.partitions, table=table)
    return before, after, list(rerun.partitions)


def _typed_partitions(df):
    return df.select(F.col("taxyr").cast("int").alias("taxyr"), "cur")


def _touched_partitions(spark, sf):
    before, after, parts = _publish(spark, sf, "orders_src")
    return _typed_partitions(touched_partitions(after, before, parts))


def _new_partitions(spark, sf):
    before, after, parts = _publish(spark, sf, "orders_src")
    return _typed_partitions(new_partitions(after, before, parts))


def _stale_partitions(spark, sf):
    before, after, parts = _publish(spark, sf, "orders_src")
    return _typed_partitions(partitions_of(stale_files(after, before), parts))


def _stale_files(spark, sf):
    """Removed files per replaced partition: one each at this scale."""
    before, after, parts = _publish(spark, sf, "orders_src")
    return stale_files(after, before).groupBy(F.col("taxyr").cast("int").alias("taxyr"), "cur").agg(
        F.count(F.lit(1)).alias("files"))


def _stale_files_sql() -> str:
    t = "orders_src"
    run, pub = (_distinct_parts_sql(t, y[t], CUR_BY_SOURCE[t]) for y in (RUN_YEARS, PUBLISHED_YEARS))
    return _with_sources(f"SELECT taxyr, cur, CAST(1 AS BIGINT) AS files FROM ({run} INTERSECT {pub}) x", t)


def _new_partitions_spelled(spark, sf):
    """The same report when the destination is spelled with doubled and dotted segments."""
    before, after, parts = _publish(spark, sf, "orders_src", "{root}//one/../two/")
    return _typed_partitions(new_partitions(after, before, parts))


def _orphan_partitions(spark, sf):
    """Re-run the full job after every row of one partition left the source."""
    root = work_dir(spark, "orphans")
    job = _orders_job("full", (1995, 2001))
    run_job(spark, job, table_source(spark, sf), root)
    dest = f"{root}/{job.mirror_name}"
    before = file_manifest(spark, dest, job.partitions).checkpoint(eager=True)
    vanished = TableSource({"orders_src": lambda: _orders(spark, sf).where(
        ~((F.col("TAXYR") == 1998) & (F.col("CUR") == "Y")))})
    result = run_job(spark, job, vanished, root)
    if result.status != "ok":
        raise RuntimeError(result.error)
    after = file_manifest(spark, dest, job.partitions)
    return _typed_partitions(orphan_partitions(after, before, job.partitions, job.partition_scope))


def _orphan_partitions_sql() -> str:
    scope = f"TAXYR BETWEEN 1995 AND 2001 AND CUR IN {CUR_SQL}"
    return _with_sources(
        f"SELECT DISTINCT TAXYR AS taxyr, CUR AS cur FROM orders_src WHERE {scope} EXCEPT "
        f"SELECT DISTINCT TAXYR, CUR FROM orders_src WHERE {scope} AND NOT (TAXYR = 1998 AND CUR = 'Y')",
        "orders_src",
    )


def _partition_status(spark, sf):
    before, after, parts = _publish(spark, sf, "orders_src")
    return partition_status(after, before, parts).select(
        F.col("taxyr").cast("int").alias("taxyr"), "cur",
        "existed_before", "exists_after", "touched", "removed_files",
    )


def _partition_status_sql() -> str:
    t = "orders_src"
    run = _distinct_parts_sql(t, RUN_YEARS[t], CUR_BY_SOURCE[t])
    pub = _distinct_parts_sql(t, PUBLISHED_YEARS[t], CUR_BY_SOURCE[t])
    # One file per partition at this scale: a touched partition that existed
    # before loses exactly one file.
    return _with_sources(
        "SELECT coalesce(p.taxyr, r.taxyr) AS taxyr, coalesce(p.cur, r.cur) AS cur, "
        "p.taxyr IS NOT NULL AS existed_before, TRUE AS exists_after, r.taxyr IS NOT NULL AS touched, "
        "CAST(CASE WHEN p.taxyr IS NOT NULL AND r.taxyr IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS removed_files "
        f"FROM ({pub}) p FULL OUTER JOIN ({run}) r ON p.taxyr = r.taxyr AND p.cur = r.cur",
        t,
    )


def _new_partitions_all(spark, sf):
    reports = []
    for table in ("orders_src", "lineitem_src"):
        before, after, parts = _publish(spark, sf, table)
        reports.append(
            new_partitions(after, before, parts)
            .select("table_name", F.col("taxyr").cast("int").alias("taxyr"), "cur")
        )
    return union_all(reports)


def _distinct_parts_sql(source: str, years, cur) -> str:
    cur_list = ", ".join(f"'{c}'" for c in cur)
    return (f"SELECT DISTINCT TAXYR AS taxyr, CUR AS cur FROM {source} "
            f"WHERE TAXYR BETWEEN {years[0]} AND {years[1]} AND CUR IN ({cur_list})")


def _reconcile_sql(kind: str) -> str:
    t = "orders_src"
    run = _distinct_parts_sql(t, RUN_YEARS[t], CUR_BY_SOURCE[t])
    pub = _distinct_parts_sql(t, PUBLISHED_YEARS[t], CUR_BY_SOURCE[t])
    body = {"touched": run, "new": f"{run} EXCEPT {pub}", "stale": f"{run} INTERSECT {pub}"}[kind]
    return _with_sources(body, t)


def _new_partitions_all_sql() -> str:
    parts = []
    for t in ("orders_src", "lineitem_src"):
        run = _distinct_parts_sql(t, RUN_YEARS[t], CUR_BY_SOURCE[t])
        pub = _distinct_parts_sql(t, PUBLISHED_YEARS[t], CUR_BY_SOURCE[t])
        parts.append(f"SELECT '{t}' AS table_name, taxyr, cur FROM ({run} EXCEPT {pub}) x")
    return _with_sources(" UNION ALL ".join(parts), "orders_src", "lineitem_src")


# ---------------------------------------------------------------------------
# Versioned mirrors: written beside, switched by manifest log and catalog
# ---------------------------------------------------------------------------

def _database(spark: SparkSession, root: str) -> str:
    """A catalog database of its own for one query's tables."""
    name = "v_" + root.rstrip("/").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/tables'")
    return name


def _versioned_runs(spark, sf, runs, catalog=True):
    """Runs jobs (job, source) one after another into one versioned mirror: its folder and catalog name."""
    root = work_dir(spark, "versions")
    database = _database(spark, root) if catalog else None
    for job, source in runs:
        result = run_job(spark, job, source, root, catalog_database=database, versioned=True)
        if result.status != "ok":
            raise RuntimeError(result.error)
    return f"{root}/{job.mirror_name}", f"{database}.{job.mirror_name}"


def _replaced_versions(spark, sf, catalog):
    """The runs of ``partition_replace``, published by switching."""
    shrunk = TableSource({"orders_src": lambda: _orders(spark, sf).where(F.col("PARID").isNotNull())})
    return _versioned_runs(spark, sf, [(_orders_job("full", (1995, 2001)), table_source(spark, sf)),
                                       (_orders_job("one", (1998, 1998), ("Y",)), shrunk)], catalog)


def _partition_replace_versioned(spark, sf):
    return spark.table(_replaced_versions(spark, sf, True)[1]).drop("loaded_at")


def _partition_replace_logged(spark, sf):
    return read_versioned(spark, _replaced_versions(spark, sf, False)[0]).drop("loaded_at")


def _mirror_as_of(spark, sf):
    """The same mirror as it was after the first run."""
    return read_versioned(spark, _replaced_versions(spark, sf, False)[0], as_of=1).drop("loaded_at")


def _published_versions(spark, sf):
    """Manifests before and after the second run, from the log alone."""
    t, overrides = "orders_src", tuple(GLOBAL_SCHEMA_OVERRIDES.items())
    jobs = [MirrorJob(name, t, years[t], CUR_BY_SOURCE[t], None, overrides)
            for name, years in (("published", PUBLISHED_YEARS), ("run", RUN_YEARS))]
    mirror, _ = _versioned_runs(spark, sf, [(job, table_source(spark, sf)) for job in jobs], catalog=False)
    return [manifest_log.manifest(spark, mirror, jobs[1].partitions, number) for number in (1, 2)]


def _new_partitions_versioned(spark, sf):
    before, after = _published_versions(spark, sf)
    return _typed_partitions(new_partitions(after, before, ("taxyr", "cur")))


def _stale_files_versioned(spark, sf):
    before, after = _published_versions(spark, sf)
    return stale_files(after, before).groupBy(F.col("taxyr").cast("int").alias("taxyr"), "cur").agg(
        F.count(F.lit(1)).alias("files"))


def _logged_rows(spark, sf):
    """Rows per partition as the log has them; no data is read."""
    before, after = _published_versions(spark, sf)
    return after.groupBy(F.col("taxyr").cast("int").alias("taxyr"), "cur").agg(F.sum("rows").alias("n"))


def _logged_rows_sql() -> str:
    t = "orders_src"
    lo, hi = PUBLISHED_YEARS[t][0], RUN_YEARS[t][1]
    return _with_sources(f"SELECT TAXYR AS taxyr, CUR AS cur, count(*) AS n FROM {t} WHERE TAXYR BETWEEN {lo} AND {hi} "
                         f"AND CUR IN {CUR_SQL} GROUP BY TAXYR, CUR", t)


def _evolution_runs(spark, sf):
    """Amounts are numbers in the first run, and text in a second one over some of its partitions and new ones."""
    text = tuple(merge_overrides(GLOBAL_SCHEMA_OVERRIDES, {"amount": "STRING"}).items())
    wider = TableSource({"orders_src": lambda: _orders(spark, sf).withColumn("NOTE", F.col("ORDERPRIORITY"))})
    return [(_orders_job("numbers", (1995, 1998)), table_source(spark, sf)),
            (MirrorJob("text", "orders_src", (1998, 2000), DEFAULT_CUR, None, text), wider)]


def _schema_evolution(spark, sf):
    return spark.table(_versioned_runs(spark, sf, _evolution_runs(spark, sf))[1]).drop("loaded_at")


def _schema_evolution_logged(spark, sf):
    return read_versioned(spark, _versioned_runs(spark, sf, _evolution_runs(spark, sf), catalog=False)[0]).drop("loaded_at")


def _schema_evolution_in_place(spark, sf):
    """The same runs into a mirror that replaces its folders."""
    root = work_dir(spark, "evolution")
    database = _database(spark, root)
    for job, source in _evolution_runs(spark, sf):
        result = run_job(spark, job, source, root, catalog_database=database)
        if result.status != "ok":
            raise RuntimeError(result.error)
    return spark.table(f"{database}.{job.mirror_name}").drop("loaded_at")


def _schema_evolution_sql() -> str:
    def part(years, amount, note):
        columns = ORDERS_NORMALIZED.replace(SQL_NARROW.format(c="AMOUNT"), f"CAST({amount} AS VARCHAR)")
        return f"SELECT {columns}, {note} AS note FROM orders_src WHERE TAXYR BETWEEN {years} AND CUR IN {CUR_SQL}"

    old = part("1995 AND 1997", SQL_NARROW.format(c="AMOUNT"), "CAST(NULL AS VARCHAR)")
    return _with_sources(f"{old} UNION ALL {part('1998 AND 2000', 'AMOUNT', 'ORDERPRIORITY')}", "orders_src")


# ---------------------------------------------------------------------------
# Reading a mirror: keys, partitions of a report
# ---------------------------------------------------------------------------

def _point_mirror(spark, sf):
    """Line items prepared for reads of single keys."""
    path = f"{work_dir(spark, 'mirror')}/points"
    write_mirror(normalize(source_frame(spark, sf, "lineitem_src"), stamp=False), path, ("taxyr", "cur"), point_key="parid")
    return read_mirror(spark, path, ("taxyr", "cur"))


#: Keys that exist at every size, keys that don't, and more than the reader tests in one pass.
POINT_KEYS = tuple(f"{n:014d}" for n in (0, 1, 2, 3, 5, 7, 32, 33, 34, 77, 400, 401, 4002, 99999999))


def _mirror_point_read(spark, sf):
    return read_keys(_point_mirror(spark, sf), "parid", POINT_KEYS)


def _touched_rows(spark, sf):
    """Rows of the partitions that the last run touched: the report is joined to the mirror."""
    t, overrides = "orders_src", tuple(GLOBAL_SCHEMA_OVERRIDES.items())
    jobs = [MirrorJob(name, t, years[t], CUR_BY_SOURCE[t], None, overrides)
            for name, years in (("published", PUBLISHED_YEARS), ("run", RUN_YEARS))]
    mirror, name = _versioned_runs(spark, sf, [(job, table_source(spark, sf)) for job in jobs])
    last = manifest_log.commits(spark, mirror)[-1]
    return rows_in(spark.table(name), manifest_log.touched_by(spark, mirror, last), last.partitions).drop("loaded_at")


# ---------------------------------------------------------------------------
# Derived overrides
# ---------------------------------------------------------------------------

def _derived_overrides(name):
    return lambda spark, sf: type_profile(source_frame(spark, sf, name))


def _derived_overrides_applied(name):
    """Values that the proposed types lose: none."""
    def run(spark, sf):
        df = source_frame(spark, sf, name)
        return lost_values(df, proposed_overrides(df))
    return run


def _profile_sql(name: str, columns: dict[str, str], lost: bool = False) -> str:
    """``columns``: name to declared type, as Spark spells it."""
    def whole(low, high):
        return (f"CASE WHEN {low} >= -128 AND {high} < 128 THEN 'TINYINT' WHEN {low} >= -32768 AND {high} < 32768 THEN 'SMALLINT' "
                f"WHEN {low} >= -2147483648 AND {high} < 2147483648 THEN 'INT' ELSE 'BIGINT' END")

    def proposed(c, t):
        if t in ("TINYINT", "SMALLINT", "INT", "BIGINT"):
            return f"(SELECT {whole(f'min({c})', f'max({c})')} FROM {name})"
        if t.startswith("DECIMAL"):
            scale = int(t[8:-1].split(",")[1])
            used = " + ".join(f"CASE WHEN round({c}, {k}) <> {c} THEN 1 ELSE 0 END" for k in range(scale)) or "0"
            return (f"(SELECT 'DECIMAL(' || greatest(1, CASE WHEN size < 1 THEN 0 ELSE length(CAST(floor(size) AS DECIMAL(38,0))::VARCHAR) END + used) "
                    f"|| ',' || used || ')' FROM (SELECT max(abs({c})) AS size, max({used}) AS used FROM {name}))")
        if t in ("DOUBLE", "FLOAT"):
            return (f"(SELECT CASE WHEN bool_and({c} = floor({c})) THEN {whole(f'min({c})', f'max({c})')} ELSE '{t}' END FROM {name})")
        if t.startswith("TIMESTAMP"):
            return f"(SELECT CASE WHEN bool_and(date_trunc('day', {c}) = {c}) THEN 'DATE' ELSE '{t}' END FROM {name})"
        return (f"(SELECT CASE WHEN bool_and(coalesce(CAST(TRY_CAST({c} AS BIGINT) AS VARCHAR) = {c}, false)) THEN 'BIGINT' "
                f"WHEN bool_and(coalesce(CAST(TRY_CAST({c} AS DATE) AS VARCHAR) = {c}, false)) THEN 'DATE' ELSE '{t}' END "
                f"FROM {name} WHERE {c} IS NOT NULL)")

    parts = [f"SELECT '{c.lower()}' AS \"column\", '{t}' AS declared, coalesce({proposed(c, t)}, '{t}') AS proposed, "
             f"(SELECT CAST(count_if({c} IS NULL) AS BIGINT) FROM {name}) AS nulls" for c, t in columns.items()]
    body = " UNION ALL ".join(parts)
    if lost:
        body = f'SELECT "column", CAST(0 AS BIGINT) AS lost FROM ({body}) t WHERE declared <> proposed'
    return _with_sources(body, name)


PROFILED = {
    "orders_src": {"PARID": "STRING", "TAXYR": "INT", "CUR": "STRING", "AMOUNT": "DECIMAL(38,10)", "WHEN_TS": "TIMESTAMP_NTZ",
                   "CUSTKEY": "BIGINT", "ORDERPRIORITY": "STRING"},
    "lineitem_src": {"PARID": "STRING", "LINENO": "INT", "TAXYR": "INT", "CUR": "STRING", "QUANTITY": "DECIMAL(38,10)",
                     "EXTENDEDPRICE": "DECIMAL(38,10)", "DISCOUNT": "DECIMAL(15,2)", "RETURNFLAG": "STRING", "SHIPDATE": "TIMESTAMP_NTZ",
                     "PARTKEY": "BIGINT", "SUPPKEY": "BIGINT", "TAX": "DOUBLE"},
}


# ---------------------------------------------------------------------------
# Small items: unchunked and filtered scans, remote roots, stamps, codecs, descriptions
# ---------------------------------------------------------------------------

def _unchunked_scan(spark, sf):
    """No predicates: one scan, every row once."""
    job = job_from_spec("whole", {"table_name": "orders_src", "min_year": None, "max_year": None, "cur": None, "predicates_path": None})
    return mirror_frame(job, table_source(spark, sf), stamp=False)


def _chunk_and_filter(spark, sf):
    """Chunks and the job's filter together: rows in no chunk are lost, rows outside the filter too."""
    return mirror_frame(_orders_job("both", (1996, 1998), ("Y", "D"), tuple(INCLUSIVE_CHUNKS)), table_source(spark, sf), stamp=False)


def _published_by_uri(spark, sf):
    """The destination is a URI with its scheme."""
    job = _orders_job("uri", (1996, 1998))
    root, _ = _mirror_orders(spark, sf, job, root=qualified_path(spark, work_dir(spark, "publish")))
    return root, job


def _published_mirror(spark, sf):
    root, job = _published_by_uri(spark, sf)
    return read_mirror(spark, f"{root}/{job.mirror_name}", job.partitions).drop("loaded_at")


def _remote_listing(spark, sf):
    root, job = _published_by_uri(spark, sf)
    files = file_manifest(spark, f"{root}/{job.mirror_name}", job.partitions)
    return files.groupBy(F.col("taxyr").cast("int").alias("taxyr"), "cur").agg(F.count(F.lit(1)).alias("files"))


def _load_stamps(spark, sf):
    """All rows of a run have one load stamp, in the mirror's text form."""
    job = _orders_job("stamps", (1996, 1998))
    root, _ = _mirror_orders(spark, sf, job)
    stamp = F.col("loaded_at")
    return read_mirror(spark, f"{root}/{job.mirror_name}", job.partitions).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(stamp).alias("stamps"),
        F.bool_and(stamp.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}$")).alias("well_formed"))


def _file_codecs(spark, sf):
    """Rows by codec, of staged files and of the files compacted from them."""
    root = work_dir(spark, "codecs")
    frame = normalize(source_frame(spark, sf, "lineitem_src"), stamp=False)
    stage_extract(frame, f"{root}/staged")
    compact_staged(spark, f"{root}/staged", f"{root}/final", frame.schema, ("taxyr", "cur"))
    parts = []
    for step in ("staged", "final"):
        name = F.regexp_extract(F.input_file_name(), r"\.([a-z]+)\.parquet$", 1)
        parts.append(spark.read.schema(frame.schema).parquet(f"{root}/{step}").select(F.lit(step).alias("step"), name.alias("codec")))
    return union_all(parts).groupBy("step", "codec").agg(F.count(F.lit(1)).alias("n"))


def _batch_descriptions(spark, sf):
    """Each job's description and rows, as the summary has them."""
    summary = run_batch(spark, _batch_jobs(spark, sf), table_source(spark, sf), work_dir(spark, "batch"))
    return summary.select("job", "description", "rows")


def _batch_descriptions_sql() -> str:
    years = {"orders": "[1996, 2000]", "lineitem": "[1995, 1997]", "events": f"[2020, {YEAR_NOW}]"}
    status = {"orders": "[Y, N, D]", "events": "[Y, N, D]", "customer": "[Y, N, D]", "supplier": "[Y]"}
    text = {job: SAMPLE_BATCH[job]["table_name"] + (f", taxyr={years[job]}" if job in years else "")
            + (f", cur={status[job]}" if job in status else "") for job in SAMPLE_BATCH}
    case = "CASE job " + " ".join(f"WHEN '{job}' THEN '{t}'" for job, t in text.items()) + " END"
    return _batch_summary_sql().replace("SELECT 'region' AS job", f"SELECT job, {case} AS description, rows FROM (SELECT 'region' AS job", 1) + ") s"


def _batch_deadline(spark, sf):
    """A source that never ends is cancelled at its deadline; the other jobs' rows are there."""
    def endless():
        def rows(batches):
            for batch in batches:
                while True:
                    time.sleep(0.05)
                    yield batch
        return source_frame(spark, sf, "region").mapInArrow(rows, source_frame(spark, sf, "region").schema)

    source = table_source(spark, sf)
    source.tables["endless"] = endless
    whole = {"min_year": None, "max_year": None, "cur": None, "predicates_path": None}
    jobs = [*_batch_jobs(spark, sf), job_from_spec("endless", {"table_name": "endless", **whole})]
    summary = run_batch(spark, jobs, source, work_dir(spark, "batch"), deadline={"endless": 5.0}, raise_on_failure=False)
    return summary.select("job", "status", "rows")


def _batch_deadline_sql() -> str:
    return _batch_summary_sql().replace("SELECT 'region' AS job", "SELECT job, 'ok' AS status, rows FROM (SELECT 'region' AS job", 1) + (
        ") s UNION ALL SELECT 'endless', 'cancelled', CAST(NULL AS BIGINT)")


# ---------------------------------------------------------------------------
# Batches, definitions, logs
# ---------------------------------------------------------------------------

# A sample batch in the job-spec form users keep in YAML/JSON, covering the
# seven job shapes: plain, year+cur+chunks, year+chunks, year only, year+cur,
# cur+chunks, cur only. Table names carry a schema prefix, as in a database.
SAMPLE_BATCH = {
    "region": {"table_name": "tpch.region", "min_year": None, "max_year": None, "cur": None,
               "predicates_path": None},
    "orders": {"table_name": "tpch.orders_src", "min_year": 1996, "max_year": 2000,
               "predicates_path": "orders_chunks"},
    "lineitem": {"table_name": "tpch.lineitem_src", "min_year": 1995, "max_year": 1997, "cur": None,
                 "predicates_path": "lineitem_chunks"},
    "nation": {"table_name": "tpch.nation", "min_year": None, "max_year": None, "cur": None,
               "predicates_path": None},
    "events": {"table_name": "tpch.events_src", "min_year": 2020, "predicates_path": None},
    "customer": {"table_name": "tpch.customer_src", "min_year": None, "max_year": None,
                 "predicates_path": "customer_chunks"},
    "supplier": {"table_name": "tpch.supplier_src", "min_year": None, "max_year": None,
                 "cur": ["Y"], "predicates_path": None},
}


def _batch_jobs(spark, sf):
    chunk_sets = {
        f"{t}_chunks": ch.derived_chunks(source_frame(spark, sf, f"{t}_src"), "PARID", DERIVED_CHUNK_COUNT)
        for t in ("orders", "lineitem", "customer")
    }
    return jobs_from_specs(SAMPLE_BATCH, predicate_sets=chunk_sets)


def _batch_summary(spark, sf):
    summary = run_batch(spark, _batch_jobs(spark, sf), table_source(spark, sf), work_dir(spark, "batch"))
    return summary.select("job", "partitions", "rows", "overflow_rows", "new_partitions")


def _narrow_overflow_sql(*cols: str) -> str:
    tests = [f"({c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL(10,0)) IS NULL)" for c in cols]
    return f"CAST(count_if({' OR '.join(tests)}) AS BIGINT)"


def _batch_summary_sql() -> str:
    zero, one = "CAST(0 AS BIGINT)", "CAST(1 AS BIGINT)"
    parts = [
        f"SELECT 'region' AS job, '' AS partitions, count(*) AS rows, {zero} AS overflow_rows, "
        f"{one} AS new_partitions FROM region",
        f"SELECT 'orders', 'taxyr,cur', count(*), {_narrow_overflow_sql('AMOUNT')}, "
        "count(DISTINCT (TAXYR, CUR)) FROM orders_src "
        f"WHERE TAXYR BETWEEN 1996 AND 2000 AND CUR IN {CUR_SQL}",
        f"SELECT 'lineitem', 'taxyr', count(*), {_narrow_overflow_sql('QUANTITY', 'EXTENDEDPRICE')}, "
        "count(DISTINCT TAXYR) FROM lineitem_src WHERE TAXYR BETWEEN 1995 AND 1997",
        f"SELECT 'nation', '', count(*), {zero}, {one} FROM nation",
        f"SELECT 'events', 'taxyr,cur', count(*), {zero}, count(DISTINCT (TAXYR, CUR)) FROM events_src "
        f"WHERE TAXYR BETWEEN 2020 AND {YEAR_NOW} AND CUR IN {CUR_SQL}",
        f"SELECT 'customer', 'cur', count(*), {_narrow_overflow_sql('ACCTBAL')}, count(DISTINCT CUR) "
        f"FROM customer_src WHERE CUR IN {CUR_SQL}",
        f"SELECT 'supplier', 'cur', count(*), {_narrow_overflow_sql('ACCTBAL')}, count(DISTINCT CUR) "
        "FROM supplier_src WHERE CUR IN ('Y')",
    ]
    return _with_sources(" UNION ALL ".join(parts), *SOURCES)


def _manifest_counts(spark, sf):
    root = work_dir(spark, "batch")
    run_batch(spark, _batch_jobs(spark, sf), table_source(spark, sf), root)
    files = file_manifest(spark, root)
    table = F.regexp_extract(F.col("rel_path"), r"^([^/]+)/", 1).alias("table_name")
    return files.groupBy(table).agg(F.count(F.lit(1)).alias("files"))


def _manifest_counts_sql() -> str:
    """Files per mirrored table of the sample batch: one per Hive partition."""
    one = "CAST(1 AS BIGINT)"
    parts = [
        f"SELECT 'region' AS table_name, {one} AS files",
        "SELECT 'orders_src', count(DISTINCT (TAXYR, CUR)) FROM orders_src "
        f"WHERE TAXYR BETWEEN 1996 AND 2000 AND CUR IN {CUR_SQL}",
        "SELECT 'lineitem_src', count(DISTINCT TAXYR) FROM lineitem_src WHERE TAXYR BETWEEN 1995 AND 1997",
        f"SELECT 'nation', {one}",
        "SELECT 'events_src', count(DISTINCT (TAXYR, CUR)) FROM events_src "
        f"WHERE TAXYR BETWEEN 2020 AND {YEAR_NOW} AND CUR IN {CUR_SQL}",
        f"SELECT 'customer_src', count(DISTINCT CUR) FROM customer_src WHERE CUR IN {CUR_SQL}",
        "SELECT 'supplier_src', count(DISTINCT CUR) FROM supplier_src WHERE CUR IN ('Y')",
    ]
    return _with_sources(" UNION ALL ".join(parts), *SOURCES)


def _definition_check(spark, sf):
    return union_all([
        definition_profile(source_frame(spark, sf, "orders_src"), "orders_src"),
        definition_profile(source_frame(spark, sf, "lineitem_src"), "lineitem_src"),
        definition_profile(source_frame(spark, sf, "region"), "region"),
    ])


def _definition_check_sql() -> str:
    def prof(t, has_year=True, has_key=True, has_cur=True):
        null_i, null_l = "CAST(NULL AS INTEGER)", "CAST(NULL AS BIGINT)"
        return (
            f"SELECT '{t}' AS table_name, count(*) AS rows, "
            f"{'min(TAXYR)' if has_year else null_i} AS min_year, "
            f"{'max(TAXYR)' if has_year else null_i} AS max_year, "
            f"{'CAST(count_if(TAXYR IS NULL) AS BIGINT)' if has_year else null_l} AS null_year_rows, "
            f"{'CAST(count_if(PARID IS NULL) AS BIGINT)' if has_key else null_l} AS null_key_rows, "
            f"{'CAST(count_if(CUR IS NULL) AS BIGINT)' if has_cur else null_l} AS null_cur_rows, "
            f"{'CAST(count_if(CUR NOT IN ' + CUR_SQL + ') AS BIGINT)' if has_cur else null_l} AS unexpected_cur_rows "
            f"FROM {t}"
        )
    body = " UNION ALL ".join([prof("orders_src"), prof("lineitem_src"), prof("region", False, False, False)])
    return _with_sources(body, "orders_src", "lineitem_src")


def _write_event_log(spark, sf) -> str:
    """Job-log text rendered from ``events`` (an error event also leaves a
    traceback line without a time), written as text files; returns the folder."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    level = F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))
    message = F.concat(
        F.lit("user "), F.col("user_id").cast("string"), F.lit(" "), F.col("event_type"),
        F.lit(" "), F.coalesce(F.col("props"), F.lit("")),
    )
    line = log_line_text(F.col("ts"), level, F.lit("mirrorkit.events"), message)
    trace = F.concat(F.lit("Traceback (most recent call last): event "), F.col("event_id").cast("string"))
    lines = F.when(F.col("event_type") == "error", F.array(line, trace)).otherwise(F.array(line))
    path = work_dir(spark, "logs")
    events.select(F.explode(lines).alias("value")).write.mode("overwrite").text(path)
    return path


def _log_events(spark, sf):
    return read_log_events(spark, _write_event_log(spark, sf)).select("ts_ms", "message")


def _log_event_order(spark, sf):
    """Position of each event in the sorted log (equal times keep file order)."""
    return numbered_log_events(spark, _write_event_log(spark, sf)).select("position", "ts_ms", "message")


def _log_event_order_sql() -> str:
    return (
        "SELECT row_number() OVER (ORDER BY ts_ms NULLS LAST, event_id) - 1 AS position, ts_ms, message FROM ("
        "SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, "
        "trim((CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END) || ' mirrorkit.events: user ' "
        "|| CAST(user_id AS VARCHAR) || ' ' || event_type || ' ' || coalesce(props, '')) AS message FROM events "
        "UNION ALL SELECT event_id, NULL, 'Traceback (most recent call last): event ' || CAST(event_id AS VARCHAR) "
        "FROM events WHERE event_type = 'error') t"
    )


def _log_events_stream(spark, sf):
    """The same log folder shipped by the streaming shipper into a Parquet sink."""
    logs = _write_event_log(spark, sf)
    sink = work_dir(spark, "log-sink")
    ship_log_events(spark, logs, sink, checkpoint_dir=work_dir(spark, "log-sink-checkpoint"))
    return spark.read.parquet(sink).select("ts_ms", "message")


def _log_events_sql() -> str:
    return (
        "SELECT epoch_us(ts) // 1000 AS ts_ms, "
        "trim((CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END) || ' mirrorkit.events: user ' "
        "|| CAST(user_id AS VARCHAR) || ' ' || event_type || ' ' || coalesce(props, '')) AS message "
        "FROM events UNION ALL "
        "SELECT CAST(NULL AS BIGINT) AS ts_ms, "
        "'Traceback (most recent call last): event ' || CAST(event_id AS VARCHAR) AS message "
        "FROM events WHERE event_type = 'error'"
    )


def _lineitem_mirror(spark, sf, staged=False):
    """Bench headline: whole ``lineitem`` mirrored (year + status partitions),
    in one pass or staged then compacted."""
    job = MirrorJob("lineitem", "lineitem_src", (1800, YEAR_NOW), ("Y", "N"), None,
                    tuple(GLOBAL_SCHEMA_OVERRIDES.items()))
    root = work_dir(spark, "mirror")
    staging_root = work_dir(spark, "staging") if staged else None
    result = run_job(spark, job, table_source(spark, sf), root, staging_root=staging_root)
    if result.status != "ok":
        raise RuntimeError(result.error)
    return read_mirror(spark, f"{root}/{job.mirror_name}", job.partitions).drop("loaded_at")


def _lineitem_mirror_sql() -> str:
    return _with_sources(
        NORMALIZED_SQL["lineitem_src"] + f" WHERE TAXYR BETWEEN 1800 AND {YEAR_NOW} AND CUR IN ('Y', 'N')",
        "lineitem_src")


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "filter_year": (_filtered((1996, 1998), None), _filtered_sql("TAXYR BETWEEN 1996 AND 1998")),
    "filter_cur": (_filtered(None, ("Y", "D")), _filtered_sql("CUR IN ('Y', 'D')")),
    "filter_year_cur": (
        _filtered((1996, 1998), ("Y", "D")),
        _filtered_sql("TAXYR BETWEEN 1996 AND 1998 AND CUR IN ('Y', 'D')"),
    ),
    "filter_none": (_filtered(None, None), _filtered_sql(None)),
    "filter_default": (
        _default_filter,
        _filtered_sql(f"TAXYR BETWEEN 1800 AND {YEAR_NOW} AND CUR IN {CUR_SQL}"),
    ),
    "timestamp_to_string": (
        _timestamp_to_string,
        "SELECT event_id, " + SQL_TS_TEXT.format(c="ts") + " AS ts, user_id, event_type, value, props "
        "FROM events",
    ),
    "decimal_narrow": (
        _decimal_narrow,
        _with_sources("SELECT PARID AS parid, " + SQL_NARROW.format(c="AMOUNT") + " AS amount FROM orders_src",
                      "orders_src"),
    ),
    "schema_override": (
        _schema_override,
        _with_sources(
            "SELECT PARID AS parid, CAST(TAXYR AS INTEGER) AS taxyr, CUR AS cur, "
            "CAST(AMOUNT AS DECIMAL(18,2)) AS amount, CAST(WHEN_TS AS VARCHAR) AS when_ts, "
            "CUSTKEY AS custkey, ORDERPRIORITY AS orderpriority FROM orders_src",
            "orders_src",
        ),
    ),
    "normalize": (_normalized_orders, _filtered_sql(None)),
    "normalize_lineitem": (_normalize_source("lineitem_src"),
                           _with_sources(NORMALIZED_SQL["lineitem_src"], "lineitem_src")),
    "normalize_customer": (_normalize_source("customer_src"),
                           _with_sources(NORMALIZED_SQL["customer_src"], "customer_src")),
    "chunked_scan": (_chunked_scan, _chunked_scan_sql()),
    "chunk_coverage": (lambda s, sf: ch.chunk_coverage(_orders(s, sf), INCLUSIVE_CHUNKS),
                       _coverage_sql(INCLUSIVE_CHUNKS)),
    "chunk_counts": (lambda s, sf: ch.chunk_counts(_orders(s, sf), INCLUSIVE_CHUNKS), _chunk_counts_sql()),
    "chunk_bounds": (_chunk_bounds, _chunk_bounds_sql()),
    "chunk_coverage_many": (_coverage_of("PARID", 2000),
                            _with_sources("SELECT 1 AS hits, count(*) AS n FROM orders_src", "orders_src")),
    "chunk_coverage_time": (_coverage_of("WHEN_TS", 12),
                            _with_sources("SELECT 1 AS hits, count(*) AS n FROM orders_src", "orders_src")),
    "chunk_coverage_derived": (
        _chunk_coverage_derived,
        _with_sources("SELECT 1 AS hits, count(*) AS n FROM orders_src", "orders_src"),
    ),
    "chunk_coverage_hot": (
        _chunk_coverage_hot,
        _with_sources("SELECT 1 AS hits, count(*) AS n FROM lineitem_src", "lineitem_src"),
    ),
    "chunk_counts_hot": (_chunk_counts_hot, _chunk_counts_hot_sql()),
    "mirror_roundtrip": (
        _mirror_roundtrip,
        _filtered_sql(f"TAXYR BETWEEN 1996 AND 2000 AND CUR IN {CUR_SQL}"),
    ),
    "staged_mirror": (
        _staged_mirror,
        _filtered_sql(f"TAXYR BETWEEN 1996 AND 2000 AND CUR IN {CUR_SQL}"),
    ),
    "partition_replace": (_partition_replace, _partition_replace_sql()),
    "mirror_pruned_read": (_mirror_pruned_read, _filtered_sql("TAXYR = 1997 AND CUR = 'N'")),
    "mirror_partition_counts": (
        _mirror_partition_counts,
        _with_sources(
            "SELECT TAXYR AS taxyr, CUR AS cur, count(*) AS n FROM orders_src "
            f"WHERE TAXYR BETWEEN 1800 AND {YEAR_NOW} AND CUR IN {CUR_SQL} GROUP BY TAXYR, CUR",
            "orders_src",
        ),
    ),
    "compacted_file_counts": (_compacted_file_counts, _compacted_file_counts_sql()),
    "catalog_mirror": (
        _catalog_mirror,
        _with_sources(
            "SELECT TAXYR AS taxyr, CUR AS cur, count(*) AS n FROM orders_src "
            f"WHERE TAXYR BETWEEN 1996 AND 1998 AND CUR IN {CUR_SQL} GROUP BY TAXYR, CUR",
            "orders_src",
        ),
    ),
    "catalog_mirror_retry": (
        _catalog_mirror_retry,
        _with_sources(
            "SELECT TAXYR AS taxyr, CUR AS cur, count(*) AS n FROM lineitem_src "
            "WHERE TAXYR BETWEEN 1996 AND 1997 AND CUR IN ('Y', 'N') GROUP BY TAXYR, CUR", "lineitem_src"),
    ),
    "default_predicates_mirror": (
        _default_predicates_mirror, _filtered_sql(f"TAXYR BETWEEN 1800 AND {YEAR_NOW} AND CUR IN {CUR_SQL}")),
    "documents_mirror": (_pass_through("documents"), "SELECT * FROM documents"),
    "embeddings_mirror": (
        _embeddings_mirror,
        "SELECT vec_id, label, CAST(place - 1 AS INTEGER) AS place, embedding[place] AS component FROM ("
        "SELECT vec_id, label, embedding, unnest(generate_series(1, len(embedding))) AS place FROM embeddings) t"),
    "null_partition_roundtrip": (_null_partition_roundtrip, _filtered_sql(None)),
    "row_cap_files": (
        _row_cap_files,
        f"SELECT (count(*) + {ROW_CAP} - 1) // {ROW_CAP} AS files, least(count(*), {ROW_CAP}) AS most, count(*) AS n "
        "FROM orders"),
    "unpartitioned_files": (_unpartitioned_files, "SELECT CAST(1 AS BIGINT) AS files, count(*) AS n FROM lineitem"),
    "old_dates": (
        _old_dates,
        "SELECT o_orderkey AS parid, strftime(CAST(o_orderdate AS DATE) - INTERVAL 300 YEAR, '%Y-%m-%d') AS old_date "
        "FROM orders"),
    "override_precedence": (
        _override_precedence,
        _with_sources("SELECT PARID AS parid, CAST(AMOUNT AS DECIMAL(18,2)) AS amount FROM orders_src", "orders_src")),
    "unpartitioned_replace": (_unpartitioned_replace, _filtered_sql("TAXYR >= 1998")),
    "touched_partitions": (_touched_partitions, _reconcile_sql("touched")),
    "new_partitions": (_new_partitions, _reconcile_sql("new")),
    "stale_partitions": (_stale_partitions, _reconcile_sql("stale")),
    "stale_files": (_stale_files, _stale_files_sql()),
    "new_partitions_spelled": (_new_partitions_spelled, _reconcile_sql("new")),
    "new_partitions_all": (_new_partitions_all, _new_partitions_all_sql()),
    "orphan_partitions": (_orphan_partitions, _orphan_partitions_sql()),
    "partition_status": (_partition_status, _partition_status_sql()),
    "partition_replace_versioned": (_partition_replace_versioned, _partition_replace_sql()),
    "partition_replace_logged": (_partition_replace_logged, _partition_replace_sql()),
    "mirror_as_of": (_mirror_as_of, _filtered_sql(f"TAXYR BETWEEN 1995 AND 2001 AND CUR IN {CUR_SQL}")),
    "new_partitions_versioned": (_new_partitions_versioned, _reconcile_sql("new")),
    "stale_files_versioned": (_stale_files_versioned, _stale_files_sql()),
    "logged_rows": (_logged_rows, _logged_rows_sql()),
    "schema_evolution": (_schema_evolution, _schema_evolution_sql()),
    "schema_evolution_logged": (_schema_evolution_logged, _schema_evolution_sql()),
    "schema_evolution_in_place": (_schema_evolution_in_place, _schema_evolution_sql()),
    "mirror_point_read": (
        _mirror_point_read,
        _with_sources(NORMALIZED_SQL["lineitem_src"] + f" WHERE PARID IN ({', '.join(repr(k) for k in POINT_KEYS)})", "lineitem_src")),
    "touched_rows": (_touched_rows, _filtered_sql(
        f"TAXYR BETWEEN {RUN_YEARS['orders_src'][0]} AND {RUN_YEARS['orders_src'][1]} AND CUR IN {CUR_SQL}")),
    **{f"derived_overrides_{t[:-4]}": (_derived_overrides(t), _profile_sql(t, columns)) for t, columns in PROFILED.items()},
    **{f"derived_overrides_applied_{t[:-4]}": (_derived_overrides_applied(t), _profile_sql(t, columns, lost=True))
       for t, columns in PROFILED.items()},
    "unchunked_scan": (_unchunked_scan, _filtered_sql(None)),
    "chunk_and_filter": (_chunk_and_filter, _filtered_sql(
        f"TAXYR BETWEEN 1996 AND 1998 AND CUR IN ('Y', 'D') AND ({' OR '.join(f'({p})' for p in INCLUSIVE_CHUNKS)})")),
    "published_mirror": (_published_mirror, _filtered_sql(f"TAXYR BETWEEN 1996 AND 1998 AND CUR IN {CUR_SQL}")),
    "remote_listing": (_remote_listing, _compacted_file_counts_sql().replace("BETWEEN 1995 AND 2001", "BETWEEN 1996 AND 1998")),
    "load_stamps": (_load_stamps, _with_sources(
        "SELECT count(*) AS n, CAST(1 AS BIGINT) AS stamps, true AS well_formed FROM orders_src "
        f"WHERE TAXYR BETWEEN 1996 AND 1998 AND CUR IN {CUR_SQL}", "orders_src")),
    "file_codecs": (_file_codecs, "SELECT 'staged' AS step, 'snappy' AS codec, count(*) AS n FROM lineitem "
                                  "UNION ALL SELECT 'final', 'zstd', count(*) FROM lineitem"),
    "batch_descriptions": (_batch_descriptions, _batch_descriptions_sql()),
    "batch_deadline": (_batch_deadline, _batch_deadline_sql()),
    "manifest_counts": (_manifest_counts, _manifest_counts_sql()),
    "batch_summary": (_batch_summary, _batch_summary_sql()),
    "definition_check": (_definition_check, _definition_check_sql()),
    "log_events": (_log_events, _log_events_sql()),
    "log_event_order": (_log_event_order, _log_event_order_sql()),
    "log_events_stream": (_log_events_stream, _log_events_sql()),
    "lineitem_mirror": (_lineitem_mirror, _lineitem_mirror_sql()),
    "lineitem_staged_mirror": (lambda s, sf: _lineitem_mirror(s, sf, staged=True), _lineitem_mirror_sql()),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mirror_partition_counts(spark, sf_dir)
