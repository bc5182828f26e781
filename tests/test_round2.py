"""Cases from review: time zones, path spellings, chunk literals, growing logs, optional parts."""

import datetime as dt
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mirrorkit.operators import chunks as ch
from mirrorkit.operators.reconcile import new_partitions, stale_files, touched_partitions
from mirrorkit.plans.job import job_from_spec, load_batch_specs
from mirrorkit.sinks.catalog import missing_partitions, sync_mirror_table
from mirrorkit.sinks.parquet import write_mirror
from mirrorkit.sources.listing import file_manifest, list_files
from mirrorkit.sources.logs import read_log_events
from mirrorkit.streaming.logs import LogFileGrown, ship_log_events
from tests.conftest import rows_of

REPO = Path(__file__).resolve().parents[1]

ZONED = """
import sys
sys.path.insert(0, {repo!r})
from pathlib import Path
from mirrorkit.session import build_session
from mirrorkit.operators.normalize import normalize
from mirrorkit.sources.jdbc import read_jdbc
from mirrorkit.sources.logs import read_log_events
spark = build_session("local[1]", conf={{"spark.sql.shuffle.partitions": "1"}})
url = "jdbc:derby:memory:zone;create=true"
jvm = spark.sparkContext._jvm
jvm.java.lang.Class.forName("org.apache.derby.iapi.jdbc.AutoloadedDriver")
c = jvm.java.sql.DriverManager.getConnection(url)
st = c.createStatement()
st.execute("CREATE TABLE T (TS TIMESTAMP)")
st.execute("INSERT INTO T VALUES ('2020-01-02 03:04:05.678')")
c.close()
print("ROW", normalize(read_jdbc(spark, url, "T"), stamp=False).first()[0])
Path({log!r}).write_text("2026-01-02_03:04:05.678 INFO a: b\\n")
print("LOG", read_log_events(spark, {log!r}, zone="UTC").first()["ts_ms"])
"""


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago"])
def test_wall_clock_whatever_the_host_zone(zone, tmp_dir):
    code = ZONED.format(repo=str(REPO), log=f"{tmp_dir}/a.log")
    out = subprocess.run([sys.executable, "-c", code], env={**os.environ, "TZ": zone}, cwd=tmp_dir,
                         capture_output=True, text=True, timeout=300)
    if "ClassNotFoundException" in out.stderr:
        pytest.skip("no embedded database on the class path")
    assert "ROW 2020-01-02 03:04:05.678" in out.stdout, out.stderr[-2000:]
    assert "LOG 1767323045678" in out.stdout


def test_log_zone_white_space_and_fractions(spark, tmp_dir):
    path = Path(tmp_dir) / "a.log"
    path.write_text("2026-01-02_03:04:05.678901 INFO a: six\t\n\t\n2026-01-02_03:04:05.6 x\n2026-13-02_03:04:05.6 bad\n  \u3000\n")
    got = [(r["ts_ms"], r["message"]) for r in read_log_events(spark, str(path)).collect()]
    assert got[:2] == [(1767323045600, "x"), (1767323045678, "INFO a: six")]
    assert got[2] == (None, "2026-13-02_03:04:05.6 bad")
    chicago = [r["ts_ms"] for r in read_log_events(spark, str(path), zone="America/Chicago").collect()]
    assert chicago[0] == 1767323045600 + 6 * 3600 * 1000


def test_growing_log_is_refused(spark, tmp_dir):
    logs = Path(tmp_dir) / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("2026-01-02_03:04:05.678 INFO a: one\n")
    assert ship_log_events(spark, str(logs), f"{tmp_dir}/sink") == 1
    assert ship_log_events(spark, str(logs), f"{tmp_dir}/sink") == 0
    with (logs / "a.log").open("a") as f:
        f.write("2026-01-02_03:04:06.000 INFO a: two\n")
    with pytest.raises(LogFileGrown, match="a.log"):
        ship_log_events(spark, str(logs), f"{tmp_dir}/sink")


def test_listing_of_any_spelling(spark, tmp_dir, monkeypatch):
    spark.range(3).withColumn("p", F.col("id")).write.partitionBy("p").parquet(f"{tmp_dir}/m")
    plain = rows_of(list_files(spark, f"{tmp_dir}/m"), "rel_path", "partition_dir")
    assert len(plain) == 3 and all(d for _, d in plain)
    for spelling in (f"{tmp_dir}//m/", f"{tmp_dir}/x/../m", f"file:{tmp_dir}/./m", f"file://{tmp_dir}/m"):
        assert rows_of(list_files(spark, spelling), "rel_path", "partition_dir") == plain
    assert list_files(spark, f"{tmp_dir}/never").count() == 0
    assert list_files(spark, f"{tmp_dir}/m", within="p=77").count() == 0


def test_bounds_of_every_type(spark):
    when = dt.datetime(2020, 4, 10, 1, 2, 3, 456000)
    rows = [(i, dt.date(2020, 1, 1) + dt.timedelta(days=i), when + dt.timedelta(hours=i), f"k{i}\\", i % 2 == 0,
             float(i) / 3, bytes([i])) for i in range(40)]
    df = spark.createDataFrame(rows, "n int, d date, t timestamp_ntz, s string, `odd name` boolean, f double, b binary")
    for column in df.columns:
        chunks = ch.derived_chunks(df, column, 5)
        assert [tuple(r) for r in ch.chunk_coverage(df, chunks).collect()] == [(1, 40)]
        by_test = rows_of(ch.chunked_scan(df, list(chunks), "chunk").groupBy("chunk").count(), "chunk", "count")
        assert rows_of(ch.chunk_counts(df, chunks), "chunk", "n") == by_test  # binary search agrees
    assert ch.sql_literal("a\\b", "ansi") == "'a\\b'" and ch.sql_literal("a\\b") == "'a\\\\b'"


def test_scan_of_a_covering_list_tests_nothing(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    plan = ch.chunked_scan(df, ch.derived_chunks(df, "k", 10))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Filter" not in plan
    listed = ch.inclusive_range_chunks("s", 10, 98)
    text = df.select(F.lpad(F.col("k").cast("string"), 14, "0").alias("s"))
    plan = ch.chunked_scan(text, listed)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    assert rows_of(ch.chunk_counts(text, listed), "chunk", "n") == rows_of(ch.chunk_counts(text, list(listed)), "chunk", "n")


def test_hot_keys_split_exactly(spark):
    rows = [("hot", i) for i in range(50)] + [(None, i) for i in range(30)] + [(f"c{i:02}", i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, s int")
    chunks = ch.derived_chunks(df, "k", 10, split_column="s")
    assert [tuple(r) for r in ch.chunk_coverage(df, chunks).collect()] == [(1, 100)]
    assert all(r["n"] <= 10 for r in ch.chunk_counts(df, chunks).collect())
    assert sum("<> 'hot'" in c for c in chunks) == 1  # only the range it lies in


def test_short_spec_and_missing_files():
    assert job_from_spec("a", {"table_name": "t"}).predicates is None
    with pytest.raises(FileNotFoundError):
        load_batch_specs("/nowhere/jobs.yaml")
    assert load_batch_specs('{"a": {"table_name": "' + "t" * 5000 + '"}}')


def test_manifests_of_several_tables_stay_apart(spark):
    schema = "table_name string, rel_path string, partition_dir string"
    before = spark.createDataFrame([("a", "p=1/x", "p=1"), ("b", "p=1/x", "p=1")], schema)
    after = spark.createDataFrame([("a", "p=1/y", "p=1"), ("b", "p=1/x", "p=1"), ("b", "p=2/y", "p=2")], schema)
    assert rows_of(touched_partitions(after, before), "table_name", "partition_dir") == [("a", "p=1"), ("b", "p=2")]
    assert rows_of(stale_files(after, before), "table_name", "rel_path") == [("a", "p=1/x")]
    assert rows_of(new_partitions(after, before), "table_name", "partition_dir") == [("b", "p=2")]


def test_catalog_is_asked_what_it_lacks(spark, tmp_dir):
    name = "default.lacking"
    df = spark.createDataFrame([(1, 2000, "it's"), (2, 2001, None)], "v int, taxyr int, cur string")
    write_mirror(df.where("taxyr = 2000"), f"{tmp_dir}/m", ("taxyr", "cur"))
    assert sync_mirror_table(spark, name, f"{tmp_dir}/m", df.schema, ("taxyr", "cur")) == "created"
    write_mirror(df.where("taxyr = 2001"), f"{tmp_dir}/m", ("taxyr", "cur"))  # no refresh followed
    assert len(missing_partitions(spark, name, f"{tmp_dir}/m", ("taxyr", "cur"))) == 1
    assert sync_mirror_table(spark, name, f"{tmp_dir}/m", df.schema, ("taxyr", "cur")) == "refreshed"
    assert sync_mirror_table(spark, name, f"{tmp_dir}/m", df.schema, ("taxyr", "cur")) == "unchanged"
    assert rows_of(spark.table(name), "v", "taxyr", "cur") == [(1, 2000, "it's"), (2, 2001, None)]
    assert file_manifest(spark, f"{tmp_dir}/m", ("taxyr", "cur")).count() == 2


def test_entry_works_without_the_optional_parts(tmp_dir):
    copy = Path(tmp_dir) / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    out = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q[:2] == 'op'])"],
        cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[0] > "0" and out.stdout.strip().endswith("[]")
