import pytest

from mirrorkit.functions.fixed import GLOBAL_SCHEMA_OVERRIDES
from mirrorkit.plans.batch import BatchFailed, run_batch
from mirrorkit.plans.job import MirrorJob
from mirrorkit.registry import table_source
from mirrorkit.sources.files import read_mirror
from tests.conftest import SF_SMALL

OV = tuple(GLOBAL_SCHEMA_OVERRIDES.items())


def shapes():
    return [
        MirrorJob("region", "region", None, None, None, OV),
        MirrorJob("orders", "orders_src", (1996, 2000), ("Y", "N", "D"), ("PARID < '00000000000700'",
                  "PARID >= '00000000000700'", "PARID IS NULL"), OV),
        MirrorJob("lineitem", "lineitem_src", (1995, 1997), None, None, OV),
        MirrorJob("events", "events_src", None, ("Y",), None, OV),
        MirrorJob("nation", "db.nation", None, None, None, OV),  # prefix stripped to find the source
        MirrorJob("nowhere", "db.nowhere", None, None, None, OV),  # unknown source: fails
    ]


def test_batch_shapes_and_failure_report(spark, tmp_dir):
    with pytest.raises(BatchFailed) as caught:
        run_batch(spark, shapes(), table_source(spark, SF_SMALL), tmp_dir, parallelism=4)
    summary = {r["job"]: r for r in caught.value.summary.collect()}
    assert summary["nowhere"]["status"] == "failed" and "no source" in summary["nowhere"]["error"]
    assert summary["nation"]["status"] == "ok" and summary["nation"]["rows"] == 25
    assert summary["region"]["rows"] == 5 and summary["region"]["partitions"] == ""
    assert summary["orders"]["partitions"] == "taxyr,cur"
    assert summary["lineitem"]["partitions"] == "taxyr"
    assert summary["events"]["partitions"] == "cur" and summary["events"]["new_partitions"] == 1
    assert summary["orders"]["overflow_rows"] > 0
    orders = read_mirror(spark, f"{tmp_dir}/orders_src", ("taxyr", "cur"))
    assert orders.count() == summary["orders"]["rows"]
    assert (summary["orders"]["min_year"], summary["orders"]["max_year"]) == (1996, 2000)
    assert summary["region"]["min_year"] is None


def test_rerun_reports_stale_files_and_catalog(spark, tmp_dir):
    jobs = [MirrorJob("orders", "orders_src", (1996, 1997), ("Y",), None, OV)]
    src = table_source(spark, SF_SMALL)
    first = {r["job"]: r for r in run_batch(spark, jobs, src, tmp_dir, catalog_database="default").collect()}
    assert first["orders"]["new_partitions"] == 2 and first["orders"]["stale_files"] == 0
    assert first["orders"]["catalog"] == "created"
    assert spark.table("default.orders_src").count() == first["orders"]["rows"]
    jobs2 = [MirrorJob("orders", "orders_src", (1997, 1998), ("Y",), None, OV)]
    second = {r["job"]: r for r in run_batch(spark, jobs2, src, tmp_dir, catalog_database="default").collect()}
    assert second["orders"]["new_partitions"] == 1 and second["orders"]["stale_files"] == 1
    assert second["orders"]["orphan_partitions"] == 0 and second["orders"]["write_seconds"] > 0
    assert second["orders"]["catalog"] == "refreshed"
    visible = spark.table("default.orders_src").select("taxyr").distinct().count()
    assert visible == 3
    # A type change in the mirror re-creates the (external) table definition.
    from mirrorkit.sinks.catalog import sync_mirror_table
    t = spark.table("default.orders_src")
    changed = t.withColumn("amount", t["amount"].cast("decimal(18,2)")).schema
    assert sync_mirror_table(spark, "default.orders_src", f"{tmp_dir}/orders_src", changed,
                             ("taxyr", "cur")) == "replaced"
    assert dict((f.name, f.dataType.simpleString()) for f in spark.table("default.orders_src").schema.fields)[
        "amount"] == "decimal(18,2)"
    spark.sql("DROP TABLE default.orders_src")


def test_failed_job_is_retried(spark, tmp_dir):
    from mirrorkit.plans.batch import TableSource, run_job
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) == 1:
            raise ConnectionError("source went away")
        return spark.read.parquet(f"{SF_SMALL}/region.parquet")

    job = MirrorJob("region", "region", None, None, None, OV)
    result = run_job(spark, job, TableSource({"region": flaky}), tmp_dir, retries=2)
    assert result.status == "ok" and result.attempts == 2 and result.rows == 5
    failed = run_job(spark, job, TableSource({"region": lambda: 1 / 0}), tmp_dir, retries=1)
    assert failed.status == "failed" and failed.attempts == 2


def test_staged_run_drops_its_staging_copy(spark, tmp_dir):
    from pathlib import Path
    from mirrorkit.plans.batch import run_job
    job = MirrorJob("orders", "orders_src", (1996, 1997), ("Y", "N"), None, OV)
    staging = f"{tmp_dir}/staging"
    result = run_job(spark, job, table_source(spark, SF_SMALL), f"{tmp_dir}/dest", staging_root=staging)
    assert result.status == "ok", result.error
    assert not Path(staging, "orders_src").exists()
    assert read_mirror(spark, f"{tmp_dir}/dest/orders_src", job.partitions).count() == result.rows


def test_publish_to_scheme_qualified_uri(spark, tmp_dir):
    from mirrorkit.plans.batch import run_job
    from mirrorkit.sources.listing import file_manifest
    root = "file://" + tmp_dir
    job = MirrorJob("orders", "orders_src", (1996, 1997), ("Y",), None, OV)
    result = run_job(spark, job, table_source(spark, SF_SMALL), root)
    assert result.status == "ok", result.error
    assert result.new_partitions == 2
    man = file_manifest(spark, f"{root}/orders_src", job.partitions)
    assert sorted(r["partition_dir"] for r in man.collect()) == ["taxyr=1996/cur=Y", "taxyr=1997/cur=Y"]
    again = run_job(spark, job, table_source(spark, SF_SMALL), root)
    assert again.stale_files == 2 and again.new_partitions == 0


def test_listing_is_limited_to_the_job_scope(spark, tmp_dir):
    from mirrorkit.plans.batch import run_job
    from mirrorkit.sources.listing import file_manifest
    src = table_source(spark, SF_SMALL)
    wide = MirrorJob("orders", "orders_src", (1995, 2000), ("Y", "N"), None, OV)
    assert run_job(spark, wide, src, tmp_dir).status == "ok"
    narrow = MirrorJob("orders", "orders_src", (1997, 1998), ("N",), None, OV)
    assert narrow.scope_glob == "taxyr={1997,1998}/cur={N}"
    listed = file_manifest(spark, f"{tmp_dir}/orders_src", narrow.partitions, within=narrow.scope_glob)
    assert sorted(r["partition_dir"] for r in listed.collect()) == ["taxyr=1997/cur=N", "taxyr=1998/cur=N"]
    result = run_job(spark, narrow, src, tmp_dir)
    assert (result.new_partitions, result.stale_files, result.orphan_partitions) == (0, 2, 0)
    outside = MirrorJob("orders", "orders_src", (2010, 2011), ("N",), None, OV)
    assert file_manifest(spark, f"{tmp_dir}/orders_src", outside.partitions, within=outside.scope_glob).count() == 0
    assert MirrorJob("x", "t", None, ("A-B",)).scope_glob is None and MirrorJob("x", "t").scope_glob is None


def test_chunk_semantics_can_be_switched_off(spark):
    from mirrorkit.plans.batch import TableSource, extract_plan
    overlapping = ("PARID < '00000000000800'", "PARID >= '00000000000700'", "PARID IS NULL")
    job = MirrorJob("o", "orders_src", None, None, overlapping, OV)
    src = table_source(spark, SF_SMALL).tables
    faithful = extract_plan(job, TableSource(src)).count()
    plain = extract_plan(job, TableSource(src, chunk_semantics=False)).count()
    assert plain == 1500 and faithful > plain  # keys 700-799 come twice


def test_catalog_follows_a_moved_mirror(spark, tmp_dir):
    from mirrorkit.plans.batch import run_job
    job = MirrorJob("orders", "orders_src", (1996, 1996), ("Y",), None, OV)
    src = table_source(spark, SF_SMALL)
    first = run_job(spark, job, src, f"{tmp_dir}/a", catalog_database="default")
    assert first.catalog == "created"
    moved = MirrorJob("orders", "orders_src", (1997, 1997), ("Y",), None, OV)
    second = run_job(spark, moved, src, f"{tmp_dir}/b", catalog_database="default")
    assert second.catalog == "replaced"
    years = {r["taxyr"] for r in spark.table("default.orders_src").select("taxyr").distinct().collect()}
    assert years == {1997}
    spark.sql("DROP TABLE default.orders_src")
