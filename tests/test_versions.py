"""Versioned mirrors: switching, the manifest log, failures in between, changed types."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType,
    StructField, StructType, TimestampNTZType,
)

from mirrorkit.functions.types import least_common_type, merged_schema
from mirrorkit.plans import batch
from mirrorkit.plans.batch import TableSource, run_job
from mirrorkit.plans.job import MirrorJob
from mirrorkit.sinks import catalog, manifest_log, versions
from mirrorkit.sinks.parquet import write_mirror
from tests.conftest import rows_of

PARTS = ("taxyr", "cur")


def source_of(spark, rows, ddl="v int, taxyr int, cur string"):
    return TableSource({"t": lambda: spark.createDataFrame(rows, ddl)})


def job(years=(2000, 2003), cur=("Y", "it's a+b/c")):
    return MirrorJob("t", "t", years, cur, None, ())


FIRST = [(1, 2000, "Y"), (2, 2001, "Y"), (3, 2001, "it's a+b/c")]
SECOND = [(20, 2001, "Y"), (40, 2002, "Y")]


@pytest.fixture()
def database(spark, tmp_dir):
    name = "d" + Path(tmp_dir).name.rsplit("-", 1)[-1].replace("_", "x").lower()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_dir}/db'")
    return name


def run(spark, rows, root, database=None, **options):
    return run_job(spark, job(), source_of(spark, rows, **options), root, catalog_database=database, versioned=True)


def by_name(spark, database):
    return rows_of(spark.table(f"{database}.t"), "v", "taxyr", "cur")


def by_path(spark, root, **options):
    return rows_of(versions.read_versioned(spark, f"{root}/t", **options), "v", "taxyr", "cur")


def test_switch_reports_and_time_travel(spark, tmp_dir, database):
    first = run(spark, FIRST, tmp_dir, database)
    assert (first.status, first.catalog, first.new_partitions, first.stale_files) == ("ok", "created", 3, 0), first.error
    second = run(spark, SECOND, tmp_dir, database)
    assert (second.status, second.catalog, second.new_partitions, second.stale_files) == ("ok", "refreshed", 1, 1), second.error
    assert second.orphan_partitions == 2  # in scope, not written: 2000/Y and 2001/it's a+b/c
    now = sorted([FIRST[0], FIRST[2], *SECOND], key=repr)
    assert by_name(spark, database) == by_path(spark, tmp_dir) == now
    assert by_path(spark, tmp_dir, as_of=1) == sorted(FIRST, key=repr)
    assert by_path(spark, tmp_dir, where=F.col("taxyr") == "2001") == sorted([FIRST[2], SECOND[0]], key=repr)
    assert versions.switch_catalog(spark, f"{database}.t", f"{tmp_dir}/t") == "unchanged"


def test_reports_without_a_listing(spark, tmp_dir, monkeypatch):
    def refused(*args, **options):
        raise AssertionError("a folder was listed")

    for module in (batch, manifest_log):
        monkeypatch.setattr(module, "file_manifest" if module is batch else "list_files", refused)
    run(spark, FIRST, tmp_dir)
    assert run(spark, SECOND, tmp_dir).new_partitions == 1
    rows = rows_of(manifest_log.files_at(spark, f"{tmp_dir}/t"), "partition_dir", "rows")
    assert rows == [("taxyr=2000/cur=Y", 1), ("taxyr=2001/cur=Y", 1), ("taxyr=2001/cur=it%27s a+b%2Fc", 1), ("taxyr=2002/cur=Y", 1)]
    changes = manifest_log.changes_of(spark, f"{tmp_dir}/t", manifest_log.commits(spark, f"{tmp_dir}/t")[-1])
    assert rows_of(changes, "action", "partition_dir") == [
        ("add", "taxyr=2001/cur=Y"), ("add", "taxyr=2002/cur=Y"), ("remove", "taxyr=2001/cur=Y")]


def test_failure_between_write_and_switch_reads_the_old_rows(spark, tmp_dir, database, monkeypatch):
    run(spark, FIRST, tmp_dir, database)
    old = sorted(FIRST, key=repr)

    def fails(*args, **options):
        raise ConnectionError("gone")

    with monkeypatch.context() as m:
        m.setattr(batch, "publish_run", fails)  # written, not published
        assert run(spark, SECOND, tmp_dir, database).status == "failed"
    assert by_name(spark, database) == by_path(spark, tmp_dir) == old
    with monkeypatch.context() as m:
        m.setattr(batch, "switch_catalog", fails)  # published, catalog not switched
        assert run(spark, SECOND, tmp_dir, database).status == "failed"
    assert by_name(spark, database) == old and len(by_path(spark, tmp_dir)) == 4
    assert versions.switch_catalog(spark, f"{database}.t", f"{tmp_dir}/t") == "refreshed"
    assert by_name(spark, database) == by_path(spark, tmp_dir)
    findings = rows_of(manifest_log.audit(spark, f"{tmp_dir}/t"), "finding")
    assert findings == [("unreferenced",)] * 3  # two files of the failed run, the replaced one
    removed = versions.collect_old(spark, f"{tmp_dir}/t", keep=1, failed_after_seconds=0.0)
    assert len(removed) == 2 and manifest_log.audit(spark, f"{tmp_dir}/t").count() == 0
    assert by_name(spark, database) == by_path(spark, tmp_dir)


def test_old_versions_stay_as_long_as_asked(spark, tmp_dir):
    for n in range(4):
        run(spark, [(n, 2000, "Y")], tmp_dir)
    assert versions.collect_old(spark, f"{tmp_dir}/t", keep=4) == []
    assert len(versions.collect_old(spark, f"{tmp_dir}/t", keep=2)) == 2
    assert by_path(spark, tmp_dir, as_of=3) == [(2, 2000, "Y")] and by_path(spark, tmp_dir) == [(3, 2000, "Y")]


def test_a_taken_number_is_no_loss(spark, tmp_dir, monkeypatch):
    run(spark, FIRST, tmp_dir)
    mirror, real = f"{tmp_dir}/t", manifest_log._records
    stale = real(spark, mirror)
    run(spark, SECOND, tmp_dir)  # another run takes number 2
    calls = []

    def late(*args):
        calls.append(1)
        return stale if len(calls) == 1 else real(*args)

    monkeypatch.setattr(manifest_log, "_records", late)
    other = versions.new_run()
    frame = spark.createDataFrame([(30, 2001, "Y")], "v int, taxyr int, cur string")
    write_mirror(frame, versions.run_folder(mirror, other), PARTS)
    assert versions.publish_run(spark, mirror, other, frame.schema, PARTS).number == 3
    assert (30, 2001, "Y") in by_path(spark, tmp_dir) and (20, 2001, "Y") not in by_path(spark, tmp_dir)


def test_a_record_that_was_never_finished(spark, tmp_dir):
    run(spark, FIRST, tmp_dir)
    Path(f"{tmp_dir}/t/_log/commits/00000002.json").write_text("")  # its writer died
    assert by_path(spark, tmp_dir) == sorted(FIRST, key=repr)
    assert run(spark, SECOND, tmp_dir).status == "ok"
    assert [c.number for c in manifest_log.commits(spark, f"{tmp_dir}/t")] == [1, 3] and len(by_path(spark, tmp_dir)) == 4


def test_snapshots_hold_the_same_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(manifest_log, "SNAPSHOT_EVERY", 2)
    for n in range(5):
        run(spark, [(n, 2000 + n % 3, "Y")], tmp_dir)
    known = manifest_log.commits(spark, f"{tmp_dir}/t")
    assert [c.number for c in known if c.snapshot] == [2, 4]
    assert by_path(spark, tmp_dir) == [(2, 2002, "Y"), (3, 2000, "Y"), (4, 2001, "Y")]
    assert by_path(spark, tmp_dir, as_of=3) == [(0, 2000, "Y"), (1, 2001, "Y"), (2, 2002, "Y")]


def test_empty_extracts_and_unpartitioned(spark, tmp_dir, database):
    assert run(spark, [], tmp_dir, database).status == "ok"
    assert by_path(spark, tmp_dir) == by_name(spark, database) == []
    whole = MirrorJob("u", "u", None, None, None, ())
    for rows in ([(1,), (2,)], [(3,)], []):
        result = run_job(spark, whole, TableSource({"u": lambda rows=rows: spark.createDataFrame(rows, "v int")}), tmp_dir,
                         catalog_database=database, versioned=True)
        assert result.status == "ok", result.error
        assert rows_of(versions.read_versioned(spark, f"{tmp_dir}/u"), "v") == rows_of(spark.table(f"{database}.u"), "v") == rows


def test_a_column_that_changes_its_type(spark, tmp_dir, database):
    run(spark, FIRST, tmp_dir, database)
    text = [("x20", 2001, "Y"), ("x40", 2002, "Y")]
    assert run(spark, text, tmp_dir, database, ddl="v string, taxyr int, cur string").catalog == "replaced"
    now = [("1", 2000, "Y"), ("3", 2001, "it's a+b/c"), ("x20", 2001, "Y"), ("x40", 2002, "Y")]
    assert by_name(spark, database) == by_path(spark, tmp_dir) == now
    # Back to numbers for one partition: it moves back to the first table.
    assert run(spark, [(21, 2001, "Y")], tmp_dir, database).catalog == "refreshed"
    assert by_name(spark, database) == by_path(spark, tmp_dir) == [("1", 2000, "Y"), ("21", 2001, "Y"), *now[1:2], *now[3:]]
    assert catalog.generations(spark, f"{database}.t") == [f"{database}.t__s1", f"{database}.t__s2"]
    # A new column needs no new table.
    assert run(spark, [("x41", "n", 2002, "Y")], tmp_dir, database, ddl="v string, note string, taxyr int, cur string").status == "ok"
    assert len(catalog.generations(spark, f"{database}.t")) == 2
    assert rows_of(spark.table(f"{database}.t"), "v", "note")[-1] == ("x41", "n")


def test_a_run_that_ended_before_its_view(spark, tmp_dir, database, monkeypatch):
    run(spark, FIRST, tmp_dir, database)

    def fails(*args):
        raise ConnectionError("gone")

    with monkeypatch.context() as m:
        m.setattr(catalog, "_create_view", fails)
        assert run(spark, [("x", 2001, "Y")], tmp_dir, database, ddl="v string, taxyr int, cur string").status == "failed"
    versions.switch_catalog(spark, f"{database}.t", f"{tmp_dir}/t")
    assert by_name(spark, database) == [("1", 2000, "Y"), ("3", 2001, "it's a+b/c"), ("x", 2001, "Y")]


TYPES = [ByteType(), ShortType(), IntegerType(), LongType(), FloatType(), DoubleType(), StringType(), BooleanType(), DateType(),
         TimestampNTZType(), DecimalType(10, 0), DecimalType(18, 2), DecimalType(38, 10), DecimalType(38, 38)]


def test_least_common_type_is_a_join():
    for a in TYPES:
        assert least_common_type(a, a) == a
        for b in TYPES:
            both = least_common_type(a, b)
            assert both == least_common_type(b, a)
            assert least_common_type(both, a) == both or both == StringType()
    assert least_common_type(IntegerType(), DecimalType(10, 0)) == DecimalType(10, 0)
    assert least_common_type(DecimalType(10, 0), DecimalType(18, 10)) == DecimalType(20, 10)
    assert least_common_type(DecimalType(38, 0), DecimalType(10, 5)) == StringType()
    assert least_common_type(LongType(), DoubleType()) == StringType()
    with pytest.raises(ValueError, match="no common type"):
        least_common_type(StructType([]), StringType())
    merged = merged_schema([StructType([StructField("b", StringType())]),
                            StructType([StructField("a", IntegerType()), StructField("b", LongType())])])
    assert merged.simpleString() == "struct<b:string,a:int>"
