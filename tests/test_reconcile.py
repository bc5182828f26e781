from mirrorkit.operators.reconcile import new_partitions, stale_files, touched_partitions
from mirrorkit.sinks.parquet import write_mirror
from mirrorkit.sources.listing import file_manifest
from tests.conftest import rows_of


def test_before_after_reports(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    first = spark.createDataFrame([(i, 2000 + i % 3, "Y") for i in range(30)], "id int, taxyr int, cur string")
    write_mirror(first, dest, ["taxyr", "cur"])
    before = file_manifest(spark, dest, ["taxyr", "cur"]).checkpoint(eager=True)
    second = spark.createDataFrame([(1, 2002, "Y"), (2, 2003, "Y"), (3, 2003, "YY")], "id int, taxyr int, cur string")
    write_mirror(second, dest, ["taxyr", "cur"])
    after = file_manifest(spark, dest, ["taxyr", "cur"])
    parts = ["taxyr", "cur"]
    assert rows_of(touched_partitions(after, before, parts), "taxyr", "cur") == [
        ("2002", "Y"), ("2003", "Y"), ("2003", "YY")]
    assert rows_of(new_partitions(after, before, parts), "taxyr", "cur") == [("2003", "Y"), ("2003", "YY")]
    stale = stale_files(after, before).collect()
    assert [r["partition_dir"] for r in stale] == ["taxyr=2002/cur=Y"]
    # untouched partitions keep their files and are not reported
    assert after.where("taxyr = '2000'").count() == 1


def test_report_counts_match_the_detailed_reports(spark, tmp_dir):
    from pyspark.sql import functions as F
    from mirrorkit.operators.reconcile import orphan_partitions, report_counts
    dest = f"{tmp_dir}/m"
    parts = ["taxyr", "cur"]
    rows = [(i, 2000 + i % 4, "YN"[(i // 4) % 2]) for i in range(40)]
    write_mirror(spark.createDataFrame(rows, "id int, taxyr int, cur string"), dest, parts)
    before = file_manifest(spark, dest, parts).checkpoint(eager=True)
    # Re-run 2000-2002 where 2001/Y vanished, plus a new year.
    rerun = [r for r in rows if r[1] <= 2002 and not (r[1] == 2001 and r[2] == "Y")] + [(99, 2004, "Y")]
    write_mirror(spark.createDataFrame(rerun, "id int, taxyr int, cur string"), dest, parts)
    after = file_manifest(spark, dest, parts)
    scope = F.col("taxyr").cast("int").between(2000, 2004)
    counts = report_counts(after, before, parts, scope)
    assert counts == {
        "new_partitions": new_partitions(after, before, parts).count(),
        "stale_files": stale_files(after, before).count(),
        "orphan_partitions": orphan_partitions(after, before, parts, scope).count(),
    }
    assert counts["new_partitions"] == 1 and counts["stale_files"] == 5
    # 2001/Y (vanished) and 2003/* (outside the re-run but inside the scope) are orphans.
    assert counts["orphan_partitions"] == 3
