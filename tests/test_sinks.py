import datetime as dt
import os
from pathlib import Path

from pyspark.sql import functions as F

from mirrorkit.sinks.parquet import compact_staged, stage_extract, write_mirror
from mirrorkit.sources.files import read_mirror
from mirrorkit.sources.listing import file_manifest, list_files
from tests.conftest import rows_of


def parquet_files(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*.parquet"))


def sixty_rows(spark):
    rows = [(i, 2000 + i % 3, "AB"[i % 2]) for i in range(60)] + [(99, None, None)]
    return spark.createDataFrame(rows, "id int, taxyr int, cur string").repartition(7)


def test_compacted_one_file_per_partition(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    write_mirror(sixty_rows(spark), dest, ["taxyr", "cur"])
    files = parquet_files(dest)
    dirs = {os.path.dirname(f) for f in files}
    assert len(files) == len(dirs) == 7  # 3 years x 2 values + the null/null partition
    assert all(f.endswith(".zstd.parquet") for f in files)
    assert any("taxyr=__HIVE_DEFAULT_PARTITION__/cur=__HIVE_DEFAULT_PARTITION__" in f for f in files)
    back = read_mirror(spark, dest, ["taxyr", "cur"])
    assert back.count() == 61
    assert back.where(F.col("taxyr").isNull() & F.col("cur").isNull()).count() == 1
    assert back.schema["taxyr"].dataType.simpleString() == "int"


def test_row_cap_splits_files(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    write_mirror(sixty_rows(spark), dest, ["taxyr"], max_rows_per_file=7)
    per_dir = {}
    for f in parquet_files(dest):
        per_dir.setdefault(os.path.dirname(f), []).append(f)
    assert per_dir["taxyr=2000"] and len(per_dir["taxyr=2000"]) == 3  # 20 rows / 7
    assert read_mirror(spark, dest, ["taxyr"]).count() == 61


def test_dynamic_replace_keeps_untouched_partitions(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    write_mirror(sixty_rows(spark), dest, ["taxyr", "cur"])
    again = spark.createDataFrame([(1000, 2001, "A")], "id int, taxyr int, cur string")
    write_mirror(again, dest, ["taxyr", "cur"])
    back = read_mirror(spark, dest, ["taxyr", "cur"])
    assert back.where("taxyr = 2001 AND cur = 'A'").count() == 1
    assert back.count() == 61 - 10 + 1


def test_unpartitioned_replaces_whole_table(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    write_mirror(spark.range(50), dest)
    write_mirror(spark.range(3), dest)
    assert spark.read.parquet(dest).count() == 3
    assert len(parquet_files(dest)) == 1


def test_numeric_looking_partition_values_stay_text(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    df = spark.createDataFrame([(1, "01"), (2, "02")], "id int, cur string")
    write_mirror(df, dest, ["cur"])
    back = read_mirror(spark, dest, ["cur"])
    assert rows_of(back, "id", "cur") == [(1, "01"), (2, "02")]


def test_empty_extract_reads_back_with_schema(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    empty = spark.createDataFrame([], "id int, taxyr int, cur string")
    write_mirror(empty, dest, ["taxyr", "cur"])
    back = read_mirror(spark, dest, ["taxyr", "cur"], schema=empty.schema)
    assert back.count() == 0 and set(back.columns) == {"id", "taxyr", "cur"}
    absent = read_mirror(spark, f"{tmp_dir}/never", ["taxyr"], schema=empty.schema)
    assert absent.count() == 0


def test_two_pass_staged_then_compacted(spark, tmp_dir):
    df = sixty_rows(spark)
    df = df.repartition(3)
    stage_extract(df, f"{tmp_dir}/s")
    staged = parquet_files(f"{tmp_dir}/s")
    # One file per task, whatever the number of partitions.
    assert all(f.endswith(".snappy.parquet") for f in staged) and len(staged) == 3
    compact_staged(spark, f"{tmp_dir}/s", f"{tmp_dir}/f", df.schema, ["taxyr", "cur"])
    assert len(parquet_files(f"{tmp_dir}/f")) == 7
    assert read_mirror(spark, f"{tmp_dir}/f", ["taxyr", "cur"]).count() == 61


def test_old_dates_round_trip(spark, tmp_dir):
    old = dt.datetime(1899, 12, 31, 23, 59, 59)
    df = spark.createDataFrame([(old,)], "ts timestamp_ntz")
    write_mirror(df, f"{tmp_dir}/m")
    assert spark.read.parquet(f"{tmp_dir}/m").collect()[0]["ts"] == old


def test_listing_manifest(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    write_mirror(sixty_rows(spark), dest, ["taxyr", "cur"])
    man = file_manifest(spark, dest, ["taxyr", "cur"], table="t")
    got = rows_of(man.where("taxyr = '2000'"), "table_name", "taxyr", "cur", "partition_dir")
    assert got == [("t", "2000", "A", "taxyr=2000/cur=A"), ("t", "2000", "B", "taxyr=2000/cur=B")]
    assert man.where(F.col("taxyr").isNull()).count() == 1
    assert list_files(spark, f"{tmp_dir}/absent").count() == 0
    assert man.where(F.col("length") > 0).count() == 7


def test_hot_partition_is_split_over_writer_tasks(spark, tmp_dir):
    # One year holds most rows; with a small advisory size the exchange splits
    # it over several writer tasks (several files), small years stay one file.
    hot = spark.range(0, 200_000, 1, 16).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, F.lit(2001) + F.col("id") % 3).otherwise(2000).alias("taxyr"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        write_mirror(hot, f"{tmp_dir}/m", ["taxyr"])
    finally:
        spark.conf.set(key, old)
    per_dir = {}
    for f in parquet_files(f"{tmp_dir}/m"):
        per_dir.setdefault(os.path.dirname(f), []).append(f)
    # A small year gets more than one file only if it hashed to the hot year's
    # shuffle partition and was split along with it.
    counts = {d: len(v) for d, v in per_dir.items()}
    assert counts["taxyr=2000"] > 1
    assert min(counts[f"taxyr={y}"] for y in (2001, 2002, 2003)) == 1, counts
    assert read_mirror(spark, f"{tmp_dir}/m", ["taxyr"]).count() == 200_000


def test_manifest_parses_escaped_partition_values(spark, tmp_dir):
    values = ["a b", "x/y", "50%", "p+q", "k=v"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, cur string")
    write_mirror(df, f"{tmp_dir}/m", ["cur"])
    man = file_manifest(spark, f"{tmp_dir}/m", ["cur"])
    assert sorted(r["cur"] for r in man.collect()) == sorted(values)
    back = read_mirror(spark, f"{tmp_dir}/m", ["cur"])
    assert sorted(r["cur"] for r in back.collect()) == sorted(values)


def test_read_mirror_merges_partition_schemas(spark, tmp_dir):
    dest = f"{tmp_dir}/m"
    write_mirror(spark.createDataFrame([(1, 2000)], "a int, taxyr int"), dest, ["taxyr"])
    write_mirror(spark.createDataFrame([(2, "x", 2001)], "a int, b string, taxyr int"), dest, ["taxyr"])
    merged = read_mirror(spark, dest, ["taxyr"], merge_schema=True)
    assert set(merged.columns) == {"a", "b", "taxyr"}
    assert rows_of(merged, "a", "b", "taxyr") == [(1, None, 2000), (2, "x", 2001)]


def test_two_pass_with_dotted_column_names(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "`a.b` int, taxyr int")
    stage_extract(df, f"{tmp_dir}/s")
    compact_staged(spark, f"{tmp_dir}/s", f"{tmp_dir}/f", df.schema, ["taxyr"])
    assert rows_of(read_mirror(spark, f"{tmp_dir}/f", ["taxyr"]), "a.b", "taxyr") == [(1, 2000), (2, 2001)]
