import pytest


@pytest.fixture()
def small_shuffles(spark):
    """Few shuffle partitions: the tables of these tests have few rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", before[1])
