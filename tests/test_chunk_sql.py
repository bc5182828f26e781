"""Chunk queries for the source database: their text, run by the oracle's SQL engine over the test tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from mirrorkit.operators import chunk_sql, chunks as ch
from mirrorkit.registry import SOURCES, source_frame
from tests.conftest import SF_SMALL, rows_of


@pytest.fixture()
def run_sql():
    con = duckdb.connect()
    for name, (table, columns) in SOURCES.items():
        con.sql(f"CREATE VIEW {name} AS SELECT {', '.join(columns)} FROM '{SF_SMALL}/{table}.parquet'")
    return lambda sql: con.sql(sql).fetchall()


def test_bounds_are_those_that_spark_derives(spark, run_sql):
    orders = source_frame(spark, SF_SMALL, "orders_src")
    for column, chunks in (("PARID", 8), ("WHEN_TS", 12), ("CUSTKEY", 96), ("CUR", 2), ("PARID", 1)):
        mine = [(int(part), lower) for part, lower in run_sql(chunk_sql.bounds_sql("orders_src", column, chunks))]
        assert sorted(mine) == rows_of(ch.derive_chunk_bounds(orders, column, chunks), "part", "lower") or sorted(mine) == sorted(
            tuple(r) for r in ch.derive_chunk_bounds(orders, column, chunks).collect())
        listed = chunk_sql.chunks_from_source(run_sql, "orders_src", column, chunks)
        assert [tuple(r) for r in ch.chunk_coverage(orders, list(listed)).collect()] == [(1, orders.count())]


def test_hot_keys_are_split(spark, run_sql):
    items = source_frame(spark, SF_SMALL, "lineitem_src")
    listed = chunk_sql.chunks_from_source(run_sql, "lineitem_src", "RETURNFLAG", 8, split_column="PARID")
    assert [tuple(r) for r in ch.chunk_coverage(items, list(listed)).collect()] == [(1, items.count())]
    assert max(r["n"] for r in ch.chunk_counts(items, list(listed)).collect()) <= 1.1 * items.count() / 8
    orders = source_frame(spark, SF_SMALL, "orders_src")
    for column in ("CUR", "TAXYR", "PARID"):
        listed = chunk_sql.chunks_from_source(run_sql, "orders_src", column, 10, split_column="CUSTKEY")
        assert [tuple(r) for r in ch.chunk_coverage(orders, list(listed)).collect()] == [(1, orders.count())]


def test_a_hot_null_key(spark):
    con = duckdb.connect()
    con.sql("CREATE TABLE t AS SELECT CASE WHEN i < 60 THEN NULL ELSE i END AS k, i AS s FROM range(100) r(i)")
    listed = chunk_sql.chunks_from_source(lambda sql: con.sql(sql).fetchall(), "t", "k", 5, split_column="s")
    df = spark.range(100).select(F.when(F.col("id") >= 60, F.col("id")).alias("k"), F.col("id").alias("s"))
    assert [tuple(r) for r in ch.chunk_coverage(df, list(listed)).collect()] == [(1, 100)]
    assert all(r["n"] <= 20 for r in ch.chunk_counts(df, list(listed)).collect())


def test_the_query_text():
    text = chunk_sql.bounds_sql("s.t", "PARID", 96)
    assert text == (
        "SELECT part, MIN(k) AS lower FROM (SELECT k, FLOOR(before * 96 / total) AS part FROM ("
        "SELECT k, SUM(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before, SUM(n) OVER () AS total "
        "FROM (SELECT PARID AS k, COUNT(*) AS n FROM s.t WHERE PARID IS NOT NULL GROUP BY PARID) c) p) q GROUP BY part ORDER BY part")
    assert "\"odd name\"" in chunk_sql.bounds_sql("t", "odd name", 4)
    assert "= 'it''s\\'" in chunk_sql.split_sql("t", "k", "s", "it's\\", 3)


def test_no_rows_and_bad_counts(spark):
    con = duckdb.connect()
    con.sql("CREATE TABLE t (k VARCHAR, s INT)")
    run = lambda sql: con.sql(sql).fetchall()
    assert list(chunk_sql.chunks_from_source(run, "t", "k", 5)) == ["k IS NOT NULL", "k IS NULL"]
    assert list(chunk_sql.chunks_from_source(run, "t", "k", 5, split_column="s")) == ["k IS NOT NULL", "k IS NULL"]
    with pytest.raises(ValueError):
        chunk_sql.chunks_from_source(run, "t", "k", 0)
