"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest, spark_type_as_duckdb

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_a_callable_and_entry_runs(spark):
    assert set(ORACLES) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["taxyr", "cur", "n"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(rows) > 0
        return
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {f.name: spark_type_as_duckdb(f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == {d[0]: str(d[1]) for d in res.description}
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
