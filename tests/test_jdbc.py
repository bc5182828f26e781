"""JDBC extraction against an in-process Derby database (no server, no port)."""

import contextlib
import io
import uuid

import pytest
from pyspark.sql import functions as F

from mirrorkit.functions.fixed import GLOBAL_SCHEMA_OVERRIDES
from mirrorkit.plans.batch import mirror_frame, run_job
from mirrorkit.plans.job import MirrorJob
from mirrorkit.sources.files import read_mirror
from mirrorkit.sources.jdbc import JdbcSource, jdbc_properties, read_jdbc

DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"
# Inclusive hand-kept style chunks with the gap at ...099 / ...100.
CHUNKS = [
    "PARID BETWEEN '00000000000000' AND '02121001271099'",
    "PARID BETWEEN '02121001271100' AND '99999999999999'",
    "PARID NOT BETWEEN '00000000000000' AND '99999999999999'",
    "PARID IS NULL",
]
ROWS = [
    "('02121001271050', 2020, 'Y', 12.5, TIMESTAMP('2020-01-02 03:04:05.678999'), TIMESTAMP('2020-01-01 00:00:00'))",
    "('02121001271099A', 2021, 'N', 2.5, NULL, NULL)",
    "('ABC', 2022, 'D', -2.5, NULL, NULL)",
    "(NULL, 2020, 'Y', 1.5, NULL, NULL)",
    "('03000000000000', 2020, NULL, 0.49, NULL, NULL)",
    "('04000000000000', NULL, 'Y', 7, NULL, NULL)",
    "('05000000000000', 2019, 'Y', 8, TIMESTAMP('1899-12-31 23:59:59'), NULL)",
]


@pytest.fixture(scope="module")
def derby(spark):
    url = f"jdbc:derby:memory:mirror{uuid.uuid4().hex[:8]};create=true"
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(DRIVER)
    conn = jvm.java.sql.DriverManager.getConnection(url)
    stmt = conn.createStatement()
    stmt.execute("CREATE SCHEMA SRC")
    stmt.execute(
        "CREATE TABLE SRC.PARCEL (PARID VARCHAR(20), TAXYR DECIMAL(4,0), CUR VARCHAR(1), "
        "AMT DECIMAL(31,10), WHEN_TS TIMESTAMP, DEACTIVAT TIMESTAMP)"
    )
    for row in ROWS:
        stmt.execute(f"INSERT INTO SRC.PARCEL VALUES {row}")
    conn.close()
    return url


def props():
    return {"driver": DRIVER}


def test_full_and_chunked_scan(spark, derby):
    full = read_jdbc(spark, derby, "SRC.PARCEL", properties=props())
    assert full.count() == 7 and full.rdd.getNumPartitions() == 1
    chunked = read_jdbc(spark, derby, "SRC.PARCEL", predicates=CHUNKS, properties=props())
    assert chunked.rdd.getNumPartitions() == 4
    assert chunked.count() == 6  # the key between the inclusive ranges is lost
    assert chunked.where("PARID = '02121001271099A'").count() == 0
    with pytest.raises(ValueError):
        read_jdbc(spark, derby, "SRC.PARCEL", predicates=["PARID IS NULL", " "], properties=props())


def test_custom_schema_and_fetch_size(spark, derby):
    p = jdbc_properties(props(), GLOBAL_SCHEMA_OVERRIDES)
    assert p["fetchsize"] == "10000" and p["customSchema"] == "`deactivat` STRING, `taxyr` INTEGER"
    df = read_jdbc(spark, derby, "SRC.PARCEL", properties=props(), overrides=GLOBAL_SCHEMA_OVERRIDES)
    types = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    assert types["taxyr"] == "int" and types["deactivat"] == "string"
    assert types["amt"] == "decimal(31,10)"


def test_extract_pushes_job_filter_into_source(spark, derby):
    job = MirrorJob("p", "SRC.PARCEL", (2020, 2021), ("Y", "N"), tuple(CHUNKS),
                    tuple(GLOBAL_SCHEMA_OVERRIDES.items()))
    df = mirror_frame(job, JdbcSource(spark, derby, props()))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    plan = out.getvalue()
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for part in ("*IsNotNull(TAXYR)", "*GreaterThanOrEqual(TAXYR,2020)", "*LessThanOrEqual(TAXYR,2021)",
                 "*In(CUR, [N,Y"):
        assert part in pushed + "]", plan
    rows = {r["parid"]: r for r in df.collect()}
    assert set(rows) == {"02121001271050", None}
    assert rows["02121001271050"]["when_ts"] == "2020-01-02 03:04:05.678"
    assert rows["02121001271050"]["deactivat"].startswith("2020-01-01 00:00:00")


def test_jdbc_job_end_to_end(spark, derby, tmp_dir):
    job = MirrorJob("p", "SRC.PARCEL", (1800, 2030), ("Y", "N", "D"), tuple(CHUNKS),
                    tuple(GLOBAL_SCHEMA_OVERRIDES.items()))
    result = run_job(spark, job, JdbcSource(spark, derby, props()), tmp_dir)
    assert result.status == "ok", result.error
    assert result.rows == 4  # lost key, null cur and null year rows are not mirrored
    back = read_mirror(spark, f"{tmp_dir}/PARCEL", job.partitions)
    assert back.count() == 4
    old = back.where(F.col("taxyr") == 2019).collect()[0]
    assert old["when_ts"] == "1899-12-31 23:59:59.000"


def test_overrides_for_absent_columns_are_ignored(spark, derby):
    overrides = {"nosuch": "STRING", "taxyr": "INTEGER"}
    df = read_jdbc(spark, derby, "SRC.PARCEL", properties=props(), overrides=overrides)
    assert df.count() == 7
    assert {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}["taxyr"] == "int"
