"""Point reads, reports that prune, derived overrides, global positions, deadlines."""

import contextlib
import datetime as dt
import io
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mirrorkit.operators.infer import lost_values, proposed_overrides, type_profile
from mirrorkit.operators.normalize import normalize
from mirrorkit.operators.ordering import with_position
from mirrorkit.operators.reconcile import rows_in
from mirrorkit.plans import batch
from mirrorkit.plans.batch import TableSource, largest_first, run_batch
from mirrorkit.plans.job import MirrorJob
from mirrorkit.sinks.parquet import write_mirror
from mirrorkit.sources.files import read_keys, read_mirror
from mirrorkit.sources.logs import numbered_log_events
from tests.conftest import rows_of


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def rows_scanned(df):
    """Rows that the Parquet scans of a run query gave to Spark."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "FileSourceScan" in node.getClass().getName() and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().get("numOutputRows").get().value())
        for inner in ("executedPlan", "plan"):  # adaptive plans and query stages are no children
            if inner in dir(node) and "Adaptive" + inner not in str(node.getClass().getName()):
                with contextlib.suppress(Exception):
                    walk(getattr(node, inner)())
                    return
        children = node.children()
        for i in range(children.length()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


def test_point_reads_skip_row_groups_and_pages(spark, tmp_dir):
    df = spark.range(200_000).select(
        F.format_string("%014d", F.pmod(F.xxhash64("id"), F.lit(1_000_000_007))).alias("parid"),
        (F.lit(2000) + F.col("id") % 2).cast("int").alias("taxyr"), F.repeat(F.lit("x"), 40).alias("pad"), "id")
    keys = [r["parid"] for r in df.where("id IN (5, 77, 1234, 199999)").collect()]
    for name, options in (("plain", {}), ("points", {"point_key": "parid"})):
        write_mirror(df, f"{tmp_dir}/{name}", ("taxyr",), **options)
    plain, points = (read_mirror(spark, f"{tmp_dir}/{name}", ("taxyr",)) for name in ("plain", "points"))
    wanted = rows_of(df.where(F.col("parid").isin(keys)), "id", "parid", "taxyr")
    assert rows_of(read_keys(points, "parid", keys), "id", "parid", "taxyr") == wanted and len(wanted) >= 4
    assert points.count() == 200_000
    assert rows_scanned(read_keys(plain, "parid", keys)) > 100_000
    assert rows_scanned(read_keys(points, "parid", keys)) < 40_000  # pages outside the keys' ranges stay unread
    # A key inside every range but in no row group: the Bloom filter knows.
    absent = next(f"{n:014d}" for n in range(500_000_000, 500_100_000) if not df.where(F.col("parid") == f"{n:014d}").count())
    assert rows_scanned(read_keys(points, "parid", [absent])) == 0


def test_writes_leave_the_session_as_it_was(spark, tmp_dir):
    name = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        unset = spark.conf.get(name, None)
        write_mirror(spark.range(1000), f"{tmp_dir}/m")
        assert spark.conf.get(name, None) == unset
        assert spark.read.parquet(f"{tmp_dir}/m").select(F.input_file_name()).distinct().count() == 1
    finally:
        spark.conf.set(name, before)
    write_mirror(spark.range(10), f"{tmp_dir}/n")
    assert spark.conf.get(name) == before


def test_point_reads_of_many_null_and_no_keys(spark, tmp_dir):
    df = spark.createDataFrame([(f"k{i:03}" if i % 10 else None, i) for i in range(100)], "parid string, v int")
    write_mirror(df, f"{tmp_dir}/m", point_key="parid")
    mirror = read_mirror(spark, f"{tmp_dir}/m")
    keys = [f"k{i:03}" for i in range(5, 40)] * 2 + ["none"]
    assert rows_of(read_keys(mirror, "parid", keys), "v") == sorted([(i,) for i in range(5, 40) if i % 10], key=repr)
    assert read_keys(mirror, "parid", [None]).count() == 10 and read_keys(mirror, "parid", []).count() == 0


def test_a_report_prunes_the_mirror(spark, tmp_dir):
    df = spark.createDataFrame([(i, 2000 + i % 5 if i % 7 else None, "YN"[i % 2]) for i in range(100)], "v int, taxyr int, cur string")
    write_mirror(df, f"{tmp_dir}/m", ("taxyr", "cur"))
    mirror = read_mirror(spark, f"{tmp_dir}/m", ("taxyr", "cur"))
    report = spark.createDataFrame([("taxyr=2001/cur=Y", "2001", "Y"), ("taxyr=2003/cur=N", "2003", "N"),
                                    ("taxyr=__HIVE_DEFAULT_PARTITION__/cur=Y", None, "Y")], "partition_dir string, taxyr string, cur string")
    found = rows_in(mirror, report, ("taxyr", "cur"))
    wanted = df.where("(taxyr = 2001 AND cur = 'Y') OR (taxyr = 2003 AND cur = 'N') OR (taxyr IS NULL AND cur = 'Y')")
    assert rows_of(found, "v", "taxyr", "cur") == rows_of(wanted, "v", "taxyr", "cur") and wanted.count() > 10
    assert "dynamicpruning" in plan_of(found).lower()


def test_derived_overrides(spark):
    rows = [
        (1, 100, Decimal("12.3400000000"), 1.0, dt.datetime(2020, 1, 1), "7", "2020-01-31", "007", None, "true", True),
        (-5, 40_000, Decimal("-0.5000000000"), 2.0, dt.datetime(2020, 1, 2), "-12", "2020-02-01", "8", None, "false", None),
        (None, None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "tiny long, mid int, amount decimal(38,10), real double, day timestamp_ntz, `digits` string, "
                                     "`Date Text` string, zeros string, nothing string, flag string, b boolean")
    got = {r["column"]: (r["declared"], r["proposed"], r["nulls"]) for r in type_profile(df).collect()}
    assert got["tiny"] == ("BIGINT", "TINYINT", 1) and got["mid"] == ("INT", "INT", 1)
    assert got["amount"] == ("DECIMAL(38,10)", "DECIMAL(4,2)", 1)
    assert got["real"][1] == "TINYINT" and got["day"][1] == "DATE"
    assert got["digits"][1] == "TINYINT" and got["date text"][1] == "DATE" and got["zeros"][1] == "STRING"
    assert got["nothing"] == ("STRING", "STRING", 3) and got["flag"][1] == "BOOLEAN" and got["b"][1] == "BOOLEAN"
    overrides = proposed_overrides(df)
    assert all(r["lost"] == 0 for r in lost_values(df, overrides).collect())
    assert lost_values(df, {"amount": "DECIMAL(10,0)"}).collect()[0]["lost"] == 2
    typed = dict(normalize(df, overrides, stamp=False).dtypes)
    assert typed["amount"] == "decimal(4,2)" and typed["day"] == "date" and typed["date text"] == "date"


def test_derived_overrides_at_the_edges(spark):
    df = spark.createDataFrame(
        [(2**63 - 1, -(2**31), 2.0**53, float("nan"), -0.0, "9223372036854775808", Decimal("9" * 38), Decimal("0." + "1" * 38)),
         (0, 2**31 - 1, 1.0, 1.0, 1.0, "1", Decimal(0), Decimal(0))],
        "big long, whole int, wide double, nan double, minus double, text string, d decimal(38,0), s decimal(38,38)")
    got = {r["column"]: r["proposed"] for r in type_profile(df).collect()}
    assert got == {"big": "BIGINT", "whole": "INT", "wide": "DOUBLE", "nan": "DOUBLE", "minus": "DOUBLE", "text": "STRING",
                   "d": "DECIMAL(38,0)", "s": "DECIMAL(38,38)"}
    assert {r["column"]: r["proposed"] for r in type_profile(df.limit(0)).collect()}["big"] == "BIGINT"


def test_texts_are_cast_only_when_they_look_like_the_type(spark):
    # A failing cast costs some 50 times one that succeeds; results are those of casting every text.
    texts = ["0", "-0", "00", "7", "+7", " 7", "7 ", "7\n", "-7", "--7", "1.0", "1e3", "٣", "", "-", "R", "é", "null",
             "999999999999999999", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809",
             "9999999999999999999", "2020-01-31", "2020-1-31", "2020-02-30", "2020-02-29", "2019-02-29", "2020-13-01", "2020-01-00",
             "0000-01-01", "-0001-01-01", "+10000-01-01", "10000-01-01", "+5881580-07-11", "+5881580-07-12", "-5877641-06-23",
             "2020-01-31\n", "2020-01-31T", "20200-01-31", "epoch", "true", "false", "True", "t", "yes", "true ", "true\n"]
    names = [f"c{i}" for i in range(len(texts))]
    df = spark.createDataFrame([tuple(texts), (None,) * len(texts)], ", ".join(f"{n} string" for n in names))
    profile = type_profile(df)
    got = {r["column"]: r["proposed"] for r in profile.collect()}
    kept = spark.createDataFrame(list(zip(names, texts)), "n string, c string").selectExpr("n", "c", *[
        f"coalesce(CAST(try_cast(c AS {t}) AS STRING) = c, false) AS {t}" for t in ("bigint", "date", "boolean")])

    def wanted(r):
        if r["bigint"]:
            v = int(r["c"])
            return next((t for t, m in (("TINYINT", 2**7), ("SMALLINT", 2**15), ("INT", 2**31)) if -m <= v < m), "BIGINT")
        return "DATE" if r["date"] else "BOOLEAN" if r["boolean"] else "STRING"

    want = {r["n"]: wanted(r) for r in kept.collect()}
    assert got == want and {"TINYINT", "BIGINT", "DATE", "BOOLEAN", "STRING"} == set(want.values())
    one = type_profile(df.select("c0"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in one


def test_decimals_in_use_take_few_roundings(spark):
    values = ["0", "5", "-100", "0.5", "-0.05", "12.34", "1.0000000001", "9999999999999999999999999999.9999999999",
              "-9999999999999999999999999999.5", "0.9999999999", "0.0000000010"]
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(map(Decimal, values)), (None,) * len(values)], ", ".join(f"{n} decimal(38,10)" for n in names))
    got = {r["column"]: r["proposed"] for r in type_profile(df).collect()}
    for name, value in zip(names, values):
        whole, _, part = value.lstrip("-").partition(".")
        used = len(part.rstrip("0"))
        assert got[name] == f"DECIMAL({max(1, len(whole.lstrip('0')) + used)},{used})", value
    # Nested, so that a value is rounded for few numbers of decimals; before, for each.
    nested = type_profile(df.select("c0"))._jdf.queryExecution().optimizedPlan().toString()
    assert " + CASE WHEN" not in nested and nested.count("round(") == 10


def test_positions_without_one_task(spark, tmp_dir):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 4).alias("k")).repartition(7)
    order = [F.col("k").asc_nulls_last(), F.col("id").asc()]
    got = with_position(df, order)
    want = [r["id"] for r in df.orderBy(*order).collect()]
    assert [r["id"] for r in sorted(got.collect(), key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got.collect()) == list(range(5000))
    assert "Window" not in plan_of(got) and with_position(df.limit(0), order).count() == 0
    for name, text in (("a.log", "2026-01-02_03:04:05.1 x\nno time\n2026-01-02_03:04:05.1 y\n"), ("b.log", "2026-01-01_03:04:05.1 z\n")):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    events = numbered_log_events(spark, tmp_dir)
    assert "Window" not in plan_of(events)
    assert [r["message"] for r in sorted(events.collect(), key=lambda r: r["position"])] == ["z", "x", "y", "no time"]


def test_a_deadline_cancels_one_job_only(spark, tmp_dir):
    def endless(batches):
        for b in batches:
            while True:
                time.sleep(0.05)
                yield b

    five = spark.range(5)
    source = TableSource({"never": lambda: five.mapInArrow(endless, "id bigint"), "soon": lambda: five, "bad": lambda: 1 / 0})
    jobs = [MirrorJob(t, t, None, None, None, ()) for t in ("never", "soon", "bad")]
    started = time.time()
    rows = {r["job"]: r for r in run_batch(spark, jobs, source, tmp_dir, deadline={"never": 3.0, "bad": 60.0},
                                           raise_on_failure=False, retries=1).collect()}
    assert time.time() - started < 60
    assert (rows["never"]["status"], rows["never"]["attempts"], rows["never"]["rows"]) == ("cancelled", 1, None)
    assert (rows["soon"]["status"], rows["soon"]["rows"]) == ("ok", 5) and rows["bad"]["status"] == "failed"
    assert list(rows) == ["never", "soon", "bad"]
    with pytest.raises(batch.BatchFailed, match="never"):
        run_batch(spark, jobs[:1], source, tmp_dir, deadline=1.0)
    assert spark.range(3).count() == 3  # the session goes on


def test_the_largest_job_starts_first(spark, tmp_dir):
    for name, n in (("small", 10), ("large", 100_000), ("middle", 1000)):
        spark.range(n).write.parquet(f"{tmp_dir}/{name}")
    source = TableSource({n: (lambda n=n: spark.read.parquet(f"{tmp_dir}/{n}")) for n in ("small", "large", "middle")})
    jobs = [MirrorJob(t, t, None, None, None, ()) for t in ("small", "absent", "large", "middle")]
    assert [j.name for j in largest_first(jobs, source)] == ["absent", "large", "middle", "small"]
