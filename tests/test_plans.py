"""Physical plan checks: pushdown, pruning, a single exchange per mirror write."""

import contextlib
import io

from pyspark.sql import functions as F

from mirrorkit.functions.fixed import GLOBAL_SCHEMA_OVERRIDES
from mirrorkit.plans.batch import TableSource, extract_plan
from mirrorkit.plans.job import MirrorJob
from mirrorkit.registry import source_frame
from mirrorkit.sinks.parquet import compacted, write_mirror
from mirrorkit.sources.files import read_mirror
from tests.conftest import SF_SMALL


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def test_filter_reaches_parquet_scan_through_normalise(spark, tmp_dir):
    # A source table stored with its own (upper-case) column names.
    source_frame(spark, SF_SMALL, "orders_src").write.parquet(f"{tmp_dir}/src")
    job = MirrorJob("o", "t", (1996, 1998), ("Y", "D"), ("PARID < '00000000000700'", "PARID >= '00000000000700'",
                    "PARID IS NULL"), tuple(GLOBAL_SCHEMA_OVERRIDES.items()))
    df = extract_plan(job, TableSource({"t": lambda: spark.read.parquet(f"{tmp_dir}/src")}))
    plan = plan_of(compacted(df, job.partitions))
    pushed = plan.split("PushedFilters: [", 1)[1].split("\n", 1)[0]
    for part in ("IsNotNull(TAXYR)", "GreaterThanOrEqual(TAXYR,1996)", "LessThanOrEqual(TAXYR,1998)",
                 "In(CUR, [D,Y])"):
        assert part in pushed, plan
    assert plan.count("Exchange (") == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_pruned_read_uses_partition_filters(spark, tmp_dir):
    df = source_frame(spark, SF_SMALL, "orders_src").selectExpr("PARID AS parid", "TAXYR AS taxyr", "CUR AS cur")
    write_mirror(df, f"{tmp_dir}/m", ["taxyr", "cur"])
    back = read_mirror(spark, f"{tmp_dir}/m", ["taxyr", "cur"]).where((F.col("taxyr") == 1997) & (F.col("cur") == "N"))
    plan = plan_of(back)
    assert "PartitionFilters: [isnotnull(taxyr" in plan and "(cur" in plan
    assert back.count() == source_frame(spark, SF_SMALL, "orders_src").where("TAXYR = 1997 AND CUR = 'N'").count()
