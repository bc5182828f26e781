"""Print the formatted physical plans of the headline operations.

Usage: python tools/show_plans.py [sf_dir]
Shows where filters land (PushedFilters / PartitionFilters), the single
compaction exchange, and the exchanges of the reconcile and chunk plans.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from mirrorkit.functions.fixed import GLOBAL_SCHEMA_OVERRIDES  # noqa: E402
from mirrorkit.operators import chunks as ch  # noqa: E402
from mirrorkit.operators.normalize import narrow_numbers, render_text  # noqa: E402
from mirrorkit.plans.batch import TableSource, extract_plan  # noqa: E402
from mirrorkit.plans.job import MirrorJob  # noqa: E402
from mirrorkit.registry import INCLUSIVE_CHUNKS, source_frame  # noqa: E402
from mirrorkit.session import build_session, work_dir  # noqa: E402
from mirrorkit.sinks.parquet import compacted, write_mirror  # noqa: E402
from mirrorkit.sources.files import read_mirror  # noqa: E402
from mirrorkit.sources.listing import file_manifest  # noqa: E402
from mirrorkit.operators.reconcile import partition_status  # noqa: E402


def show(title, df):
    print(f"\n===== {title} =====")
    df.explain(mode="formatted")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    # A source stored with its own column names, as a staged extract would be.
    src = work_dir(spark, "plans-src")
    source_frame(spark, sf, "lineitem_src").write.parquet(src)
    job = MirrorJob("lineitem", "lineitem_src", (1996, 1998), ("Y",), None, tuple(GLOBAL_SCHEMA_OVERRIDES.items()))
    extracted = extract_plan(job, TableSource({"lineitem_src": lambda: spark.read.parquet(src)}))
    narrowed = narrow_numbers(extracted, job.overrides)
    show("mirror write: scan -> filter -> narrow -> exchange -> render text",
         render_text(compacted(narrowed, job.partitions), job.overrides))
    dest = work_dir(spark, "plans-mirror")
    write_mirror(extracted, dest, job.partitions, before_exchange=lambda d: narrow_numbers(d, job.overrides),
                 after_exchange=lambda d: render_text(d, job.overrides))
    show("pruned mirror read", read_mirror(spark, dest, job.partitions).where(F.col("taxyr") == 1997))
    before = file_manifest(spark, dest, job.partitions, within=job.scope_glob).checkpoint(eager=True)
    write_mirror(extracted, dest, job.partitions, before_exchange=lambda d: narrow_numbers(d, job.overrides),
                 after_exchange=lambda d: render_text(d, job.overrides))
    after = file_manifest(spark, dest, job.partitions, within=job.scope_glob)
    show("reconcile report: one full outer join of the manifests, one aggregate per folder",
         partition_status(after, before, job.partitions))
    show("chunk coverage", ch.chunk_coverage(source_frame(spark, sf, "orders_src"), INCLUSIVE_CHUNKS))


if __name__ == "__main__":
    main()
