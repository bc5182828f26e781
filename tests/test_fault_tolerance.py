"""Task failures in the middle of a mirror write (a stand-in for lost executors).

Local mode only retries tasks with a ``local[N,F]`` master, so this runs in a
child process with its own session. The first attempt of one scan task and of
one writer task fails; the retried job must write every row exactly once and
count every row exactly once.
"""

import json
import subprocess
import sys
import textwrap
from pathlib import Path

SCRIPT = textwrap.dedent('''
    import json, sys, tempfile
    sys.path.insert(0, sys.argv[1])
    from pyspark import TaskContext
    from pyspark.sql import Observation, functions as F
    from mirrorkit.session import build_session
    from mirrorkit.sinks.parquet import write_mirror
    from mirrorkit.sources.files import read_mirror
    from mirrorkit.sources.listing import file_manifest

    spark = build_session("local[4,4]", conf={"spark.sql.shuffle.partitions": "4"})
    spark.sparkContext.setLogLevel("OFF")

    def fail_first_attempt(stage_tag, partition):
        def check(v):
            ctx = TaskContext.get()
            if ctx.attemptNumber() == 0 and ctx.partitionId() == partition:
                raise RuntimeError(f"injected failure in {stage_tag}")
            return v
        return F.udf(check, "long")

    src = spark.range(0, 40000, 1, 4).select(
        fail_first_attempt("scan", 1)(F.col("id")).alias("id"),
        (F.lit(2000) + F.col("id") % 5).cast("int").alias("taxyr"),
    )
    out = tempfile.mkdtemp(prefix="mirror-ft-")
    obs = Observation("ft")
    write_mirror(
        src, out, ["taxyr"],
        after_exchange=lambda d: d.withColumn("id", fail_first_attempt("writer", 0)(F.col("id"))),
        observation=obs, metrics=[F.count(F.lit(1)).alias("rows")],
    )
    back = read_mirror(spark, out, ["taxyr"])
    stats = back.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("d")).collect()[0]
    files = file_manifest(spark, out, ["taxyr"]).count()

    # Unpartitioned: compaction is a round-robin rebalance, retried the same way.
    flat = tempfile.mkdtemp(prefix="mirror-ft-flat-")
    obs2 = Observation("ft-flat")
    write_mirror(
        src.drop("taxyr"), flat, [],
        after_exchange=lambda d: d.withColumn("id", fail_first_attempt("writer", 0)(F.col("id"))),
        observation=obs2, metrics=[F.count(F.lit(1)).alias("rows")],
    )
    flat_stats = spark.read.parquet(flat).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("d")).collect()[0]
    print(json.dumps({"observed": obs.get["rows"], "rows": stats["n"], "distinct": stats["d"], "files": files,
                      "flat_observed": obs2.get["rows"], "flat_rows": flat_stats["n"],
                      "flat_distinct": flat_stats["d"]}))
''')


def test_mirror_write_survives_task_failures(tmp_dir):
    script = Path(tmp_dir) / "ft.py"
    script.write_text(SCRIPT)
    repo = str(Path(__file__).resolve().parents[1])
    proc = subprocess.run([sys.executable, str(script), repo], capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-3000:]
    result = json.loads(proc.stdout.strip().splitlines()[-1])
    assert result == {"observed": 40000, "rows": 40000, "distinct": 40000, "files": 5,
                      "flat_observed": 40000, "flat_rows": 40000, "flat_distinct": 40000}
