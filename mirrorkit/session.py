"""Session settings and the shared work folder.

Everything the library writes besides the mirror itself (staged files,
materialised manifests, generated log text) goes under the checkpoint
directory the cluster names in ``spark.checkpoint.dir``, because that folder
is shared by all executors and survives the loss of any one of them. Only when
nothing is configured (local runs, tests) does the library pick a folder of
its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a mirror session wants; ``build_session(conf=...)`` overrides them.
MIRROR_SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot Hive partition over several writer tasks instead of one.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffle bytes above which a Hive partition is split: the target size of
    # compacted files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Many initial reducers, merged back by adaptive coalescing: a small Hive
    # partition rarely shares a reducer with a hot one, so it is rarely split
    # along with it. A floor; size it to about extract size / 256 MB at scale.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    # Merge small writer tasks up to that size rather than keep one per core.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Concurrent jobs of a batch share the executors.
    "spark.scheduler.mode": "FAIR",
    "spark.sql.session.timeZone": "UTC",
    # JDBC drivers and log clocks count in the JVM's zone: keep all in one.
    "spark.driver.extraJavaOptions": "-Duser.timezone=UTC",
    "spark.executor.extraJavaOptions": "-Duser.timezone=UTC",
    # Old dates (before 1900) must keep their calendar value.
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    # Checkpointed manifests and samples are removed once no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "mirror",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the mirror defaults; ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(MIRROR_SESSION_DEFAULTS)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.match(r"local(\[|$)", sc.master):
        # Nothing configured and one machine only: a local run or a test.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="mirror-checkpoint-"))
    else:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by all executors "
            "(mirror jobs keep manifests and staged files there)"
        )
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/mirrorkit/{purpose}-{uuid.uuid4().hex[:12]}"
