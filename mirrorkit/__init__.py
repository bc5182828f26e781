"""Mirror relational tables into partitioned, compacted Parquet with Spark."""

from mirrorkit.operators.normalize import normalize
from mirrorkit.plans.batch import TableSource, extract_plan, mirror_frame, run_batch, run_job
from mirrorkit.plans.job import (
    MirrorJob, TableDefinition, derive_job, global_overrides_from_config, job_from_spec, jobs_from_specs,
    lint_job, load_batch_specs, table_definitions_from_config,
)
from mirrorkit.session import build_session, ensure_checkpoint_dir
from mirrorkit.sinks.parquet import write_mirror
from mirrorkit.sources.files import read_mirror
from mirrorkit.sources.jdbc import JdbcSource, read_jdbc

__all__ = [
    "JdbcSource", "MirrorJob", "TableDefinition", "TableSource", "build_session",
    "derive_job", "ensure_checkpoint_dir", "extract_plan", "mirror_frame", "job_from_spec", "jobs_from_specs",
    "lint_job", "load_batch_specs", "global_overrides_from_config", "table_definitions_from_config",
    "normalize", "read_jdbc", "read_mirror", "run_batch", "run_job", "write_mirror",
]
