"""Mirror jobs and table definitions.

A job names a source table and, optionally, an inclusive year range, a set
of status values and a chunk list. A key that is absent from a job spec takes
the default; an explicit null switches the feature off (no filter and no
partition on that column, or an unchunked scan).
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from mirrorkit.functions.fixed import (
    DEFAULT_CUR,
    DEFAULT_MIN_YEAR,
    GLOBAL_SCHEMA_OVERRIDES,
    STATUS_COLUMN,
    YEAR_COLUMN,
)
from mirrorkit.functions.types import merge_overrides
from mirrorkit.operators.filters import conjunction, job_predicate

log = logging.getLogger(__name__)

DEFAULT_PREDICATES = "default"


def mirror_name(table_name: str) -> str:
    """Folder name of a table's mirror: the name without its schema prefix."""
    return table_name.split(".", 1)[1] if "." in table_name else table_name


@dataclass(frozen=True)
class TableDefinition:
    """What a source table supports; jobs may be derived from and linted against it."""

    min_year: int | None = None
    has_cur: bool = False
    has_parid: bool = False
    override_items: tuple[tuple[str, str], ...] = ()

    @property
    def schema_overrides(self) -> dict[str, str]:
        return dict(self.override_items)

    @classmethod
    def from_spec(cls, spec: Mapping) -> "TableDefinition":
        return cls(
            min_year=_as_year(spec.get("min_year"), "min_year"),
            has_cur=bool(spec.get("has_cur", False)),
            has_parid=bool(spec.get("has_parid", False)),
            override_items=tuple(merge_overrides(spec.get("schema_overrides")).items()),
        )


@dataclass(frozen=True)
class MirrorJob:
    """One table to mirror. Build with ``job_from_spec`` or ``derive_job``."""

    name: str
    table_name: str
    years: tuple[int, int] | None = None
    cur: tuple[str, ...] | None = None
    predicates: tuple[str, ...] | None = None
    override_items: tuple[tuple[str, str], ...] = field(default=())

    @property
    def overrides(self) -> dict[str, str]:
        return dict(self.override_items)

    @property
    def mirror_name(self) -> str:
        return mirror_name(self.table_name)

    @property
    def restrictions(self) -> tuple["Restriction", ...]:
        """The active filters, in partition order: year, then status."""
        found = (
            Restriction(YEAR_COLUMN, tuple(range(self.years[0], self.years[1] + 1)), self.years) if self.years else None,
            Restriction(STATUS_COLUMN, self.cur, self.cur) if self.cur is not None else None,
        )
        return tuple(r for r in found if r is not None)

    @property
    def partitions(self) -> tuple[str, ...]:
        """Hive partition columns: those with an active filter."""
        return tuple(r.column for r in self.restrictions)

    @property
    def predicate(self) -> Column | None:
        return job_predicate(self.years, self.cur)

    @property
    def partition_scope(self) -> Column | None:
        """The job filter restated on manifest partition values (text columns)."""
        return conjunction([F.col(r.column).isin([str(v) for v in r.values]) for r in self.restrictions])

    @property
    def scope_glob(self) -> str | None:
        """Path glob of the partition folders this job can write, e.g.
        ``taxyr={2023,2024}/cur={D,N,Y}``; ``None`` when the whole table is in
        scope (or a status value is not a plain folder name)."""
        return "/".join(g for g in (r.glob() for r in self.restrictions)) if self.restrictions and all(
            r.plain() for r in self.restrictions) else None

    @property
    def description(self) -> str:
        """``table, taxyr=[lo, hi], cur=[Y, N]`` (shown as the Spark job description)."""
        return ", ".join((self.table_name, *(r.label() for r in self.restrictions)))


@dataclass(frozen=True)
class Restriction:
    """An active filter on a partition column: all its values, and how it is shown."""

    column: str
    values: tuple
    shown: tuple

    def plain(self) -> bool:
        return all(str(v).isalnum() for v in self.values)

    def glob(self) -> str:
        return f"{self.column}={{{','.join(sorted(str(v) for v in self.values))}}}"

    def label(self) -> str:
        return f"{self.column}=[{', '.join(str(v) for v in self.shown)}]"


def _as_year(value, what: str) -> int | None:
    if value is None:
        return None
    if isinstance(value, bool):
        raise ValueError(f"{what} must be an integer year, got {value!r}")
    if isinstance(value, int):
        return value
    if isinstance(value, str) and value.strip().lstrip("-").isdigit():
        return int(value.strip())
    raise ValueError(f"{what} must be an integer year, got {value!r}")


def load_predicates(path: str | Path) -> tuple[str, ...]:
    """Chunk predicates from a text file, one per line; a blank line is an error."""
    lines = [line.strip() for line in Path(path).read_text().splitlines()]
    while lines and not lines[-1]:
        lines.pop()
    if not lines or any(not line for line in lines):
        raise ValueError(f"{path}: blank chunk predicate")
    return tuple(lines)


def _as_chunks(predicates: Sequence[str]) -> tuple[str, ...]:
    """Keeps what a derived list knows about itself."""
    return predicates if isinstance(predicates, tuple) else tuple(predicates)


def job_from_spec(
    name: str,
    spec: Mapping,
    *,
    table_definitions: Mapping[str, TableDefinition] | None = None,
    global_overrides: Mapping[str, str] | None = GLOBAL_SCHEMA_OVERRIDES,
    predicate_sets: Mapping[str, Sequence[str]] | None = None,
    predicates_loader: Callable[[str], Sequence[str]] = load_predicates,
    current_year: int | None = None,
) -> MirrorJob:
    """Resolve one job spec (``table_name``, ``min_year``, ``max_year``, ``cur``,
    ``predicates_path``) against the defaults.

    Rejected instead of silently widened: ``min_year > max_year`` and an
    empty ``cur`` list (either would otherwise mean a full, unfiltered extract).
    """
    table = spec.get("table_name")
    if not table or not isinstance(table, str):
        raise ValueError(f"job {name!r}: table_name is required")
    year_now = current_year or _dt.date.today().year
    lo = _as_year(spec.get("min_year", DEFAULT_MIN_YEAR), "min_year")
    hi = _as_year(spec.get("max_year", year_now), "max_year")
    if lo is None or hi is None:
        if (lo, hi) != (None, None):
            log.warning("job %s: one year bound is null, so the year filter is off", name)
        years = None
    elif lo > hi:
        raise ValueError(f"job {name!r}: min_year {lo} > max_year {hi}")
    else:
        years = (lo, hi)

    cur = spec.get("cur", list(DEFAULT_CUR))
    if cur is not None:
        if isinstance(cur, str) or not all(isinstance(v, str) for v in cur):
            raise ValueError(f"job {name!r}: cur must be a list of strings")
        if not cur:
            raise ValueError(f"job {name!r}: cur is empty; use null to disable it")
        cur = tuple(cur)

    sets = predicate_sets or {}
    path = spec.get("predicates_path", DEFAULT_PREDICATES)
    predicates = None
    if path in sets:
        predicates = _as_chunks(sets[path])
    elif "predicates_path" not in spec:
        # No list ships with the library: keys differ from database to database.
        log.warning("job %s: no %r chunk list is given, so the table is scanned unchunked; "
                    "derive one with operators.chunks.derived_chunks", name, DEFAULT_PREDICATES)
    elif path is not None:
        predicates = _as_chunks(predicates_loader(path))

    definition = (table_definitions or {}).get(mirror_name(table))
    overrides = merge_overrides(global_overrides, definition.schema_overrides if definition else None)
    return MirrorJob(name, table, years, cur, predicates, tuple(overrides.items()))


def derive_job(
    name: str,
    table_name: str,
    definition: TableDefinition,
    *,
    default_predicates: Sequence[str] | None,
    global_overrides: Mapping[str, str] | None = GLOBAL_SCHEMA_OVERRIDES,
    current_year: int | None = None,
) -> MirrorJob:
    """The full-extract job a definition implies: all its years, all status
    values if it has a status column, chunks if it has a chunk key."""
    year_now = current_year or _dt.date.today().year
    years = (definition.min_year, year_now) if definition.min_year is not None else None
    overrides = merge_overrides(global_overrides, definition.schema_overrides)
    return MirrorJob(
        name, table_name, years,
        DEFAULT_CUR if definition.has_cur else None,
        _as_chunks(default_predicates) if definition.has_parid and default_predicates else None,
        tuple(overrides.items()),
    )


def lint_job(job: MirrorJob, definition: TableDefinition) -> list[str]:
    """Ways a job disagrees with its table's definition."""
    issues = []
    if job.cur is not None and not definition.has_cur:
        issues.append("filters on cur, but the table has no cur column")
    if job.cur is None and definition.has_cur:
        issues.append("table has a cur column, but the job ignores it")
    if job.predicates is not None and not definition.has_parid:
        issues.append("chunks on parid, but the table has no parid column")
    if job.years is not None and definition.min_year is None:
        issues.append("filters on taxyr, but the table has no taxyr column")
    if job.years is not None and definition.min_year is not None and job.years[0] < definition.min_year:
        issues.append(f"min_year {job.years[0]} is before the table's first year {definition.min_year}")
    return issues


def lint_batch(jobs: Sequence[MirrorJob]) -> list[str]:
    """Jobs whose schema prefix differs from the batch's most common one
    (a job pointed at another environment by mistake)."""
    prefixes = [j.table_name.split(".", 1)[0] for j in jobs if "." in j.table_name]
    if not prefixes:
        return []
    common = max(sorted(set(prefixes)), key=prefixes.count)
    return [
        f"job {j.name!r} reads {j.table_name!r}, the batch reads schema {common!r}"
        for j in jobs
        if "." in j.table_name and j.table_name.split(".", 1)[0] != common
    ]


def check_batch(jobs: Sequence[MirrorJob]) -> None:
    """Reject two jobs that would write the same mirror folder."""
    seen: dict[str, str] = {}
    for job in jobs:
        if job.mirror_name in seen:
            raise ValueError(
                f"jobs {seen[job.mirror_name]!r} and {job.name!r} both mirror {job.mirror_name!r}"
            )
        seen[job.mirror_name] = job.name


def jobs_from_specs(specs: Mapping[str, Mapping], **resolve) -> list[MirrorJob]:
    """Resolve a whole batch (``{job name: spec}``, as loaded from YAML/JSON)
    with ``job_from_spec``; reject two jobs writing one mirror folder."""
    jobs = [job_from_spec(name, spec, **resolve) for name, spec in specs.items()]
    check_batch(jobs)
    for issue in lint_batch(jobs):
        log.warning(issue)
    return jobs


def table_definitions_from_config(config: Mapping) -> dict[str, TableDefinition]:
    """Definitions from a config mapping, either ``{"tables": {...}}`` or the
    inner ``{table: {min_year, has_cur, has_parid, schema_overrides}}``."""
    tables = config.get("tables", config) if isinstance(config, Mapping) else {}
    return {name: TableDefinition.from_spec(spec or {}) for name, spec in tables.items()}


def global_overrides_from_config(config: Mapping) -> dict[str, str]:
    """The ``global_schema_overrides`` mapping of a settings file (lowercased)."""
    return merge_overrides(config.get("global_schema_overrides") or {})


def load_batch_specs(text_or_path: str) -> dict[str, dict]:
    """Job specs (or any config mapping) from a JSON string, a JSON file or a YAML file."""
    suffix = next((x for x in (".yaml", ".yml", ".json") if text_or_path.lower().endswith(x)), None)
    if suffix is None:
        return json.loads(text_or_path)
    text = Path(text_or_path).read_text()  # a missing file says so
    if suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as err:  # pragma: no cover - optional dependency
        raise RuntimeError("YAML job files need PyYAML") from err
    return yaml.safe_load(text)
