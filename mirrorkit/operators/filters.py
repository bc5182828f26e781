"""Year-range and status filters of a mirror job.

Predicates are Column expressions on the lowercased names, so Spark pushes
them into the source: a JDBC source gets them appended to every chunk's
``WHERE``; a Parquet source gets them as ``PushedFilters``. Null year or
status values fail an active filter (three-valued logic), even under the
all-values default.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorkit.functions.fixed import STATUS_COLUMN, YEAR_COLUMN


def year_range(lo: int, hi: int, column: str = YEAR_COLUMN) -> Column:
    """Inclusive ``column BETWEEN lo AND hi``."""
    return F.col(column).between(lo, hi)


def status_in(values: Iterable[str], column: str = STATUS_COLUMN) -> Column:
    """``column IN (...)``; values are bound as literals, never spliced into SQL."""
    return F.col(column).isin(list(values))


def conjunction(predicates: Sequence[Column]) -> Column | None:
    """AND of the active predicates; ``None`` when there are none."""
    if not predicates:
        return None
    return reduce(lambda a, b: a & b, predicates)


def job_predicate(
    years: tuple[int, int] | None,
    cur: Sequence[str] | None,
) -> Column | None:
    """The filter of a job: year range and/or status set, or ``None`` for no filter."""
    active = []
    if years is not None:
        active.append(year_range(*years))
    if cur is not None:
        active.append(status_in(cur))
    return conjunction(active)


def apply_predicate(df: DataFrame, predicate: Column | None) -> DataFrame:
    """Filter only when there is something to filter on."""
    return df if predicate is None else df.where(predicate)
