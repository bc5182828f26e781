"""Positions in a global order, without a task that sees all rows.

Rows are dealt to tasks by ranges of the order, sorted inside their range and
numbered there; the rows of earlier ranges are added. Only one count per range
reaches the driver. The order must end in columns that tell equal rows apart
(a file offset, a key): then many rows with one leading value are many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorkit.session import ensure_checkpoint_dir

_RANGE, _AT, _SHIFT = "__range", "__at", "__shift"


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with a gapless ``bigint`` position from 0 in ``order`` (computed once, now)."""
    ensure_checkpoint_dir(df.sparkSession)
    numbered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_AT, F.monotonically_increasing_id())
    numbered = numbered.withColumn(_RANGE, F.shiftright(_AT, 33)).checkpoint(eager=True)  # fixes the ranges
    sizes = numbered.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"), F.min(_AT).alias("first")).orderBy(_RANGE).collect()
    before = [0, *accumulate(r["n"] for r in sizes)]
    shifts = df.sparkSession.createDataFrame(
        [(r[_RANGE], b - r["first"]) for r, b in zip(sizes, before)], f"{_RANGE} bigint, {_SHIFT} bigint")
    # A row per task of the sort, so the side that is broadcast is bounded by the number of ranges.
    return numbered.join(F.broadcast(shifts), _RANGE).withColumn(name, F.col(_AT) + F.col(_SHIFT)).drop(_RANGE, _AT, _SHIFT)
