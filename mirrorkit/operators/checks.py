"""Checks of a table definition against the table's data.

A definition states the smallest year, whether the table has a status column
and whether it has a chunk key. ``definition_profile`` measures those facts
in one scan (one row per table, partial aggregation on the map side);
``definition_findings`` compares them with the definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorkit.functions.columns import source_column
from mirrorkit.functions.fixed import DEFAULT_CUR, KEY_COLUMN, STATUS_COLUMN, YEAR_COLUMN


def definition_profile(
    df: DataFrame,
    table: str,
    *,
    expected_cur: Sequence[str] = DEFAULT_CUR,
) -> DataFrame:
    """One row: rows, year range, null counts, rows outside the expected status set.

    Columns the table lacks are reported as null counts of null.
    """
    names = {c.lower(): c for c in df.columns}

    def col(name):
        return source_column(names[name]) if name in names else None

    year, key, cur = col(YEAR_COLUMN), col(KEY_COLUMN), col(STATUS_COLUMN)
    aggs = [
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("rows"),
        (F.min(year) if year is not None else F.lit(None).cast("int")).alias("min_year"),
        (F.max(year) if year is not None else F.lit(None).cast("int")).alias("max_year"),
        (F.count_if(year.isNull()) if year is not None else F.lit(None).cast("long")).alias("null_year_rows"),
        (F.count_if(key.isNull()) if key is not None else F.lit(None).cast("long")).alias("null_key_rows"),
        (F.count_if(cur.isNull()) if cur is not None else F.lit(None).cast("long")).alias("null_cur_rows"),
        (F.count_if(~cur.isin(list(expected_cur))) if cur is not None
         else F.lit(None).cast("long")).alias("unexpected_cur_rows"),
    ]
    return df.agg(*aggs)


def definition_findings(profile_row, definition) -> list[str]:
    """Differences between one profile row and a ``TableDefinition``."""
    found = []
    if definition.min_year is not None and profile_row["min_year"] is not None:
        if profile_row["min_year"] < definition.min_year:
            found.append(f"data starts in {profile_row['min_year']}, definition says {definition.min_year}")
    if definition.has_cur and profile_row["null_cur_rows"] is None:
        found.append("definition has a status column, table has none")
    if not definition.has_cur and profile_row["null_cur_rows"] is not None:
        found.append("table has a status column the definition does not declare")
    if definition.has_parid and profile_row["null_key_rows"] is None:
        found.append("definition has a chunk key, table has none")
    if profile_row["unexpected_cur_rows"]:
        found.append(f"{profile_row['unexpected_cur_rows']} rows outside the default status set")
    return found
