"""Normalisation of an extracted table: names, types, load stamp.

Every step is a single projection; Catalyst merges them with the scan, so a
normalised extract is still one pass with the filter pushed into the source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorkit.functions.columns import (
    load_stamp,
    source_column,
    narrow_decimal,
    narrowing_overflowed,
    timestamp_text,
)
from mirrorkit.functions.fixed import LOADED_AT_COLUMN
from mirrorkit.functions.types import is_timestamp, is_unscaled_number, merge_overrides


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case; two names that collide are an error."""
    lowered = [name.lower() for name in df.columns]
    seen: set[str] = set()
    clashes = sorted({name for name in lowered if name in seen or seen.add(name)})
    if clashes:
        raise ValueError(f"columns collide after lowercasing: {clashes}")
    renames = {name: name.lower() for name in df.columns if name != name.lower()}
    return df.withColumnsRenamed(renames) if renames else df


def apply_overrides(df: DataFrame, overrides: Mapping[str, str] | None) -> DataFrame:
    """Cast overridden columns to their declared type (file sources).

    Names match case-insensitively and names the table lacks are ignored, as
    with the JDBC ``customSchema`` option. On a JDBC extract the reader has
    already applied the types, and the cast to the same type is removed by
    the optimizer.
    """
    wanted = merge_overrides(overrides)
    casts = {
        name: source_column(name).cast(wanted[name.lower()])
        for name in df.columns
        if name.lower() in wanted
    }
    return df.withColumns(casts) if casts else df


def conversion_targets(df: DataFrame, overrides: Mapping[str, str] | None) -> tuple[list[str], list[str]]:
    """(timestamp columns, unscaled-number columns) that the default rules convert."""
    exempt = set(merge_overrides(overrides))
    stamps, numbers = [], []
    for field in df.schema.fields:
        if field.name.lower() in exempt:
            continue
        if is_timestamp(field.dataType):
            stamps.append(field.name)
        elif is_unscaled_number(field.dataType):
            numbers.append(field.name)
    return stamps, numbers


def prepare(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Names and declared types only: lowercase, then apply overrides."""
    return apply_overrides(lowercase_columns(df), overrides)


def narrow_numbers(
    df: DataFrame,
    overrides: Mapping[str, str] | None = None,
    *,
    overflow_column: str | None = None,
) -> DataFrame:
    """The shrinking type rule: DECIMAL(38,10) to DECIMAL(10,0), null on overflow.

    ``overflow_column`` adds an int column holding, per row, how many values
    overflowed, so a writer can count them without a second pass.
    """
    _, numbers = conversion_targets(df, overrides)
    converted: dict[str, Column] = {name: narrow_decimal(source_column(name)) for name in numbers}
    if overflow_column:
        # Computed from the same input row as the narrowing (one projection).
        total = F.lit(0)
        for name in numbers:
            total = total + F.when(narrowing_overflowed(source_column(name)), 1).otherwise(0)
        converted[overflow_column] = total
    return df.withColumns(converted) if converted else df


def render_text(df: DataFrame, overrides: Mapping[str, str] | None = None, *, stamp: bool = True) -> DataFrame:
    """The widening rules: timestamps (both flavours) to ``yyyy-MM-dd HH:mm:ss.SSS``
    text, plus the ``loaded_at`` stamp."""
    stamps, _ = conversion_targets(df, overrides)
    converted: dict[str, Column] = {name: timestamp_text(source_column(name)) for name in stamps}
    if stamp:
        converted[LOADED_AT_COLUMN] = load_stamp()
    return df.withColumns(converted) if converted else df


def convert(
    df: DataFrame,
    overrides: Mapping[str, str] | None = None,
    *,
    stamp: bool = True,
    overflow_column: str | None = None,
) -> DataFrame:
    """Default type rules and the load stamp on a prepared frame.

    * timestamps (both flavours) become ``yyyy-MM-dd HH:mm:ss.SSS`` text;
    * DECIMAL(38,10) becomes DECIMAL(10,0), with null on overflow;
    * a column with any override keeps its declared type instead.

    A writer applies the two halves on either side of its exchange:
    ``narrow_numbers`` before (rows shrink), ``render_text`` after (rows grow).
    """
    narrowed = narrow_numbers(df, overrides, overflow_column=overflow_column)
    return render_text(narrowed, overrides, stamp=stamp)


def normalize(
    df: DataFrame,
    overrides: Mapping[str, str] | None = None,
    *,
    stamp: bool = True,
    overflow_column: str | None = None,
) -> DataFrame:
    """Lowercase names, apply overrides, convert types, add ``loaded_at``."""
    return convert(prepare(df, overrides), overrides, stamp=stamp, overflow_column=overflow_column)
