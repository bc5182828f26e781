"""Type rules of the mirror and the schema-override hierarchy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from mirrorkit.functions.fixed import UNSCALED_SOURCE_DECIMAL


def is_timestamp(data_type: DataType) -> bool:
    """True for both timestamp flavours.

    JDBC sources arrive as ``TimestampType``; Parquet written without a zone
    reads back as ``TimestampNTZType``. Both get the text conversion.
    """
    return isinstance(data_type, (TimestampType, TimestampNTZType))


def is_unscaled_number(data_type: DataType) -> bool:
    """Only DECIMAL(38,10), the type an unscaled source NUMBER maps to, is narrowed."""
    precision, scale = UNSCALED_SOURCE_DECIMAL
    return (
        isinstance(data_type, DecimalType)
        and data_type.precision == precision
        and data_type.scale == scale
    )


def merge_overrides(*layers: Mapping[str, str] | None) -> dict[str, str]:
    """Merge override layers; later layers win (global, then table).

    Keys are lowercased because overrides are matched against the lowercased
    column names of the mirror.
    """
    merged: dict[str, str] = {}
    for layer in layers:
        for name, type_text in (layer or {}).items():
            if not isinstance(type_text, str) or not type_text.strip():
                raise ValueError(f"override for {name!r} must be a type string")
            merged[name.lower()] = type_text.strip()
    return merged


def overrides_ddl(overrides: Mapping[str, str]) -> str:
    """``{"a": "INT", "b": "STRING"}`` -> ``"`a` INT, `b` STRING"`` (JDBC customSchema)."""
    return ", ".join(f"`{name.replace('`', '``')}` {type_text}" for name, type_text in overrides.items())


# Whole-number types by rising width, with their decimal digits.
_WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
_MAX_DIGITS = 38


def _as_decimal(data_type: DataType) -> DecimalType | None:
    if isinstance(data_type, DecimalType):
        return data_type
    return DecimalType(_WHOLE[data_type], 0) if data_type in _WHOLE else None


def least_common_type(a: DataType, b: DataType) -> DataType:
    """The least type that holds every value of both, text if no other does.

    A lattice: commutative, associative up to that top element, idempotent.
    Nested types that differ have no common type.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.get)
    x, y = _as_decimal(a), _as_decimal(b)
    if x is not None and y is not None:
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return DecimalType(digits, scale) if digits <= _MAX_DIGITS else StringType()
    if {type(a), type(b)} == {FloatType, DoubleType}:
        return DoubleType()
    for real, other in ((a, b), (b, a)):
        if isinstance(real, (FloatType, DoubleType)) and other in _WHOLE:
            exact = 5 if isinstance(real, FloatType) else 10  # digits that a float or double holds
            return real if _WHOLE[other] <= exact else DoubleType() if _WHOLE[other] <= 10 else StringType()
    for when, other in ((a, b), (b, a)):
        if isinstance(when, DateType) and isinstance(other, TimestampNTZType):
            return other
    atomic = (StringType, DecimalType, FloatType, DoubleType, DateType, TimestampType, TimestampNTZType)
    if all(isinstance(t, atomic) or t in _WHOLE or t.typeName() == "boolean" for t in (a, b)):
        return StringType()
    raise ValueError(f"no common type for {a.simpleString()} and {b.simpleString()}")


def merged_schema(schemas: Sequence[StructType]) -> StructType:
    """Columns of the first schema, then those only later ones have, each of its least common type."""
    types: dict[str, list[DataType]] = {}
    for schema in schemas:
        for f in schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    return StructType([StructField(name, reduce(least_common_type, found), True) for name, found in types.items()])
