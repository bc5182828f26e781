"""Narrowest lossless column types, found in one aggregate, as overrides.

Each value has a least type that holds it without loss; a column's type is the
join of its values' types. The join of what is measured per value (largest
magnitude, decimals needed, whether a text survives the round trip through a
type) is a maximum or a conjunction, so it is merged in each scan task before
anything is shuffled, and one row reaches the end.

Rules, by declared type: whole numbers get the narrowest whole type; decimals
the digits and the decimals in use; floating-point numbers that are all whole
get a whole type; timestamps at midnight a date; text a whole type, date or
boolean if every value reads back as the same text. A column without values,
and any other type, stays as it is. Null never counts against a type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, TimestampNTZType, TimestampType,
)

from mirrorkit.functions.columns import source_column

_WHOLE = (("TINYINT", 2**7), ("SMALLINT", 2**15), ("INT", 2**31), ("BIGINT", 2**63))
_WHOLE_TYPES = (ByteType, ShortType, IntegerType, LongType)
#: Doubles hold all whole numbers below this.
_EXACT = 2**53


def _whole_type(low: Column, high: Column) -> Column:
    out = F.lit("BIGINT")
    for name, limit in reversed(_WHOLE[:-1]):
        out = F.when((low >= -limit) & (high < limit), name).otherwise(out)
    return out


#: Every text that a cast from the type to text gives looks like this (and few others do).
_LOOKS = {
    "bigint": r"\A(0|-?[1-9][0-9]{0,18})\z",
    "date": r"\A[+-]?[0-9]{4,7}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])\z",
    "boolean": r"\A(true|false)\z",
}


def _same_text(c: Column, type_name: str, t: DataType) -> Column:
    """Whether a text reads back as it is. A cast that fails costs many times a
    cast that doesn't, so a text that can't be one of the type isn't cast."""
    same = F.coalesce(c.try_cast(type_name).cast("string") == c, F.lit(False))
    if t != StringType():  # under a collation other texts may be equal
        return same
    looks = c.rlike(_LOOKS[type_name])
    if type_name == "bigint":
        # Of 19 digits, text order is number order.
        digits = F.ltrim(c, F.lit("-"))
        limit = F.when(c.startswith("-"), str(2**63)).otherwise(str(2**63 - 1))
        looks = looks & ((F.length(digits) < 19) | (digits <= limit))
    return F.when(looks, same).otherwise(F.lit(False))


def _decimals(c: Column, t: DecimalType, low: int, high: int) -> Column:
    """Decimals in use, by binary search: the least ``k`` for which a value equals itself rounded to ``k`` decimals."""
    if low == high:
        return F.lit(low)
    k = (low + high) // 2
    # A rounded value that does not fit is another one.
    return F.when(F.round(c, k).try_cast(t).eqNullSafe(c), _decimals(c, t, low, k)).otherwise(_decimals(c, t, k + 1, high))


def _measures(c: Column, t: DataType) -> dict[str, Column]:
    """Aggregates over one column; each is merged from partial values."""
    if isinstance(t, _WHOLE_TYPES):
        return {"low": F.min(c).cast("bigint"), "high": F.max(c).cast("bigint")}
    if isinstance(t, DecimalType):
        return {"size": F.max(F.abs(c)), "used": F.max(F.when(c.isNotNull(), _decimals(c, t, 0, t.scale)))}
    if isinstance(t, (FloatType, DoubleType)):
        whole = F.coalesce((c == F.floor(c)) & (F.abs(c) < _EXACT) & ~((c == 0) & F.signum(c).cast("string").startswith("-")), F.lit(False))
        return {"fits": F.bool_and(F.when(c.isNotNull(), whole)),
                "low": F.min(F.when(whole, c.cast("bigint"))), "high": F.max(F.when(whole, c.cast("bigint")))}
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return {"fits": F.bool_and(F.date_trunc("day", c) == c)}
    if isinstance(t, StringType):
        number = F.when(_same_text(c, "bigint", t), c.try_cast("bigint"))
        return {"number": F.bool_and(F.when(c.isNotNull(), number.isNotNull())), "low": F.min(number), "high": F.max(number),
                "date": F.bool_and(F.when(c.isNotNull(), _same_text(c, "date", t))),
                "boolean": F.bool_and(F.when(c.isNotNull(), _same_text(c, "boolean", t)))}
    return {}


def _proposal(m: dict[str, Column], t: DataType) -> Column:
    """The type's name from the measures; null where nothing was measured."""
    declared = F.lit(t.simpleString().upper())
    if isinstance(t, _WHOLE_TYPES):
        return F.when(m["low"].isNotNull(), _whole_type(m["low"], m["high"]))
    if isinstance(t, DecimalType):
        digits = F.when(m["size"] < 1, 0).otherwise(F.length(F.floor(m["size"]).cast("string")))
        total = F.greatest(digits + m["used"], F.lit(1))
        return F.when(m["size"].isNotNull(), F.concat(F.lit("DECIMAL("), total.cast("string"), F.lit(","), m["used"].cast("string"), F.lit(")")))
    if isinstance(t, (FloatType, DoubleType)):
        return F.when(m["fits"].isNotNull(), F.when(m["fits"], _whole_type(m["low"], m["high"])).otherwise(declared))
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.when(m["fits"].isNotNull(), F.when(m["fits"], "DATE").otherwise(declared))
    if isinstance(t, StringType):
        return F.when(m["number"].isNotNull(), F.when(m["number"], _whole_type(m["low"], m["high"])).when(
            m["date"], "DATE").when(m["boolean"], "BOOLEAN").otherwise(declared))
    return F.lit(None).cast("string")


def type_profile(df: DataFrame) -> DataFrame:
    """(column, declared, proposed, nulls): a row per column; one scan, one aggregate."""
    measures, rows = {}, []
    for i, f in enumerate(df.schema.fields):
        c = source_column(f.name)
        for name, agg in _measures(c, f.dataType).items():
            measures[f"m{i}_{name}"] = agg
        measures[f"m{i}_nulls"] = F.count_if(c.isNull())
    found = df.agg(*[agg.alias(name) for name, agg in measures.items()])
    for i, f in enumerate(df.schema.fields):
        mine = {name.split("_", 1)[1]: F.col(name) for name in measures if name.startswith(f"m{i}_")}
        declared = f.dataType.simpleString().upper()
        rows.append(F.struct(F.lit(f.name.lower()).alias("column"), F.lit(declared).alias("declared"),
                             F.coalesce(_proposal(mine, f.dataType), F.lit(declared)).alias("proposed"), mine["nulls"].alias("nulls")))
    return found.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def proposed_overrides(df: DataFrame) -> dict[str, str]:
    """Overrides (see ``normalize``) for the columns whose narrowest type differs from the declared one."""
    return {r["column"]: r["proposed"] for r in type_profile(df).where("declared <> proposed").collect()}  # a row per column


def lost_values(df: DataFrame, overrides: dict[str, str]) -> DataFrame:
    """(column, lost): values that a cast to the override does not keep (null, or not equal when cast back)."""
    columns = [(f.name, f.dataType) for f in df.schema.fields if f.name.lower() in overrides]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, lost bigint")
    lost = [F.count_if(source_column(n).isNotNull() & ~source_column(n).try_cast(overrides[n.lower()]).cast(t).eqNullSafe(
        source_column(n))).alias(f"l{i}") for i, (n, t) in enumerate(columns)]
    rows = [F.struct(F.lit(n.lower()).alias("column"), F.col(f"l{i}").alias("lost")) for i, (n, _) in enumerate(columns)]
    return df.agg(*lost).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
