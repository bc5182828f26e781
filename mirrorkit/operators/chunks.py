"""Chunk predicates: the units of a parallel source scan.

A chunk is a boolean SQL expression; a chunked scan runs one query per chunk
and concatenates the results (``UNION ALL``). So a row matching no chunk is
lost and a row matching two is duplicated. This module builds chunk lists,
derives balanced half-open ones from exact key counts, and measures coverage
and balance. All measurements are one scan with a map-side partial aggregate.

Lists built here are ``ChunkList``: they know whether every row is in exactly
one chunk (then a chunked scan in Spark needs no test at all) and how to find
a row's chunk by binary search instead of testing every predicate. They also
know which values their predicates compare a row with: the check of a long
list tests every predicate once for all rows between two of these values.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable, Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from mirrorkit.session import ensure_checkpoint_dir


#: Lists up to this length are tested predicate by predicate on every row.
FEW_CHUNKS = 64


class ChunkList(tuple):
    """Chunk predicates with what is known about them.

    ``covering``: every row, whatever its key, satisfies exactly one.
    ``locate``: builds the id column of the one chunk a row satisfies (null
    for none); only for lists in which no two chunks overlap.
    ``compared``: the column, and the ascending values that the predicates
    compare it with, when (in Spark) they do nothing else.
    """

    covering: bool
    locate: Callable[[], Column] | None
    compared: tuple[str, list] | None

    def __new__(cls, predicates: Iterable[str], covering: bool = False, locate: Callable[[], Column] | None = None,
                compared: tuple[str, list] | None = None) -> "ChunkList":
        made = super().__new__(cls, predicates)
        made.covering = covering
        made.locate = locate
        made.compared = compared
        return made


def sql_literal(value, dialect: str = "spark") -> str:
    """Render a bound as a SQL literal of its type.

    Quotes are doubled. Backslashes are doubled for ``dialect="spark"`` only:
    Spark reads them as escapes, most databases (``"ansi"``) do not.
    """
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        text = value.replace("\\", "\\\\") if dialect == "spark" else value
        return "'" + text.replace("'", "''") + "'"
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, (int, Decimal)):
        return str(value)
    raise ValueError(f"no SQL literal for {type(value).__name__}")


def sql_name(column: str, dialect: str = "spark") -> str:
    """A column name as SQL text; quoted unless it is a plain identifier."""
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", column):
        return column
    mark = "`" if dialect == "spark" else '"'
    return mark + column.replace(mark, mark * 2) + mark


def _named(column: str) -> Column:
    return F.col(sql_name(column))


def _search(key: Column, bounds: Sequence, low: int, high: int) -> Column:
    """Number of ``bounds[low:high]`` at or below ``key``, plus ``low``: a binary decision tree."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key < F.lit(bounds[middle]), _search(key, bounds, low, middle)).otherwise(
        _search(key, bounds, middle + 1, high))


def inclusive_range_chunks(
    column: str, width: int, count: int, *, digits: int = 14, start: int = 0
) -> ChunkList:
    """Hand-kept style list: ``count`` inclusive BETWEEN ranges of zero-padded
    numeric text keys, then "outside all ranges", then ``IS NULL``.

    Inclusive text ranges leave gaps: a key such as ``...2499A`` sorts after
    ``...2499`` and before ``...2500``, so no chunk takes it.
    """
    if width <= 0 or count <= 0:
        raise ValueError("width and count must be positive")
    name = sql_name(column)

    def key(n: int) -> str:
        return f"{n:0{digits}d}"

    lows = [key(start + i * width) for i in range(count)]
    highs = [key(start + (i + 1) * width - 1) for i in range(count)]
    chunks = [f"{name} BETWEEN {sql_literal(lo)} AND {sql_literal(hi)}" for lo, hi in zip(lows, highs)]
    chunks.append(f"{name} NOT BETWEEN {sql_literal(lows[0])} AND {sql_literal(highs[-1])}")
    chunks.append(f"{name} IS NULL")

    def locate() -> Column:
        value = _named(column)
        at = _search(value, lows, 0, count) - 1
        inside = F.when(value <= F.element_at(F.array(*[F.lit(h) for h in highs]), at + 1), at)
        return F.when(value.isNull(), F.lit(count + 1)).when(
            (value < lows[0]) | (value > highs[-1]), F.lit(count)).otherwise(inside)

    ordered = lows == sorted(lows) and highs == sorted(highs)  # as text: not beyond ``digits`` digits
    return ChunkList(chunks, locate=locate if ordered else None,
                     compared=(column, sorted({*lows, *highs})) if ordered else None)


def half_open_chunks(column: str, bounds: Sequence, dialect: str = "spark") -> ChunkList:
    """Chunks from sorted distinct bounds ``b1 < ... < bn``.

    ``column < b1``, ``b1 <= column < b2``, ..., ``column >= bn``, ``IS NULL``:
    open at both ends, so every row, whatever its key, is in exactly one chunk.
    """
    name = sql_name(column, dialect)
    ordered = sorted(set(bounds))
    lits = [sql_literal(b, dialect) for b in ordered]
    if ordered:
        chunks = [f"{name} < {lits[0]}"]
        chunks += [f"{name} >= {lo} AND {name} < {hi}" for lo, hi in zip(lits, lits[1:])]
        chunks.append(f"{name} >= {lits[-1]}")
    else:
        chunks = [f"{name} IS NOT NULL"]
    chunks.append(f"{name} IS NULL")

    def locate() -> Column:
        return F.when(_named(column).isNull(), F.lit(len(ordered) + 1)).otherwise(
            _search(_named(column), ordered, 0, len(ordered)))

    # Spark may read a literal written for a database otherwise (backslashes).
    return ChunkList(chunks, covering=True, locate=locate, compared=(column, ordered) if dialect == "spark" else None)


def _cumulative(counts: DataFrame, group: list[str], key: str) -> DataFrame:
    """Adds ``before``: rows of the group with a smaller key.

    ``counts`` has a row per (group, key) with ``n``. Keys are dealt to tasks
    by range; running sums inside a range get the sum of the ranges before it,
    so no task sees all keys and the result does not depend on the dealing.
    """
    ranged = counts.repartitionByRange(*group, key).withColumn("range", F.spark_partition_id()).checkpoint(eager=True)
    earlier = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*group, "range").agg(F.sum("n").alias("range_n")).withColumn(
        "first", F.coalesce(F.sum("range_n").over(earlier), F.lit(0))).drop("range_n")
    # A group may be null (the null key is split like any other).
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*group, "range"]]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    joined = ranged.alias("r").join(sums.alias("s"), condition).select("r.*", "s.first")
    inside = Window.partitionBy(*group, "range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn("before", F.col("first") + F.coalesce(F.sum("n").over(inside), F.lit(0))).drop("first", "range")


def _key_counts(df: DataFrame, column: str) -> DataFrame:
    """``(key, n)`` over all rows, null key included: one scan, combined before the shuffle."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.groupBy(_named(column).alias("key")).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)


def derive_chunk_bounds(df: DataFrame, column: str, chunks: int, *, exclude: Sequence = ()) -> DataFrame:
    """Exact lower bounds of ``chunks`` row-balanced ranges of ``column``.

    ``(part, lower)``: a key belongs to part ``floor(rows before it * chunks /
    rows)``, counting rows with a non-null key (and not in ``exclude``);
    ``lower`` is the least key of the part. The table is read once. The
    smallest lower bound is the open start.
    """
    if chunks < 1:
        raise ValueError("chunks must be >= 1")
    return _bounds(_key_counts(df, column), chunks, exclude)


def _bounds(counts: DataFrame, chunks: int, exclude: Sequence = ()) -> DataFrame:
    cold = counts.where(F.col("key").isNotNull())
    if exclude:
        cold = cold.where(~F.col("key").isin(list(exclude)))
    total = cold.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    placed = _cumulative(cold.withColumn("all", F.lit(1)), ["all"], "key")
    part = F.floor(F.col("before") * F.lit(chunks) / F.lit(max(1, total))).cast("int")
    return placed.groupBy(part.alias("part")).agg(F.min("key").alias("lower"))


def derived_chunks(
    df: DataFrame,
    column: str,
    chunks: int,
    *,
    split_column: str | None = None,
    dialect: str = "spark",
) -> ChunkList:
    """Balanced half-open chunk predicates for ``column``; every row in exactly one.

    Without ``split_column`` a key that holds many rows stays inside one range
    (a range predicate cannot divide one key value). With it, every key with
    more rows than one chunk should have (the null key included) gets its own
    chunks, split by half-open ranges of ``split_column``, and the range a hot
    key lies in excludes it. All counts are exact. At most ``chunks`` keys can
    be hot, and only bounds reach the driver: a few per chunk.
    """
    if chunks < 1:
        raise ValueError("chunks must be >= 1")
    counts = _key_counts(df, column)
    if split_column is None:
        lowers = sorted(r["lower"] for r in _bounds(counts, chunks).collect())
        return half_open_chunks(column, lowers[1:], dialect)

    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    per_chunk = max(1, total // chunks)
    hot = {r["key"]: r["n"] for r in counts.where(F.col("n") > per_chunk).collect()}
    hot_values = sorted(k for k in hot if k is not None)
    cold_rows = total - sum(hot.values())
    lowers = sorted(r["lower"] for r in _bounds(
        counts, max(1, min(chunks, -(-cold_rows // per_chunk))), hot_values).collect())

    name = sql_name(column, dialect)
    bounds = lowers[1:]
    ranges = list(half_open_chunks(column, bounds, dialect)[:-1])  # without its IS NULL chunk
    for value in hot_values:
        at = sum(b <= value for b in bounds)
        ranges[at] += f" AND {name} <> {sql_literal(value, dialect)}"

    # One aggregate over the rows of all hot keys, whatever their number.
    inner: dict = {}
    if hot:
        is_hot = _named(column).isin(hot_values) if hot_values else F.lit(False)
        if None in hot:
            is_hot = F.coalesce(is_hot, F.lit(False)) | _named(column).isNull()
        parts = {k: -(-n // per_chunk) for k, n in hot.items()}
        sizes = F.broadcast(df.sparkSession.createDataFrame(
            [(k, n, parts[k]) for k, n in hot.items()], counts.select("key", "n").schema.add("parts", "long")
        ).withColumnsRenamed({"key": "h_key", "n": "h_n"}))  # at most ``chunks`` rows
        pairs = df.where(is_hot).groupBy(_named(column).alias("key"), _named(split_column).alias("split")).agg(
            F.count(F.lit(1)).alias("n")).where(F.col("split").isNotNull())
        placed = _cumulative(pairs, ["key"], "split").join(sizes, F.col("key").eqNullSafe(F.col("h_key")))
        part = F.floor(F.col("before") * F.col("parts") / F.col("h_n"))
        for r in placed.groupBy("key", part.alias("part")).agg(F.min("split").alias("lower")).collect():
            inner.setdefault(r["key"], []).append(r["lower"])

    def split(key_predicate: str, key) -> list[str]:
        return [f"{key_predicate} AND ({p})"
                for p in half_open_chunks(split_column, sorted(inner.get(key, []))[1:], dialect)]

    result = list(ranges)
    for key in hot_values:
        result += split(f"{name} = {sql_literal(key, dialect)}", key)
    if None in hot:
        result += split(f"{name} IS NULL", None)
    else:
        result.append(f"{name} IS NULL")
    return ChunkList(result, covering=True)


def chunk_ids(predicates: Sequence[str]) -> Column:
    """Array of the ids of every chunk the row satisfies (empty when none)."""
    if not predicates:
        raise ValueError("no chunk predicates")
    locate = getattr(predicates, "locate", None)
    if locate is not None:
        return F.array_compact(F.array(locate()))
    return F.array_compact(F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)]))


def chunk_hits(predicates: Sequence[str]) -> Column:
    """Number of chunks the row satisfies (int); 1 for every row of a sound list.

    Every predicate is tested as it stands, also those of a ``ChunkList``:
    this is the check of a list. The sum is flat, so long lists are no deep
    expression, and a long list is built as one text.
    """
    if len(predicates) <= FEW_CHUNKS:
        tests = F.array(*[F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in predicates])
    else:
        tests = F.expr("array(" + ", ".join(f"coalesce(CAST(({p}\n) AS INT), 0)" for p in predicates) + ")")
    return F.aggregate(tests, F.lit(0), lambda total, hit: total + hit) if predicates else F.lit(0)


def chunked_scan(
    df: DataFrame, predicates: Sequence[str] | None, chunk_column: str | None = None
) -> DataFrame:
    """Rows as a per-chunk scan returns them, in one pass over ``df``.

    Equal to ``UNION ALL`` of ``df.where(p)`` over the chunks: a row appears
    once per chunk it satisfies. ``chunk_column`` keeps the chunk id.
    ``None`` predicates mean an unchunked scan, and so does a list in which
    every row is known to be in exactly one chunk.
    """
    if predicates is None or (getattr(predicates, "covering", False) and chunk_column is None):
        return df
    name = chunk_column or "__chunk"
    locate = getattr(predicates, "locate", None)
    if locate is not None:  # at most one chunk per row
        found = df.withColumn(name, locate()).where(F.col(name).isNotNull())
    else:
        found = df.withColumn(name, F.explode(chunk_ids(predicates)))
    return found if chunk_column else found.drop(name)


def _ordered_alike(df: DataFrame, t: DataType, values: Sequence) -> bool:
    """Whether Spark surely orders ``values`` as they come, compared with a column of type ``t``."""
    if not all(a < b for a, b in zip(values, values[1:])):  # not so with NaN
        return False

    def all_of(*kinds) -> bool:
        return all(type(v) in kinds for v in values)

    if isinstance(t, NumericType):
        return all_of(int, float, Decimal) and all(v == v for v in values)
    if isinstance(t, (TimestampType, TimestampNTZType)):  # no clock changes
        return (all_of(_dt.datetime) and all(v.tzinfo is None for v in values)
                and df.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC")
    return (t == StringType() and all_of(str)) or (isinstance(t, DateType) and all_of(_dt.date))


def _cell(column: str, values: Sequence) -> Column:
    """Id of the row's cell: one for null, each of ``values``, and each range between, below and above them.

    Rows of a cell compare alike with every value. Binary search in the array
    of the values; ``i`` of them are known to be at or below the key.
    """
    name = sql_name(column)
    if not values:
        return F.expr(f"if({name} IS NULL, -1, 0)")
    steps = ", ".join(str(2**k) for k in reversed(range(len(values).bit_length())))
    listed = f"array({', '.join(sql_literal(v) for v in values)})"
    # The key is bound as ``k``, so that it is computed once a row.
    return F.expr(
        f"transform(array({name}), k -> if(k IS NULL, -1, aggregate(array({steps}), 0, "
        f"(i, s) -> if(get({listed}, i + s - 1) <= k, i + s, i), "
        f"i -> 2 * i + if(get({listed}, i - 1) = k, 1, 0))))[0]")


def chunk_coverage(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """``(hits, n)``: how many rows satisfy 0, 1, 2, ... chunks.

    Every predicate is tested as it stands: on every row or, in long lists
    known to compare one column with given values and nothing else, on one row
    of each cell (see ``_cell``), which counts for all its rows. So the cost
    of a row does not grow with the list.
    """
    compared = getattr(predicates, "compared", None)
    if compared is not None and len(predicates) > FEW_CHUNKS:
        column, values = compared
        key = _named(column)
        if _ordered_alike(df, df.select(key).schema[0].dataType, values):
            cells = df.groupBy(_cell(column, values).alias("__cell")).agg(
                F.min(key).alias(column), F.count(F.lit(1)).alias("__n"))
            return (
                cells.select(chunk_hits(predicates).alias("hits"), "__n")
                .groupBy("hits")
                .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"))
            )
    return (
        df.select(chunk_hits(predicates).alias("hits"))
        .groupBy("hits")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def chunk_counts(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """``(chunk, n)``: rows each chunk returns (chunks returning none are absent)."""
    return (
        chunked_scan(df, predicates, "chunk")
        .groupBy("chunk")
        .agg(F.count(F.lit(1)).alias("n"))
    )
