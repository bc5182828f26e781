"""Chunk bounds computed by the source database.

``operators.chunks.derived_chunks`` counts the keys of a table that Spark can
read, for example the previous mirror. For a first extract there is none; then
the database counts. The queries here are plain SQL (grouped counts and window
sums, which databases have), and only bounds come back: a row per chunk, never
keys. Bounds are compared by the database alone, so its own text order
(collation) decides both where they lie and which rows a chunk takes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from mirrorkit.operators.chunks import ChunkList, half_open_chunks, sql_literal, sql_name

Rows = Iterable[tuple]


def _keys(table: str, name: str) -> str:
    return f"SELECT {name} AS k, COUNT(*) AS n FROM {table} WHERE {name} IS NOT NULL GROUP BY {name}"


def _hot(n: str, chunks: int, total: str) -> str:
    """More rows than one chunk should have."""
    return f"{n} * {chunks} > {total}"


def bounds_sql(table: str, column: str, chunks: int, *, without_hot: bool = False, dialect: str = "ansi") -> str:
    """(part, lower) of row-balanced ranges: a key is in part floor(rows before it * chunks / rows).

    ``without_hot`` leaves out keys with more rows than a chunk of all rows.
    """
    counts = _keys(table, sql_name(column, dialect))
    if without_hot:
        every = f"(SELECT COUNT(*) FROM {table})"
        counts = f"SELECT k, n FROM ({counts}) c WHERE NOT {_hot('n', chunks, every)}"
    placed = (f"SELECT k, SUM(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before, "
              f"SUM(n) OVER () AS total FROM ({counts}) c")
    return (f"SELECT part, MIN(k) AS lower FROM (SELECT k, FLOOR(before * {chunks} / total) AS part FROM ({placed}) p) q "
            "GROUP BY part ORDER BY part")


def hot_sql(table: str, column: str, chunks: int, dialect: str = "ansi") -> str:
    """(k, n, total) of the keys, null included, with more rows than one chunk should have: at most ``chunks``."""
    name = sql_name(column, dialect)
    return (f"SELECT k, n, total FROM (SELECT {name} AS k, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total FROM {table} "
            f"GROUP BY {name}) c WHERE {_hot('n', chunks, 'total')} ORDER BY k")


def split_sql(table: str, column: str, split_column: str, key, parts: int, dialect: str = "ansi") -> str:
    """(part, lower) of ``parts`` row-balanced ranges of ``split_column`` over the rows of one key."""
    name = sql_name(column, dialect)
    one = f"{name} IS NULL" if key is None else f"{name} = {sql_literal(key, dialect)}"
    return bounds_sql(f"(SELECT {sql_name(split_column, dialect)} FROM {table} WHERE {one}) s", split_column, parts, dialect=dialect)


def chunks_from_source(run_sql: Callable[[str], Rows], table: str, column: str, chunks: int, *,
                       split_column: str | None = None, dialect: str = "ansi") -> ChunkList:
    """Balanced half-open chunks of ``column``, every row in exactly one, from queries that ``run_sql`` runs.

    With ``split_column``, keys that hold more rows than a chunk should (null
    too) get chunks of their own, as in ``derived_chunks``; one query for each.
    """
    if chunks < 1:
        raise ValueError("chunks must be >= 1")
    name = sql_name(column, dialect)

    def bounds(sql: str) -> list:
        return [lower for _, lower in run_sql(sql)][1:]  # in the database's order; the first part is open below

    if split_column is None:
        return half_open_chunks_in_order(column, bounds(bounds_sql(table, column, chunks, dialect=dialect)), dialect)
    hot = [(k, int(n), int(total)) for k, n, total in run_sql(hot_sql(table, column, chunks, dialect))]
    ranges = list(half_open_chunks_in_order(
        column, bounds(bounds_sql(table, column, chunks, without_hot=True, dialect=dialect)), dialect))
    others = " AND ".join(f"{name} <> {sql_literal(k, dialect)}" for k, _, _ in hot if k is not None)
    found = [f"({p}) AND {others}" if others else p for p in ranges[:-1]]
    for key, n, total in hot:
        parts = -(-n * chunks // total)
        one = f"{name} IS NULL" if key is None else f"{name} = {sql_literal(key, dialect)}"
        inner = bounds(split_sql(table, column, split_column, key, parts, dialect))
        found += [f"{one} AND ({p})" for p in half_open_chunks_in_order(split_column, inner, dialect)]
    if all(key is not None for key, _, _ in hot):
        found.append(f"{name} IS NULL")
    return ChunkList(found, covering=True)


def half_open_chunks_in_order(column: str, bounds: list, dialect: str) -> ChunkList:
    """``half_open_chunks`` of bounds that come in the source's order, which may not be Spark's."""
    name = sql_name(column, dialect)
    if not bounds:
        return half_open_chunks(column, [], dialect)
    texts = [sql_literal(b, dialect) for b in bounds]
    found = [f"{name} < {texts[0]}", *[f"{name} >= {a} AND {name} < {b}" for a, b in zip(texts, texts[1:])], f"{name} >= {texts[-1]}"]
    return ChunkList([*found, f"{name} IS NULL"], covering=True)
