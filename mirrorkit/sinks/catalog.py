"""Catalog registration of a mirror, so SQL users can query it by name.

The table is external (``LOCATION`` is the mirror folder), so dropping and
re-creating its definition never touches data. ``sync_mirror_table`` creates
the table, re-creates it when the mirror's column types changed, adds the
partition folders the catalog lacks (``ADD PARTITION``) and makes cached
listings fresh (``REFRESH TABLE``).

Partitions written at different times can have different types. A Parquet file
cannot be read under another type than it was written with, so a table keeps
its types, and what does not fit them goes to a table of its own: the first
becomes ``<name>__s1`` (renamed, its partitions stay), the next ``<name>__s2``,
and ``<name>`` becomes a view that casts every column to the least type that
holds all of them (``functions.types.least_common_type``). A partition is in
one of these tables only; columns that come or go need no new table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mirrorkit.functions.types import merged_schema
from mirrorkit.sources.listing import file_manifest, qualified_path


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ordered_fields(schema: StructType, partitions: Sequence[str]):
    data = [f for f in schema.fields if f.name not in partitions]
    parts = sorted((f for f in schema.fields if f.name in partitions), key=lambda f: list(partitions).index(f.name))
    return data + parts


def _location(spark: SparkSession, name: str) -> str | None:
    """The storage location of a catalog table, as the catalog records it."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if row["col_name"] == "Location":
            return row["data_type"].rstrip("/")
    return None


def create_mirror_table(
    spark: SparkSession, name: str, path: str, schema: StructType, partitions: Sequence[str] = ()
) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY ... LOCATION``."""
    columns = ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in _ordered_fields(schema, partitions))
    partitioned = f" PARTITIONED BY ({', '.join(_quote(p) for p in partitions)})" if partitions else ""
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioned} LOCATION '{location}'"
    )


def _partition_spec(row, partitions: Sequence[str]) -> str:
    def value(v) -> str:
        return "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "(" + ", ".join(f"{_quote(p)} = {value(row[p])}" for p in partitions) + ")"


def _kind(spark: SparkSession, name: str) -> str | None:
    """``table``, ``view`` or None."""
    if not spark.catalog.tableExists(name):
        return None
    kinds = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Type"]
    return "view" if "VIEW" in kinds else "table"


def _generation(name: str, number: int) -> str:
    return f"{name}__s{number}"


def generations(spark: SparkSession, name: str) -> list[str]:
    """The tables behind a view over partitions of several types, oldest first."""
    found = []
    while spark.catalog.tableExists(_generation(name, len(found) + 1)):
        found.append(_generation(name, len(found) + 1))
    return found


def _agree(table: StructType, schema: StructType) -> bool:
    """Whether files of ``schema`` can be read under ``table``: columns both have are of one type."""
    types = {f.name: f.dataType for f in table.fields}
    return all(types.get(f.name, f.dataType) == f.dataType for f in schema.fields)


def _add_columns(spark: SparkSession, name: str, schema: StructType) -> bool:
    have = set(spark.table(name).columns)
    new = [f"{_quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    return bool(new)


def _locate(spark: SparkSession, name: str, partitions: Sequence[str], located: Sequence[tuple]) -> int:
    """Point partitions to their folders; return how many were added or moved."""
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    changed = 0
    for row, folder in located:
        spec, place = _partition_spec(row, partitions), folder.replace("'", "\\'")
        if row["partition_dir"] not in known:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION {spec} LOCATION '{place}'")
        elif _partition_location(spark, name, spec) != qualified_path(spark, folder):
            spark.sql(f"ALTER TABLE {name} PARTITION {spec} SET LOCATION '{place}'")
        else:
            continue
        changed += 1
    return changed


def _partition_location(spark: SparkSession, name: str, spec: str) -> str | None:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION {spec}").collect():
        if row["col_name"] == "Location":
            return row["data_type"].rstrip("/")
    return None


def _create_view(spark: SparkSession, name: str, partitions: Sequence[str]) -> None:
    tables = [t for t in reversed(generations(spark, name)) if spark.sql(f"SHOW PARTITIONS {t}").limit(1).count()]
    schemas = [spark.table(t).schema for t in tables]
    columns = _ordered_fields(merged_schema(schemas), partitions)
    parts = []
    for table, schema in zip(tables, schemas):
        have = schema.fieldNames()
        parts.append("SELECT " + ", ".join(
            f"CAST({_quote(f.name) if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {_quote(f.name)}"
            for f in columns) + f" FROM {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(parts)}")


def publish_locations(spark: SparkSession, name: str, location: str, schema: StructType, partitions: Sequence[str],
                      located: Sequence[tuple]) -> str:
    """Make partitions with types of ``schema`` part of the catalog table or view ``name``.

    ``located`` has (row with ``partition_dir`` and the partition values,
    folder) per partition; an unpartitioned table is the files at ``location``.
    Returns ``"created"``, ``"replaced"`` (types changed), ``"refreshed"`` or
    ``"unchanged"``. Safe to repeat.
    """
    kind = _kind(spark, name)
    if kind is None and not generations(spark, name):  # with them: a run that ended before it made the view
        create_mirror_table(spark, name, location, schema, partitions)
        if partitions:
            _locate(spark, name, partitions, located)
        return "created"
    if not partitions:
        if [(f.name, f.dataType) for f in spark.table(name).schema.fields] != [(f.name, f.dataType) for f in schema.fields]:
            spark.sql(f"DROP TABLE {name}")  # external: the files stay
            create_mirror_table(spark, name, location, schema)
            return "replaced"
        if _location(spark, name) == qualified_path(spark, location):
            return "unchanged"
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.sql(f"REFRESH TABLE {name}")
        return "refreshed"
    action = "refreshed"
    if kind == "table" and _agree(spark.table(name).schema, schema):
        changed = _add_columns(spark, name, schema) + _locate(spark, name, partitions, located)
        spark.sql(f"REFRESH TABLE {name}")
        return action if changed else "unchanged"
    if kind == "table":
        spark.sql(f"ALTER TABLE {name} RENAME TO {_generation(name, 1)}")
        action = "replaced"
    tables = generations(spark, name)
    fitting = [t for t in tables if _agree(spark.table(t).schema, schema)]
    if not fitting:
        fitting = [_generation(name, len(tables) + 1)]
        create_mirror_table(spark, fitting[0], location, schema, partitions)
        action = "replaced"
    target = fitting[-1]
    changed = _add_columns(spark, target, schema) + _locate(spark, target, partitions, located)
    for other in tables:
        if other != target:
            known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {other}").collect()}
            moved = [_partition_spec(r, partitions) for r, _ in located if r["partition_dir"] in known]
            for at in range(0, len(moved), 100):
                spark.sql(f"ALTER TABLE {other} DROP IF EXISTS " + ", ".join(f"PARTITION {m}" for m in moved[at : at + 100]))
            changed += len(moved)
    if changed or action == "replaced" or kind is None:
        for table in generations(spark, name):
            spark.sql(f"REFRESH TABLE {table}")
        _create_view(spark, name, partitions)
        return action
    return "unchanged"


def missing_partitions(spark: SparkSession, name: str, path: str, partitions: Sequence[str]) -> list:
    """Partition folders of the mirror that the catalog does not know, whoever wrote them."""
    folders = file_manifest(spark, path, partitions).select("partition_dir", *partitions).distinct()
    known = spark.sql(f"SHOW PARTITIONS {name}").select(F.col("partition").alias("partition_dir"))
    return folders.join(known, "partition_dir", "left_anti").orderBy("partition_dir").collect()


def refresh_mirror_table(spark: SparkSession, name: str, path: str, partitions: Sequence[str]) -> int:
    """Add the partitions the catalog lacks and drop cached listings; return how many were added."""
    missing = missing_partitions(spark, name, path, partitions) if partitions else []
    for at in range(0, len(missing), 100):
        specs = " ".join(f"PARTITION {_partition_spec(r, partitions)}" for r in missing[at : at + 100])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    spark.sql(f"REFRESH TABLE {name}")
    return len(missing)


def sync_mirror_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    partitions: Sequence[str] = (),
    touched: Sequence | None = None,
) -> str:
    """Bring the catalog entry in line with the mirror; return what was done.

    ``"created"``, ``"replaced"`` (column names, types or location changed),
    ``"refreshed"`` (partitions added) or ``"unchanged"``. What is missing is
    asked of the catalog, so a refresh that failed is made good by the next.

    ``touched`` names the partitions just written (rows with ``partition_dir``
    and the partition values). With it, a change of types leaves all others
    readable under theirs (see the module's head); without it, all files of the
    mirror are taken to be of ``schema``.
    """
    kind = _kind(spark, name)
    if touched is not None and partitions and (
            kind == "view" or generations(spark, name) or (kind == "table" and not _agree(spark.table(name).schema, schema))):
        return publish_locations(spark, name, path, schema, partitions,
                                 [(r, f"{path.rstrip('/')}/{r['partition_dir']}") for r in touched])
    wanted = [(f.name, f.dataType.simpleString()) for f in _ordered_fields(schema, partitions)]
    if kind is not None:
        current = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
        if current != wanted or _location(spark, name) != qualified_path(spark, path):
            spark.sql(f"DROP TABLE {name}")  # external: the files stay
            action = "replaced"
        else:
            return "refreshed" if refresh_mirror_table(spark, name, path, partitions) else "unchanged"
    else:
        action = "created"
    create_mirror_table(spark, name, path, schema, partitions)
    refresh_mirror_table(spark, name, path, partitions)
    return action
