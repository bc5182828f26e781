"""Helpers shared by the operators: written intermediate tables and table reads."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from mirrorkit.session import work_dir
from mirrorkit.sources.listing import delete_path

#: Folders of the tables written in this process, oldest first.
_MADE: list[str] = []


def written(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage in a way that survives lost executors, and fixes the outcome
    of anything that depends on how rows were dealt to tasks.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    _MADE.append(path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OWNER: str | None = None
_CACHES: dict = {}


def worker_caches(owner: str) -> dict:
    """What an operator keeps in a Python worker between tasks.

    Workers outlive tasks and serve one operator after another; what the
    former operator kept is dropped when the next one starts.
    """
    global _OWNER
    if owner != _OWNER:
        _CACHES.clear()
        _release_memory()
        _OWNER = owner
    return _CACHES


def _release_memory() -> None:
    """Give freed memory back to the system: workers stay, and share an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_batches(df: DataFrame, run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` that gives freed memory back at the end of each task."""
    def task(batches):
        yield from run(batches)
        _release_memory()

    return df.mapInArrow(task, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """At most ``rows`` rows at once: what is made of them is small, here and where Spark reads it."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_once(df: DataFrame, text_col: str, *more: str) -> DataFrame:
    """``row``, the text as column ``text`` unless ``row`` holds it, and ``more``: tasks get each text once."""
    inside = {f.name: f.dataType for f in df.schema["row"].dataType.fields}
    held = isinstance(inside.get(text_col), (StringType, BinaryType)) and list(inside).count(text_col) == 1
    return df.select("row", *(() if held else ("text",)), *more)


def texts_of(batch: pa.RecordBatch, text_col: str) -> list[bytes]:
    """The texts of a batch of ``text_once``; a null is an empty one."""
    texts = batch.column("text") if "text" in batch.schema.names else batch.column("row").field(text_col).cast(pa.binary())
    return [t or b"" for t in texts.to_pylist()]


def tables_made() -> int:
    return len(_MADE)


def made_since(mark: int) -> list[str]:
    return _MADE[mark:]


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables whose readers are done."""
    for path in paths:
        delete_path(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_mod(id_col: str, divisor: int):
    """crc32 of the id's decimal text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor
