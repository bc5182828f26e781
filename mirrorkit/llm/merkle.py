"""Merkle manifest of a document table: checkpoint a few levels, recompute the rest for proofs.

A row's leaf is the digest of its fields. Leaves of one language, in id order,
form a tree with ``FAN`` children a node; the languages' roots form the tree
above them. Only every ``STRIDE``-th level is written: an aligned subtree
(``FAN ** STRIDE`` stored nodes and the stored node above them) is one row of
a written table, whatever the size of its language, so a language that holds
most rows is many rows.

Proofs are made from the top down. For each aligned subtree a task makes its
missing interior levels again from the stored nodes, emits the siblings on the
way of each of them (followed by the way of the stored node above, which is
the same for all) and drops the interior again. Only the ways of stored nodes
above the leaves are written.

Places are found without a task that sees a language: rows are dealt by ranges
of (language, id, leaf, row number), numbered inside a range, and the rows of
the same language in earlier ranges are added.

Defined results: null fields are marked, so null and empty text differ; a null
id comes first in its language and is never tampered with; rows equal in all
five fields are leaves of their own with equal digests (their order has no
effect on any digest), rows that share an id come in order of their leaves; a
null language is a language, before all others; an empty table gives no rows;
other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorkit.llm.common import crc32_mod, written

FAN = 8
#: Levels from one stored level to the next.
STRIDE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = "array<struct<place: int, siblings: string>>"
_STEP_TYPE = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field_text(fields[name]) for name in FIELDS]), 256)


def levels_over(n: int) -> int:
    """Levels between ``n`` nodes and their root."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def fold(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the ``levels`` levels above them, lowest first."""
    made = [nodes]
    for _ in range(levels):
        last = made[-1]
        made.append([digest("".join(last[at : at + FAN])) for at in range(0, len(last), FAN)])
    return made


def ways(nodes: list[str], levels: int) -> list[list[tuple[int, str]]]:
    """Each node's way up: per level its place in the run and the run's other nodes, joined."""
    steps = [[(at % FAN, "".join(level[at - at % FAN : at] + level[at + 1 : at - at % FAN + FAN]))
              for at in range(len(level))] for level in fold(nodes, levels - 1)] if levels else []
    return [[level[at // FAN**up] for up, level in enumerate(steps)] for at in range(len(nodes))]


@dataclass
class Forest:
    """Stored levels of the trees of all groups.

    ``levels[j]`` has a row (group, block, n, nodes) per aligned subtree, where
    ``n`` counts the group's nodes on that level and ``nodes`` holds structs
    with place and digest; level 0 has the leaves' ``carry`` too. ``roots``
    has (group, digest).
    """

    stride: int
    levels: list[DataFrame] = field(default_factory=list)
    roots: DataFrame | None = None


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``place`` (from 0, in its group) and ``n`` (rows of the group)."""
    keys = ["group", *order, "row"]
    dealt = rows.repartitionByRange(*[F.asc_nulls_first(k) for k in keys]).sortWithinPartitions(
        *[F.asc_nulls_first(k) for k in keys]).withColumn("at", F.monotonically_increasing_id())
    dealt = written(dealt.withColumn("part", F.shiftright("at", 33)), "merkle-sorted")
    # A row per range and group in it.
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("group", "part").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first")).select(
        "group", "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("c").over(Window.partitionBy("group")).alias("n"))
    return dealt.join(counts, ["group", "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift", "row")


def _blocks(nodes: DataFrame, columns: list[str], size: int) -> DataFrame:
    """One row per aligned subtree of ``size`` stored nodes, with these in order."""
    return nodes.groupBy("group", F.floor(F.col("place") / size).cast("bigint").alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "digest", *columns))).alias("nodes"))


def _tops(batches: Iterator[pa.RecordBatch], stride: int) -> Iterator[pa.RecordBatch]:
    """The stored node above each aligned subtree."""
    for batch in batches:
        n = batch.column("n").to_pylist()
        top = [fold(d, min(stride, levels_over(k)))[-1][0] for d, k in zip(batch.column("digests").to_pylist(), n)]
        above = [-(-k // FAN**stride) for k in n]
        yield pa.RecordBatch.from_arrays(
            [batch.column("group"), batch.column("block"), pa.array(above, type=pa.int64()), pa.array(top, type=pa.string())],
            names=["group", "place", "n", "digest"])


def build(leaves: DataFrame, order: list[str], carry: list[str], stride: int = STRIDE) -> Forest:
    """Trees of the rows (group, digest, row, *order, *carry), a tree per group."""
    made = Forest(stride)
    nodes = _numbered(leaves, order)
    columns = carry
    while True:
        level = written(_blocks(nodes, columns, FAN**stride), "merkle-level")
        made.levels.append(level)
        digests = level.select("group", "block", "n", F.col("nodes.digest").alias("digests"))
        nodes = written(digests.mapInArrow(
            lambda it: _tops(it, stride), "group string, place bigint, n bigint, digest string"), "merkle-tops")
        roots = nodes.filter("n = 1").select("group", "digest")
        made.roots = roots if made.roots is None else made.roots.unionByName(roots)
        nodes, columns = nodes.filter("n > 1"), []
        if not nodes.limit(1).count():
            return made


def _ways(batches: Iterator[pa.RecordBatch], columns: list[str], stride: int) -> Iterator[pa.RecordBatch]:
    """A row per stored node: its columns, its way to the root, and the root."""
    for batch in batches:
        for i in range(batch.num_rows):
            nodes = batch.column("nodes")[i].values
            rest = [(s["place"], s["siblings"]) for s in batch.column("rest")[i].as_py()]
            levels = min(stride, levels_over(batch.column("n")[i].as_py()))
            found = [way + rest for way in ways(nodes.field("digest").to_pylist(), levels)]
            places = pa.array([place for way in found for place, _ in way], type=pa.int32())
            siblings = pa.array([others for way in found for _, others in way], type=pa.string())
            ends = np.cumsum([0] + [len(way) for way in found], dtype=np.int32)
            steps = pa.ListArray.from_arrays(
                pa.array(ends), pa.StructArray.from_arrays([places, siblings], fields=list(_STEP_TYPE.value_type)))
            of_group = [pa.array([batch.column(c)[i].as_py()] * len(nodes), type=pa.string()) for c in ("group", "root")]
            yield pa.RecordBatch.from_arrays(
                [*of_group, *[nodes.field(c) for c in columns], steps], names=["group", "root", *columns, "steps"])


def proofs(forest: Forest, above: DataFrame, carry: dict[str, str]) -> DataFrame:
    """(group, root, place, digest, *carry, steps) of each leaf.

    ``above`` has (group, root, steps): each group's root and the way on from
    it. ``steps`` go from the leaf up: place in the run, and the run's others
    joined.
    """
    tops = above.select("group", F.lit(0).cast("bigint").alias("block"), "root", F.col("steps").alias("rest"))
    found, types, stride = None, {"place": "bigint", "digest": "string"}, forest.stride
    for number, blocks in reversed(list(enumerate(forest.levels))):
        over = tops
        if found is not None:  # groups whose trees end here hang on their roots, all others on the level above
            higher = found.select("group", F.col("place").alias("block"), "root", F.col("steps").alias("rest"))
            over = higher.unionByName(tops.join(found.select("group").distinct(), "group", "left_anti"))
        columns = types if number else types | carry
        found = blocks.join(over, ["group", "block"]).mapInArrow(
            lambda it, names=list(columns): _ways(it, names, stride),
            "group string, root string, " + ", ".join(f"{c} {t}" for c, t in columns.items()) + f", steps {_STEPS}")
        if number:
            found = written(found, "merkle-ways")
    return found


def folded(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way."""
    return F.aggregate(steps, leaf, lambda acc, s: F.sha2(F.concat(
        F.substring(s.siblings, F.lit(1), s.place * 64), acc, F.substring(s.siblings, s.place * 64 + 1, F.length(s.siblings))), 256))


def proof_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: s.siblings), ""), 256)


def _group(lang: Column) -> Column:
    """Languages as text that sorts like them, null first."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def leaves_of(docs: DataFrame, tampered: Column) -> DataFrame:
    """(group, digest, row, doc_id, changed): ``changed`` is the leaf after tampering, where that is asked for."""
    fields = {name: F.col(name) for name in FIELDS}
    lowered = fields | {"text": F.translate("text", _UPPER, _LOWER)}
    return docs.select(_group(F.col("lang").cast("string")).alias("group"), leaf_digest(fields).alias("digest"), "doc_id",
                       F.when(tampered, leaf_digest(lowered)).alias("changed")).withColumn(
        "row", F.monotonically_increasing_id())


def manifest(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """(doc_id, leaf, changed, subroot, root, steps): each document's proof under the root of the table.

    ``changed`` is the leaf with the text's A-Z lower-cased, for ids whose
    crc32 is divisible by 3, else null.
    """
    leaves = written(leaves_of(docs, F.coalesce(crc32_mod("doc_id", 3) == 0, F.lit(False))), "merkle-leaves")
    trees = build(leaves, ["doc_id", "digest"], ["doc_id", "changed"], stride)
    subroots = written(trees.roots, "merkle-roots")
    upper = build(subroots.select(F.lit("").alias("group"), "digest", F.col("group").alias("lang"), F.lit(0).alias("row")),
                  ["lang"], ["lang"], stride)
    top = upper.roots.select("group", F.col("digest").alias("root"), F.array().cast(_STEPS).alias("steps"))
    over = written(proofs(upper, top, {"lang": "string"}).select(
        F.col("lang").alias("group"), F.struct("root", "digest").alias("roots"), "steps"), "merkle-ways")
    # The root of all travels with each language's root.
    both = F.concat_ws(",", "roots.root", "roots.digest")
    found = proofs(trees, over.select("group", both.alias("root"), "steps"), {"doc_id": "bigint", "changed": "string"})
    roots = F.split("root", ",")
    return found.select("doc_id", F.col("digest").alias("leaf"), "changed", roots[1].alias("subroot"), roots[0].alias("root"), "steps")
