"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

Fit: a bounded sample (``MAX_SAMPLE`` rows, by a hash of the row number) is split by
k-means into ``BRANCH`` parts, each part again, until a node stands for about
``LEAF_ROWS`` rows of the whole table. The tree has at most ``MAX_LEAVES``
leaves, so it can be sent to every task; beyond ``MAX_LEAVES * LEAF_ROWS`` rows
leaves grow with the table, which costs more distances per visit, not recall.
Every row is indexed: it goes down the tree to its leaf, and leaves larger than
``BLOCK_ROWS`` are dealt over several blocks by row number, so neither a
vector nor an id that very many rows hold is a task of its own.

Search: a query walks the tree with a priority queue of nodes by distance of
their centres, taking leaves in that order (best bin first). How many leaves
it takes is calibrated: for ``AUDIT`` of the queries the true neighbours are
found by scanning all rows, and leaf visits widen until the share of true
neighbours in visited leaves reaches ``TARGET`` (above the promised recall).
Queries are sent to the blocks of their leaves and stream past each block's
rows in batches, so the index is not copied; each block gives its best ``k`` by
exact distance in double precision on the original vectors; the best ``k`` of
all blocks are the answer.

Defined results: vectors that ``vectors.usable`` leaves out neither ask nor
answer; vectors of different lengths among the rest are an error, raised before
the search; a query's own id is never its answer; rows equal in id and vector
answer once each, but ask once in all; fewer candidates than ``k`` are all returned; ties go to the
smaller id; without queries or rows the result is empty; other columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorkit.llm.common import map_batches, written
from mirrorkit.llm.vectors import matrix, one_length, usable

MAX_SAMPLE = 20_000
BRANCH = 8
LEAF_ROWS = 400
MAX_LEAVES = 8192
BLOCK_ROWS = 2_000
AUDIT = 100
TARGET = 0.96


@dataclass
class Tree:
    """Nodes with centre and children; a leaf has a leaf number."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.centres) - 1

    def close(self, node: int) -> None:
        self.leaf[node] = self.leaves
        self.leaves += 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: down to the nearest child's centre, level by level."""
        out = np.zeros(len(x), dtype=np.int64)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            centres = np.stack([self.centres[c] for c in self.children[node]])
            nearest = squared(x[rows], centres).argmin(axis=1)
            for i, child in enumerate(self.children[node]):
                part = rows[nearest == i]
                if len(part):
                    stack.append((child, part))
        return out

    def best_bins(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                kids = self.children[node]
                d = ((np.stack([self.centres[c] for c in kids]) - query) ** 2).sum(axis=1)
                best = int(d.argmin())
                for i, child in enumerate(kids):
                    if i != best:
                        heapq.heappush(queue, (float(d[i]), child))
                node = kids[best]
            yield self.leaf[node]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None]


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres (k-means++ start) and nearest centre of each row; empty clusters are dropped."""
    centres = [x[rng.integers(len(x))]]
    nearest = ((x - centres[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        total = nearest.sum()
        if total <= 0:
            break
        centres.append(x[rng.choice(len(x), p=nearest / total)])
        nearest = np.minimum(nearest, ((x - centres[-1]) ** 2).sum(axis=1))
    c = np.stack(centres)
    for _ in range(rounds):
        who = squared(x, c).argmin(axis=1)
        used = np.unique(who)
        c = np.stack([x[who == j].mean(axis=0) for j in used])
    return c, squared(x, c).argmin(axis=1)


def fit_tree(sample: np.ndarray, total_rows: int, seed: int = 3) -> Tree:
    rng = np.random.default_rng(seed)
    tree = Tree()
    tree.add(sample.mean(axis=0) if len(sample) else np.zeros(1))
    target = max(LEAF_ROWS, -(-total_rows // MAX_LEAVES))  # rows per leaf over the whole table
    per_sample = total_rows / max(1, len(sample))
    stack = [(0, np.arange(len(sample)))]
    while stack:
        node, rows = stack.pop()
        stands_for = len(rows) * per_sample
        parts = int(min(BRANCH, stands_for // target))
        if parts < 2 or len(rows) < 4 * parts:
            tree.close(node)
            continue
        centres, who = kmeans(sample[rows], parts, rng)
        if len(centres) < 2:
            tree.close(node)
            continue
        for i, centre in enumerate(centres):
            child = tree.add(centre)
            tree.children[node].append(child)
            stack.append((child, rows[who == i]))
    return tree


def _index(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("vec"))
        leaf = tree.assign(x) if len(x) else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])


def _top(x: np.ndarray, x_ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int):
    """(query row, row, distance) of each query's k nearest rows of the block, and all ties with the last."""
    out = []
    for i in range(len(q)):
        d = np.sqrt(((x - q[i]) ** 2).sum(axis=1))
        ok = np.flatnonzero(x_ids != q_ids[i])
        if len(ok) > k:
            last = np.partition(d[ok], k - 1)[k - 1]
            ok = ok[d[ok] <= last]
        ok = ok[np.lexsort((x_ids[ok], d[ok]))][:k]
        out.append((np.full(len(ok), i), ok, d[ok]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int),) * 2 + (np.zeros(0),)


def _scan(batches: Iterator[pa.RecordBatch], queries: np.ndarray, ids: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Audit: best k of each batch for the given queries, with their leaves."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            piece = batch.slice(at, 4096)
            x_ids = piece.column("vec_id").to_numpy(zero_copy_only=False)
            who, row, d = _top(matrix(piece.column("vec")), x_ids, queries, ids, k)
            leaf = piece.column("leaf").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(x_ids[row]), pa.array(leaf[row]), pa.array(d)],
                                             names=["query_id", "vec_id", "leaf", "d"])


def calibrate(tree: Tree, queries: dict[int, np.ndarray], truth: dict[int, list[int]], target: float = TARGET) -> int:
    """Fewest leaf visits with which ``target`` of the true neighbours lie in visited leaves."""
    places = []
    for query_id, leaves in truth.items():
        order = {leaf: n for n, leaf in enumerate(tree.best_bins(queries[query_id]), start=1)}
        places += [order[leaf] for leaf in leaves]
    if not places:
        return tree.leaves
    places.sort()
    return places[min(len(places) - 1, int(np.ceil(target * len(places))) - 1)]


def _visits(batches: Iterator[pa.RecordBatch], tree: Tree, leaves: int, blocks: list[int]) -> Iterator[pa.RecordBatch]:
    """Each query for each block of the leaves it takes."""
    for whole in batches:
        for start in range(0, whole.num_rows, 512):
            batch = whole.slice(start, 512)
            places = []
            for i, q in enumerate(matrix(batch.column("vec"))):
                for n, leaf in enumerate(tree.best_bins(q)):
                    if n == leaves:
                        break
                    places += [(i, leaf, block) for block in range(blocks[leaf])]
            row, leaf, block = (pa.array(c, type=pa.int64()) for c in (zip(*places) if places else ([], [], [])))
            yield pa.RecordBatch.from_arrays([leaf, block, batch.column("vec_id").take(row), batch.column("vec").take(row)],
                                             names=["leaf", "block", "vec_id", "vec"])


def _answers(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Blocks one after another: first a block's rows, then the queries that visit it."""
    place, rows, block = None, [], None
    for whole in batches:
        leaf, part = (whole.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "block"))
        asks = whole.column("asks").to_numpy(zero_copy_only=False)
        change = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(part) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
        for a, b in zip(np.append(0, change), np.append(change, whole.num_rows)):
            if a == b:
                continue
            if (leaf[a], part[a]) != place:
                place, rows, block = (leaf[a], part[a]), [], None
            piece = whole.slice(a, b - a)
            found = piece.column("vec_id").to_numpy(zero_copy_only=False), matrix(piece.column("vec"))
            if not asks[a]:
                rows.append(found)
                continue
            if not rows:
                continue
            if block is None:
                block = tuple(np.concatenate(c) for c in zip(*rows))
            who, row, d = _top(block[1], block[0], found[1], found[0], k)
            yield pa.RecordBatch.from_arrays([pa.array(found[0][who]), pa.array(block[0][row]), pa.array(d)],
                                             names=["query_id", "vec_id", "score"])


def _sample(vecs: DataFrame, total: int) -> np.ndarray:
    """About ``MAX_SAMPLE`` rows by a hash of the row number; some rows in any case."""
    ppm = min(1_000_000, 1_000_000 * MAX_SAMPLE // total)
    picked = vecs.filter(F.pmod(F.xxhash64("row", F.lit(2)), F.lit(1_000_000)) < ppm).limit(2 * MAX_SAMPLE).select("vec").toArrow()
    if not picked.num_rows:
        picked = vecs.limit(MAX_SAMPLE).select("vec").toArrow()
    return np.concatenate([matrix(c) for c in picked.column("vec").chunks if len(c)])


def nearest(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, by Euclidean distance.

    ``is_query`` is a condition over ``vec_id``.
    """
    out = "query_id bigint, rank int, vec_id bigint, score double"
    vecs = written(usable(df, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    total = one_length(vecs)
    if not total:
        return df.sparkSession.createDataFrame([], out)
    tree = fit_tree(_sample(vecs, total), total)
    indexed = written(vecs.mapInArrow(lambda it: _index(it, tree), "vec_id bigint, vec array<double>, row bigint, leaf bigint"), "ann-index")

    asks = indexed.filter(is_query).select("vec_id", "vec").distinct()
    some = asks.orderBy(F.xxhash64("vec_id", F.lit(8)), "vec_id").limit(AUDIT).collect()  # calibration only
    if not some:
        return df.sparkSession.createDataFrame([], out)
    audit = {r["vec_id"]: np.array(r["vec"]) for r in some}
    ids, qs = np.array(list(audit)), np.stack(list(audit.values()))
    found = indexed.select("vec_id", "vec", "leaf").mapInArrow(lambda it: _scan(it, qs, ids, k), "query_id bigint, vec_id bigint, leaf bigint, d double")
    order = Window.partitionBy("query_id").orderBy("d", "vec_id")
    truth: dict[int, list[int]] = {}
    for r in found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).collect():  # k per audited query
        truth.setdefault(r["query_id"], []).append(r["leaf"])
    leaves = calibrate(tree, audit, truth)

    # Leaves in blocks of bounded size, by row number.
    sizes = indexed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    blocks = [0] * tree.leaves
    for r in sizes.collect():  # at most MAX_LEAVES x BRANCH rows
        blocks[r["leaf"]] = r["blocks"]
    members = indexed.join(F.broadcast(sizes), "leaf").select(
        "leaf", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("bigint").alias("block"), "vec_id", "vec", F.lit(False).alias("asks"))
    visits = asks.mapInArrow(lambda it: _visits(it, tree, leaves, blocks),
                             "leaf bigint, block bigint, vec_id bigint, vec array<double>").withColumn("asks", F.lit(True))
    dealt = members.unionByName(visits).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "asks")
    best = map_batches(dealt, lambda it: _answers(it, k), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
