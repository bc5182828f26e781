"""Hard negatives by exact window searches in a multiway hyperplane tree.

Rows are vectors of integers; a row's score is its inner product with the
anchor. An anchor's positives are its best rows of the same label; its
negatives for a positive are the best rows of other labels whose scores lie
between two shares of the positive's score.

*Scores as distances.* With ``M`` the largest squared length of all rows, a
row gets one more component, ``sqrt(M - its squared length)``, and an anchor a
zero: then ``distance ** 2 = |anchor| ** 2 + M - 2 * score``, so a window of
scores is an annulus around the anchor.

*Tree.* Each split point has up to ``BRANCH`` centres, far apart, chosen in a
bounded sample (``MAX_SAMPLE`` rows); a row goes to the nearest centre, so the
parts are separated by hyperplanes. All rows are indexed, and for every centre
``i`` and sibling part ``j`` the least and largest distance from ``i`` to the
rows of ``j`` are kept: aggregated over all rows, combined in each task first.
A part is passed over if for any centre the distances that its rows can have
from the anchor, by that range, miss the annulus. What remains is searched
leaf by leaf with exact integer scores, so nothing is lost; ranges only save
work (``SLACK`` covers rounding).

*Windows are narrowed first*: an anchor's k-th best sample row in its window
bounds its k-th best row from below. No answer is less than that.

*Tasks.* A leaf is cut in blocks of about ``BLOCK_ROWS`` rows by a hash of the
row number, so neither a large leaf nor one vector that very many rows hold is
one task. Blocks are not copied: anchors are sent to the blocks they visit
and stream past them in batches.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; zero and empty vectors do; shorter vectors count as
filled up with zeros; a repeated row is a candidate each time, but asks once;
rows with the anchor's own id are never its positives or negatives; ties go to
the smaller id; a positive with a negative score has no negatives, as its
window is empty; empty tables give no rows; other columns are ignored. Scores
and their shares must fit in a long: a row whose squared length reaches
``2 ** 55`` is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorkit.llm.common import map_batches, written

MAX_SAMPLE = 20_000
BRANCH = 8
LEAF_ROWS = 1_000
#: Leaves of the tree at most; beyond it leaves have more blocks.
MAX_LEAVES = 4_096
BLOCK_ROWS = 4_000
SLACK = 1e-6
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


@dataclass
class Tree:
    """Split points with centres; ``kids[s][j]`` is a split point (>= 0) or ``-1 - leaf``."""

    centres: list[np.ndarray] = field(default_factory=list)
    kids: list[list[int]] = field(default_factory=list)
    #: Per split point: least and largest distance from centre i to the rows of part j.
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)
    leaves: int = 0

    def grow(self, x: np.ndarray, rows_each: float, most: float, rng: np.random.Generator) -> None:
        """Splits sample rows ``x``, each of which stands for ``rows_each`` rows, into parts of ``most`` rows at most."""
        todo = [(x, None, 0)]
        while todo:
            part, above, slot = todo.pop()
            parts = int(min(BRANCH, len(part) // 4, len(part) * rows_each // most))
            centres = far_apart(part, parts, rng) if parts > 1 else part[:0]
            if len(centres) < 2:
                self.leaves += 1
                place = -self.leaves
            else:
                place = len(self.centres)
                self.centres.append(centres)
                self.kids.append([0] * len(centres))
                self.low.append(np.full((len(centres), len(centres)), np.inf))
                self.high.append(np.full((len(centres), len(centres)), -np.inf))
                nearest = distances(part, centres).argmin(axis=1)
                todo += [(part[nearest == j], place, j) for j in range(len(centres))]
            if above is not None:
                self.kids[above][slot] = place

    def descend(self, x: np.ndarray, meet=None) -> np.ndarray:
        """Leaf of each row; ``meet(split, part, distances)`` sees the rows of each part on the way."""
        out = np.zeros(len(x), dtype=np.int64)
        stack = [(0 if self.centres else -1, np.arange(len(x)))]
        while stack:
            at, rows = stack.pop()
            if at < 0:
                out[rows] = -1 - at
                continue
            d = distances(x[rows], self.centres[at])
            nearest = d.argmin(axis=1)
            for j, kid in enumerate(self.kids[at]):
                mine = nearest == j
                if mine.any():
                    if meet is not None:
                        meet(at, j, d[mine])
                    stack.append((kid, rows[mine]))
        return out

    def visits(self, q: np.ndarray, inner: np.ndarray, outer: np.ndarray, slack: float) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``q`` whose annulus its rows may meet)."""
        stack = [(0 if self.centres else -1, np.flatnonzero(inner <= outer))]
        while stack:
            at, rows = stack.pop()
            if not len(rows):
                continue
            if at < 0:
                yield -1 - at, rows
                continue
            d = distances(q[rows], self.centres[at])[:, :, None]
            low, high = self.low[at][None], self.high[at][None]
            nearest = np.maximum(np.maximum(d - high, low - d), 0.0)
            near = outer[rows][:, None, None]
            far = inner[rows][:, None, None]
            meets = ((nearest <= near + slack) & (d + high >= far - slack)).all(axis=1)
            for j, kid in enumerate(self.kids[at]):
                stack.append((kid, rows[meets[:, j]]))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None]
    return np.sqrt(np.maximum(square, 0.0))


def far_apart(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Up to ``k`` different rows of ``x``, each the farthest of ``3 k`` drawn ones from those before."""
    drawn = x[rng.choice(len(x), size=min(len(x), 3 * k), replace=False)]
    chosen = [0]
    nearest = distances(drawn, drawn[:1])[:, 0]
    while len(chosen) < k and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(drawn, drawn[chosen[-1:]])[:, 0])
    return drawn[chosen]


def whole(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as integers, filled up with zeros to ``width``."""
    lengths = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width)[None] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def lifted(x: np.ndarray, top: int) -> np.ndarray:
    """Rows with the component that brings them to the squared length ``top``."""
    rest = top - (x * x).sum(axis=1)
    return np.concatenate([x.astype(np.float64), np.sqrt(np.maximum(rest, 0).astype(np.float64))[:, None]], axis=1)


def scores_of(a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
    """Exact inner products; doubles hold them (and all partial sums) below 2 ** 53."""
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def best(scores: np.ndarray, ids: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores among ``ok``, ties by smaller id."""
    at = np.flatnonzero(ok)
    if len(at) > k:
        last = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= last]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


@dataclass
class Model:
    """What each task holds: the tree, the sample, and how many blocks each leaf has."""

    tree: Tree
    ids: np.ndarray
    labels: np.ndarray
    sample: np.ndarray
    top: int
    blocks: np.ndarray | None = None

    @property
    def width(self) -> int:
        return self.sample.shape[1]


def _index(batches: Iterator[pa.RecordBatch], tree: Tree, width: int, top: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaf = tree.descend(lifted(whole(batch.column("vec"), width), top))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])


def _ranges(batches: Iterator[pa.RecordBatch], tree: Tree, width: int, top: int) -> Iterator[pa.RecordBatch]:
    """Ranges over the rows of this task: split, centre, part, low, high."""
    low, high = [m.copy() for m in tree.low], [m.copy() for m in tree.high]

    def meet(at, j, d):
        np.minimum(low[at][:, j], d.min(axis=0), out=low[at][:, j])
        np.maximum(high[at][:, j], d.max(axis=0), out=high[at][:, j])

    for batch in batches:
        tree.descend(lifted(whole(batch.column("vec"), width), top), meet)
    rows = [(at, i, j, low[at][i, j], high[at][i, j]) for at in range(len(low))
            for i, j in zip(*np.nonzero(np.isfinite(low[at])))]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    columns = list(zip(*rows)) or [()] * 5
    yield pa.RecordBatch.from_arrays([pa.array([k.item() if hasattr(k, "item") else k for k in c], type=t) for c, t in zip(columns, kinds)],
                                     names=["split", "centre", "part", "low", "high"])


_ASK = "ask bigint, own bigint, label int, vec array<bigint>, low array<bigint>, high array<bigint>"
_ASK_COLUMNS = ["ask", "own", "label", "vec", "low", "high"]


def _visits(batches: Iterator[pa.RecordBatch], model: Model, same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Each ask for each block it must see: its windows there, narrowed by the sample."""
    for whole_batch in batches:
        for start in range(0, whole_batch.num_rows, 64):
            batch = whole_batch.slice(start, 64)
            q = whole(batch.column("vec"), model.width)
            own, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("own", "label"))
            low, high = batch.column("low").to_pylist(), batch.column("high").to_pylist()
            seen = scores_of(q, model.sample, model.top)
            windows = []  # (row, window, low, high)
            for i in range(len(q)):
                fits = ((model.labels == label[i]) == same) & (model.ids != own[i])
                for w, (lo, hi) in enumerate(zip(low[i], high[i])):
                    at = best(seen[i], model.ids, fits & (seen[i] >= lo) & (seen[i] <= hi), k)
                    windows.append((i, w, int(seen[i][at[-1]]) if len(at) == k else lo, hi))
            row = np.array([w[0] for w in windows], dtype=np.int64)
            lengths = (q * q).sum(axis=1)[row].astype(np.float64) + float(model.top)
            lo, hi = (np.array([float(w[c]) for w in windows]) for c in (2, 3))
            outer, inner = (np.sqrt(np.maximum(lengths - 2 * s, 0.0)) for s in (lo, hi))
            inner[lo > hi] = np.inf
            lifted_q = np.concatenate([q.astype(np.float64), np.zeros((len(q), 1))], axis=1)
            out: dict[tuple[int, int], list] = {}
            for leaf, met in model.tree.visits(lifted_q[row], inner, outer, SLACK * (1 + model.top**0.5)):
                for m in met:
                    out.setdefault((leaf, windows[m][0]), []).append(windows[m][1:])
            places = [(leaf, block, i, found) for (leaf, i), found in out.items() for block in range(model.blocks[leaf])]
            if not places:
                continue
            take = pa.array([p[2] for p in places], type=pa.int64())
            lists = [pa.array([[f[c] for f in p[3]] for p in places], type=pa.list_(pa.int64())) for c in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in places], type=pa.int64()), pa.array([p[1] for p in places], type=pa.int64()),
                 *[batch.column(c).take(take) for c in ("ask", "own", "label", "vec")], *lists],
                names=["leaf", "block", "ask", "own", "label", "vec", "window", "low", "high"])


def _search(batches: Iterator[pa.RecordBatch], model: Model, same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Blocks one after another: a block's rows first (``ask`` null), then the asks that visit it."""
    names = ["ask", "window", "vec_id", "score"]
    place, members, block = None, [], None
    for whole_batch in batches:
        leaf, part = (whole_batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "block"))
        asks = whole_batch.column("ask").is_valid().to_numpy(zero_copy_only=False)
        change = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(part) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
        for a, b in zip(np.append(0, change), np.append(change, whole_batch.num_rows)):
            if a == b:
                continue
            if (leaf[a], part[a]) != place:
                place, members, block = (leaf[a], part[a]), [], None
            piece = whole_batch.slice(a, b - a)
            if not asks[a]:
                members.append((piece.column("own").to_numpy(zero_copy_only=False),
                                piece.column("label").to_numpy(zero_copy_only=False), whole(piece.column("vec"), model.width)))
                continue
            if not members:
                continue
            if block is None:
                block = tuple(np.concatenate(c) for c in zip(*members))
            ids, labels, x = block
            for start in range(0, piece.num_rows, 256):
                some = piece.slice(start, 256)
                scores = scores_of(whole(some.column("vec"), model.width), x, model.top)
                out = []
                for i, r in enumerate(some.select(["ask", "own", "label", "window", "low", "high"]).to_pylist()):
                    fits = ((labels == r["label"]) == same) & (ids != r["own"])
                    for w, lo, hi in zip(r["window"], r["low"], r["high"]):
                        at = best(scores[i], ids, fits & (scores[i] >= lo) & (scores[i] <= hi), k)
                        out.append((np.full(len(at), r["ask"]), np.full(len(at), w), ids[at], scores[i][at]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=names)


def _answers(index: DataFrame, sizes: DataFrame, asks: DataFrame, model: Model, same: bool, k: int) -> DataFrame:
    """(ask, window, vec_id, score, rank): the first ``k`` rows of every window."""
    shared = index.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_SAMPLE and MAX_LEAVES
    members = index.join(F.broadcast(sizes), "leaf").select(  # at most MAX_LEAVES rows
        "leaf", F.pmod(F.xxhash64("row"), F.col("blocks")).alias("block"), F.lit(None).cast("bigint").alias("ask"),
        F.col("vec_id").alias("own"), "label", "vec", *[F.lit(None).cast("array<bigint>").alias(c) for c in ("window", "low", "high")])
    visits = asks.mapInArrow(lambda it: _visits(it, shared.value, same, k),
                             "leaf bigint, block bigint, ask bigint, own bigint, label int, vec array<bigint>, "
                             "window array<bigint>, low array<bigint>, high array<bigint>")
    dealt = members.unionByName(visits).repartition("leaf", "block").sortWithinPartitions(
        "leaf", "block", F.col("ask").asc_nulls_first())
    found = map_batches(dealt, lambda it: _search(it, shared.value, same, k), "ask bigint, window bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("ask", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rows_of(df: DataFrame, label: Column, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, label, vec: array<bigint>) of the rows that take part, written."""
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), label.cast("int").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False)))
    return written(rows.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label",
        F.transform("x", lambda c: F.floor(c * scale).cast("bigint")).alias("vec")), "gnat-rows")


def _fit(rows: DataFrame, total: int, width: int, top: int) -> Model:
    ppm = min(1_000_000, 1_000_000 * MAX_SAMPLE // total)
    picked = rows.filter(F.pmod(F.xxhash64("row", F.lit(2)), F.lit(1_000_000)) < ppm).limit(2 * MAX_SAMPLE)
    table = picked.select("vec_id", "label", "vec").toArrow().combine_chunks()
    if not table.num_rows:
        table = rows.limit(MAX_SAMPLE).select("vec_id", "label", "vec").toArrow().combine_chunks()
    sample = np.concatenate([whole(c, width) for c in table.column("vec").chunks])
    tree = Tree()
    most = max(LEAF_ROWS, total / MAX_LEAVES)
    tree.grow(lifted(sample, top), total / len(sample), most, np.random.default_rng(11))
    return Model(tree, table.column("vec_id").to_numpy(), table.column("label").to_numpy(), sample, top)


def hard_negatives(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   label: Column | None = None, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition over ``vec_id``; a negative's score is between
    ``low`` and ``high`` per cent of the positive's.
    """
    spark = df.sparkSession
    rows = rows_of(df, F.col("label") if label is None else label, scale, id_col, vector_col)
    length = F.aggregate("vec", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    total, width, top = rows.agg(F.count(F.lit(1)), F.greatest(F.max(F.size("vec")), F.lit(1)), F.max(length)).first()
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not total:
        return spark.createDataFrame([], out)
    if top >= float(1 << 55):
        raise ValueError("vectors too long: shares of their scores would not fit in a long")
    top = int(top * (1 + 1e-12))
    model = _fit(rows, total, width, top)
    tree = model.tree
    if tree.centres:
        ranges = map_batches(rows.select("vec"), lambda it: _ranges(it, tree, width, top),
                             "split bigint, centre bigint, part bigint, low double, high double")
        for r in ranges.groupBy("split", "centre", "part").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            tree.low[r["split"]][r["centre"], r["part"]] = r["low"]  # at most BRANCH rows a leaf or split point
            tree.high[r["split"]][r["centre"], r["part"]] = r["high"]
    index = written(rows.mapInArrow(lambda it: _index(it, tree, width, top), "row bigint, vec_id bigint, label int, vec array<bigint>, leaf bigint"),
                    "gnat-index")
    sizes = index.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    model.blocks = np.zeros(tree.leaves, dtype=np.int64)
    for r in sizes.collect():  # a row per leaf
        model.blocks[r["leaf"]] = r["blocks"]

    anchors = written(index.filter(is_anchor).select("vec_id", "label", "vec").distinct().select(
        F.monotonically_increasing_id().alias("ask"), F.col("vec_id").alias("own"), "label", "vec"), "gnat-anchors")
    one = [F.array(F.lit(_LEAST)).alias("low"), F.array(F.lit(_MOST)).alias("high")]
    nearest = written(_answers(index, sizes, anchors.select("*", *one), model, True, positives).select(
        "ask", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("window")), "gnat-positives")
    # Windows of an anchor's positives, in their order; that of a negative score is empty.
    score = "transform(p, x -> if(x.positive_score < 0, {}, ({} * x.positive_score + {}) div 100))"
    bounds = nearest.groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("window", "positive_score"))).alias("p")).select(
        "ask", F.expr(score.format("1L", f"{low}L", "99L")).alias("low"), F.expr(score.format("0L", f"{high}L", "0L")).alias("high"))
    found = _answers(index, sizes, anchors.join(bounds, "ask").select(*_ASK_COLUMNS), model, False, negatives)
    return found.select("ask", (F.col("window") + 1).alias("window"), F.col("rank").cast("int").alias("rank"),
                        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        nearest, ["ask", "window"]).join(anchors.select("ask", F.col("own").alias("anchor_id")), "ask").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
