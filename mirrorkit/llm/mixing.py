"""Temperature mixing of sources, realised as budgeted block permutations.

Weights are token shares raised to an exponent between 0 (all sources alike)
and 1 (as they come) and normalised. The exponent is bisected: the flattest
mixture in which no source is repeated more often than ``max_repeats``, or the
one whose entropy is ``target_entropy`` (in nats), if that is given; with both,
the larger exponent.

The budget is in tokens (stretches between white space). By default it is the
least with which every document is used at least once. A source with weight
``w`` runs through ``w * budget / tokens`` epochs: whole ones, then a part.
Each epoch has its own permutation (a hash of seed, epoch and row in [0, 1));
the part takes documents in that order until its tokens are spent, so it
overshoots by less than a document. Where that happens is found from sums over
small ranges of the hash and a running sum in one such range; no task sees a
source as a whole. The plan (a row per source) is joined by broadcast up to
``BROADCAST_SOURCES`` sources, so rows of a source do not meet anywhere.

A document's place in the mixture is (epoch + hash) / epochs of its source, so
every stretch of the mixture has the target weights. Stretches of about
``block_tokens`` tokens are blocks; inside, documents are permuted once more.
``mix`` numbers the blocks' documents; ``mixture`` moves whole rows, once, to
the partition that holds their block, in the mixture's order: written files
read by name are the mixture.

Defined results: a null source is a source; null texts have no tokens; a
source without tokens is used once; rows equal in id and text share their
hashes and so go together; an empty table gives no rows. Carried columns
are in a struct, so none can clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorkit.llm.common import written

MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 21
RANGE_DOCS = 10_000
#: Sources (a short row each) up to which the plan is broadcast.
BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class Share:
    source: str | None
    docs: int
    tokens: int
    weight: float
    epochs: float


def weights_at(tokens: list[int], exponent: float) -> list[float]:
    """Normalised powers of the shares; sources without tokens weigh nothing."""
    top = max(tokens, default=0)
    raw = [(t / top) ** exponent if t else 0.0 for t in tokens]
    total = sum(raw)
    return [r / total for r in raw] if total else raw


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def repeats(tokens: list[int], weights: list[float], budget: float | None) -> list[float]:
    """Epochs per source. Without a budget: the least that uses everything once."""
    if budget is None:
        budget = max((t / w for t, w in zip(tokens, weights) if w > 0), default=0.0)
    return [w * budget / t if t else 1.0 for t, w in zip(tokens, weights)]


def _bisect(holds, low: float = 0.0, high: float = 1.0) -> float:
    """Least exponent that ``holds``, given that it holds from some exponent on."""
    if holds(low):
        return low
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def choose_exponent(tokens: list[int], max_repeats: float | None = MAX_REPEATS,
                    target_entropy: float | None = None, budget: float | None = None) -> float:
    """Entropy and the largest repetition both fall as the exponent rises."""
    found = 0.0
    if max_repeats is not None:
        found = _bisect(lambda e: max(repeats(tokens, weights_at(tokens, e), budget), default=0) <= max_repeats * (1 + 1e-12))
    if target_entropy is not None:
        found = max(found, _bisect(lambda e: entropy(weights_at(tokens, e)) <= target_entropy))
    return found


def shares(sizes: list[tuple[str | None, int, int]], max_repeats: float | None = MAX_REPEATS,
           target_entropy: float | None = None, budget: float | None = None) -> list[Share]:
    """The mixture of sources given as (source, docs, tokens)."""
    tokens = [t for _, _, t in sizes]
    weights = weights_at(tokens, choose_exponent(tokens, max_repeats, target_entropy, budget))
    return [Share(s, d, t, w, e) for (s, d, t), w, e in zip(sizes, weights, repeats(tokens, weights, budget))]


def token_count(text):
    """Stretches between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("bigint")


def _hash01(seed: int, *columns):
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


@dataclass(frozen=True)
class Plan:
    """The mixture of a table: per source its epochs, and how many blocks there are."""

    rows: DataFrame
    small: bool
    blocks: int
    seed: int

    def of(self, docs: DataFrame) -> DataFrame:
        """Rows (id, text_hash, source, ...) once per epoch they are used in, with epoch, place and block."""
        rows = F.broadcast(self.rows) if self.small else self.rows
        placed = docs.join(rows, F.col("source").eqNullSafe(F.col("m_source"))).withColumn(
            "epoch", F.explode(F.sequence(F.lit(0), F.col("whole")))).withColumn(
            "u", _hash01(self.seed, F.col("epoch"), F.col("id"), F.col("text_hash"))).filter(
            (F.col("epoch") < F.col("whole")) | (F.col("u") <= F.col("part_end")))
        placed = placed.withColumn("place", (F.col("epoch") + F.col("u")) / F.greatest("epochs", F.col("epoch") + F.col("u") + 1e-9))
        return placed.withColumn("block", F.least(F.floor(F.col("place") * self.blocks), F.lit(self.blocks - 1)).cast("int")).withColumn(
            "key", F.xxhash64(F.lit(self.seed + 1), "epoch", "id", "text_hash"))


def named(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(source_col).cast("string").alias("source"), *more)


def plan(slim: DataFrame, max_repeats: float | None, target_entropy: float | None, budget: float | None, seed: int,
         block_tokens: int) -> Plan:
    """The plan for rows (id, text_hash, source, tokens)."""
    spark = slim.sparkSession
    sizes = [(r["source"], r["docs"], r["tokens"]) for r in slim.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens")).orderBy("source").collect()]  # a row per source
    small = len(sizes) <= BROADCAST_SOURCES

    def side(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if small else frame

    mixture = shares(sizes, max_repeats, target_entropy, budget)
    rows = [(s.source, s.epochs, int(s.epochs + 1e-9), max(1, s.docs // RANGE_DOCS),
             max(0.0, (s.epochs - int(s.epochs + 1e-9)) * s.tokens)) for s in mixture]
    parts = spark.createDataFrame([r for r in rows if r[4] > 0],
                                  "m_source string, epochs double, whole int, ranges int, part_tokens double")

    # Where each source's part epoch ends: first the range of hashes, then the hash.
    part = slim.join(side(parts), F.col("source").eqNullSafe(F.col("m_source"))).withColumn(
        "u", _hash01(seed, F.col("whole"), F.col("id"), F.col("text_hash"))).withColumn(
        "range", F.floor(F.col("u") * F.col("ranges")).cast("int")).select("m_source", "part_tokens", "range", "u", "tokens")
    before = Window.partitionBy("m_source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = part.groupBy("m_source", "part_tokens", "range").agg(F.sum("tokens").alias("t")).withColumn(
        "first", F.coalesce(F.sum("t").over(before), F.lit(0))).filter(
        "first < part_tokens AND first + t >= part_tokens").select(
        F.col("m_source").alias("e_source"), F.col("range").alias("e_range"), "first")
    inside = part.join(side(ranges), F.col("m_source").eqNullSafe(F.col("e_source")) & (F.col("range") == F.col("e_range")))
    ahead = Window.partitionBy("m_source").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    ends = inside.groupBy("m_source", "part_tokens", "first", "u").agg(F.sum("tokens").alias("t")).withColumn(
        "spent", F.col("first") + F.coalesce(F.sum("t").over(ahead), F.lit(0))).filter("spent < part_tokens").groupBy(
        "m_source").agg(F.max("u").alias("end"))
    ends = {r["m_source"]: r["end"] for r in ends.collect()}  # a row per source
    final = spark.createDataFrame(
        [(s, e, w, ends.get(s, 1.0 if p > 0 else -1.0)) for s, e, w, _, p in rows],
        "m_source string, epochs double, whole int, part_end double")
    total = sum(s.epochs * s.tokens for s in mixture)
    return Plan(final, small, max(1, math.ceil(total / block_tokens)), seed)


def _slim(docs: DataFrame, id_col: str, text_col: str, source_col: str, carry: list[str]) -> DataFrame:
    return written(named(docs, id_col, text_col, source_col, token_count(F.col(text_col)).alias("tokens"),
                         F.struct(*carry).alias("row") if carry else F.lit(0).alias("row")), "mix-sizes")


def mix(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None,
        budget: float | None = None, seed: int = 7, block_tokens: int = BLOCK_TOKENS,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """row (struct of the ``carry`` columns, default all), epoch, tokens, place, block, turn.

    ``block`` and ``turn`` order the mixture. Columns that are not carried are
    read once and not moved.
    """
    slim = _slim(docs, id_col, text_col, source_col, carry or [])
    made = plan(slim, max_repeats, target_entropy, budget, seed, block_tokens)
    placed = made.of(slim if carry else named(docs, id_col, text_col, source_col, token_count(F.col(text_col)).alias("tokens"),
                                              F.struct("*").alias("row")))
    order = Window.partitionBy("block").orderBy("key", "id", "epoch")
    return placed.withColumn("turn", F.row_number().over(order)).select("row", "epoch", "tokens", "place", "block", "turn")


def mixture(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None,
            budget: float | None = None, seed: int = 7, block_tokens: int = BLOCK_TOKENS, partitions: int | None = None,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents themselves, as often as they are used: partition by partition in the mixture's order.

    A partition holds neighbouring blocks, each in its turn order (by a hash;
    ties by id and epoch). By default there are as many as shuffles have.
    """
    made = plan(_slim(docs, id_col, text_col, source_col, []), max_repeats, target_entropy, budget, seed, block_tokens)
    count = min(made.blocks, partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = made.of(named(docs, id_col, text_col, source_col, F.struct("*").alias("row")))
    dealt = placed.repartitionById(count, F.floor(F.col("block") * count / made.blocks).cast("int"))
    return dealt.sortWithinPartitions("block", "key", "id", "epoch").select("row.*")
