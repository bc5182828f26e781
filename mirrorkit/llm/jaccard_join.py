"""Size-aware heavy-light join of documents on the Jaccard similarity of word shingles.

Sets that are equal are one *class* from the start. Two classes link when
``100 * intersection >= 80 * union``. Classes are split by size:

*Small sets* (up to a boundary): a pair links exactly if it shares a subset of
a size that sets the ratio, so each class emits all its subsets of these sizes
and classes meet by subset. Nothing needs to be checked, and a bucket of equal
subsets is joined by a star, not by pairs.

*Large sets*: inverted lists over the tokens a linked partner must share one
of: the rarest ``n - ceil(0.8 n) + 1`` tokens in a common order. The order is by
counted frequency: shingles that repeat within ``CHUNK_TOKENS`` tokens of a task
(passages, boilerplate) are summed over all tasks in ``COUNTERS`` counters by
hash, and a shingle ranks by its counter, so lists of frequent shingles are
scanned only for sets that consist of little else, the rarer ones first. The
counters have one size whatever the table. The order is a matter of cost
alone: any common order gives the same links.

The boundary is the one with the least estimated rows, given how many sets
there are of each small size.

Candidate pairs of a list are not all formed. First each member is compared
with the list's centre (the set with the fewest rare shingles: an original
among its edited copies) and linked pairs are merged into components. Lists
that then lie in one component are done; in the others, members outside the
list's largest component are compared with all members of other components.
No link between different components can be missed, and pairs inside a
component need not be known. Before the sets of a pair are brought together, a
sketch of ``SKETCH`` counts per set bounds the intersection from above and
drops the pairs that cannot link.

Defined results: text null or without words: empty set, n_shingles 0, linked
with nothing; fewer than ``k`` words: the whole sequence as one shingle; rows
with a null id keep component null; rows equal in id and text are one
document (of an id with several texts each row gets its own text's component);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorkit.llm.common import map_batches, worker_caches, written
from mirrorkit.llm.components import components

WORDS = 5
#: Link if 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Counters below HEAVY rank alike; within a chunk of a task, shingles of LOCAL sets or more are counted.
HEAVY, LOCAL = 8, 2
CHUNK_TOKENS = 2_000_000
#: Counters by the shingle's hash (4 bytes each are broadcast).
COUNTERS = 1 << 22
#: Ids (8 bytes) up to which they are broadcast; beyond it the join shuffles.
BROADCAST_IDS = 2_000_000
#: Bytes of text whose shingles are named at once; a task holds some 60 times as much for a moment.
SLICE = 1 << 18
#: Bytes from which a text's shingles are named in parts.
LONG_TEXT = 1 << 22
BOUNDARIES = (0, 4, 9, 14)
#: Counts per sketch: shingles by the upper bits of their names.
SKETCH = 128
_M64 = (1 << 64) - 1
_RNG = np.random.default_rng(5)
_BYTES = _RNG.integers(1, _M64, 256, dtype=np.uint64)
_BASE = int(_RNG.integers(1 << 40, 1 << 62)) | 5
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    caches = worker_caches("jaccard")
    if len(caches.get("powers", ((),))[0]) < n:
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(n + n // 8, base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        caches["powers"] = tuple(made)
    return caches["powers"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(28))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _stretches(text: bytes, k: int) -> list[bytes]:
    """A long text in parts that share k - 1 words, so that together they have all its shingles."""
    words = text.split()
    step = 200_000
    return [b" ".join(words[at : at + step + k - 1]) for at in range(0, max(1, len(words) - k + 1), step)]


def shingle_sets(texts: list[bytes], k: int = WORDS) -> list[np.ndarray]:
    """Distinct shingle names (sorted unsigned 64-bit) of each text."""
    long_ = [i for i, t in enumerate(texts) if len(t) > LONG_TEXT]
    if long_:
        out = shingle_sets([b"" if len(t) > LONG_TEXT else t for t in texts], k)
        for i in long_:
            out[i] = np.unique(np.concatenate([_shingles([part], k)[0] for part in _stretches(texts[i], k)]))
        return out
    return _shingles(texts, k)


def _shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    letter = ~space
    first = np.flatnonzero(letter & np.append(True, space[:-1]))
    last = np.flatnonzero(letter & np.append(space[1:], True)) + 1
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=sums[1:])
    words = _mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    bounds = np.searchsorted(first, np.append(0, ends))
    out = []
    factors = power[1 : k + 1]
    if len(words) >= k:
        n = len(words) - k + 1
        rolled = words[:n] * factors[0]
        for i in range(1, k):
            rolled = rolled + words[i : i + n] * factors[i]
        rolled = _mix(rolled)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            short = words[a:b] * factors[: b - a]
            out.append(_mix(np.array([short.sum(dtype=np.uint64) + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of about ``SLICE`` bytes of text."""
    for batch in batches:
        column = batch.column("text")
        texts, start, size = [], 0, 0
        for i in range(batch.num_rows):
            texts.append(column[i].as_py() or b"")
            size += len(texts[-1])
            if size > SLICE or i == batch.num_rows - 1:
                yield batch.slice(start, i + 1 - start), texts
                texts, start, size = [], i + 1, 0


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    a = int(s.sum(dtype=np.uint64))
    b = int(_mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return a - (1 << 63), b - (1 << 63)


def least_overlap(a: int, b: int) -> int:
    """Smallest intersection with which sets of sizes a and b link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def subset_sizes(n: int) -> range:
    """Sizes of a set's subsets that can be an intersection with a linked set."""
    return range(-(-PERCENT * n // 100), n + 1)


def counter_of(names: np.ndarray) -> np.ndarray:
    return (_mix(names ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(COUNTERS)).astype(np.int64)


def _local_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(counter, n): sets that hold shingles of this counter, over shingles that repeat in a chunk of the task."""
    seen: set[tuple[int, int]] = set()
    totals: dict[int, int] = {}
    pending: list[np.ndarray] = []
    size = 0

    def count():
        names = np.concatenate(pending)
        pending.clear()
        names.sort()
        # Few names repeat, so only their counts are made.
        same = names[1:] == names[:-1]
        repeated, counts = np.unique(names[1:][same], return_counts=True)
        often = counts >= LOCAL - 1
        for counter, n in zip(counter_of(repeated[often]).tolist(), (counts[often] + 1).tolist()):
            totals[counter] = totals.get(counter, 0) + n

    for piece, texts in _text_batches(batches):
        for s in shingle_sets(texts):
            if len(s) and (f := _fingerprint(s)) not in seen:
                seen.add(f)
                pending.append(s)
                size += len(s)
        if size > CHUNK_TOKENS:
            count()
            size = 0
    if pending:
        count()
    yield pa.RecordBatch.from_arrays([pa.array(list(totals), type=pa.int64()), pa.array(list(totals.values()), type=pa.int64())],
                                     names=["counter", "n"])


def _prefixes(batches: Iterator[pa.RecordBatch], counters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Size, fingerprint, number of light shingles and prefix of each set."""
    for piece, texts in _text_batches(batches):
        n, f1, f2, light, prefix, sketch = [], [], [], [], [], []
        for s in shingle_sets(texts):
            n.append(len(s))
            counts = np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=SKETCH)
            sketch.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
            a, b = _fingerprint(s)
            f1.append(a)
            f2.append(b)
            rank = counters[counter_of(s)]
            light.append(int((rank == 0).sum()))
            s = s[np.argsort(rank, kind="stable")]  # ties by name
            prefix.append(s[: prefix_length(len(s))].view(np.int64) if len(s) else s.view(np.int64))
        yield pa.RecordBatch.from_arrays([
            piece.column("doc_id"), pa.array(n, type=pa.int64()), pa.array(f1, type=pa.int64()),
            pa.array(f2, type=pa.int64()), pa.array(light, type=pa.int64()), pa.array(prefix, type=pa.list_(pa.int64())),
            pa.array(sketch, type=pa.binary())],
            names=["doc_id", "n", "f1", "f2", "light", "prefix", "sketch"])


def _subsets(batches: Iterator[pa.RecordBatch], boundary: int) -> Iterator[pa.RecordBatch]:
    """Names of all subsets of each small set that can be an intersection with a linked one."""
    for piece, texts in _text_batches(batches):
        rows = []
        for doc_id, s in zip(piece.column("doc_id").to_pylist(), shingle_sets(texts)):
            if len(s) > boundary:
                continue
            names = _mix(s)
            for m in subset_sizes(len(s)):
                for left in combinations(range(len(s)), len(s) - m):
                    rest = np.delete(names, left)
                    rows.append((doc_id, len(s), m, int(rest.sum(dtype=np.uint64)) - (1 << 63),
                                 int(_mix(rest).sum(dtype=np.uint64)) - (1 << 63)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows)],
                                             names=["doc_id", "n", "m", "s1", "s2"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in _text_batches(batches):
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(texts)], type=pa.binary())],
            names=["doc_id", "tokens"])


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches allow the least intersection; a full count stands for any."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, SKETCH).astype(np.int64)
                for c in ("x", "y"))
        n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "m"))
        most = np.minimum(np.where(x == 255, 1 << 40, x), np.where(y == 255, 1 << 40, y)).sum(axis=1)
        at = pa.array(np.flatnonzero((100 + PERCENT) * most >= PERCENT * (n + m)))
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
            x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            if int((both[1:] == both[:-1]).sum()) >= least_overlap(len(x), len(y)):
                keep.append(i)
        at = pa.array(keep, type=pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])


def choose_boundary(sizes: dict[int, int], rows_per_token: float = 4.0) -> int:
    """The boundary with the least rows, from the number of sets of each small size."""
    def cost(limit):
        small = sum(c * sum(comb(n, m) for m in subset_sizes(n)) for n, c in sizes.items() if n <= limit)
        return small + sum(c * prefix_length(n) * rows_per_token for n, c in sizes.items() if n > 0.8 * limit)
    return min(BOUNDARIES, key=cost)


def _joined(pairs: DataFrame, values: DataFrame, mine: dict[str, str], others: dict[str, str]) -> DataFrame:
    """Pairs (a, b) with columns of ``values`` (by doc_id) of both, under new names."""
    left = values.select(F.col("doc_id").alias("a"), *[F.col(c).alias(n) for c, n in mine.items()])
    right = values.select(F.col("doc_id").alias("b"), *[F.col(c).alias(n) for c, n in others.items()])
    return pairs.join(left, "a").join(right, "b")


def linked(pairs: DataFrame, text: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link.

    Sets are made again, for ids of promising pairs only, and go through one
    exchange that both sides of the pairs read; they are not written.
    """
    promising = written(_joined(pairs, sketches, {"n": "n", "sketch": "x"}, {"n": "m", "sketch": "y"}).select(
        "a", "b", "n", "m", "x", "y").mapInArrow(_may_link, "a bigint, b bigint").distinct(), "jaccard-promising")
    ids = written(promising.select(F.col("a").alias("doc_id")).unionByName(
        promising.select(F.col("b").alias("doc_id"))).distinct(), "jaccard-ids")
    sets = map_batches(only(text, ids), _sets, "doc_id bigint, tokens binary")
    return _joined(promising, sets, {"tokens": "x"}, {"tokens": "y"}).select("a", "b", "x", "y").mapInArrow(
        _verify, "a bigint, b bigint").distinct()


def only(rows: DataFrame, wanted: DataFrame, column: str = "doc_id") -> DataFrame:
    """Rows with a value of ``column`` in ``wanted``, broadcast if that is small."""
    small = wanted.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(wanted) if small else wanted, column, "left_semi")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable by links)."""
    text = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    often = map_batches(text, _local_counts, "counter bigint, n bigint").groupBy("counter").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= HEAVY).toArrow()  # at most COUNTERS rows
    counters = np.zeros(COUNTERS, dtype=np.uint32)
    counters[often.column("counter").to_numpy()] = np.minimum(often.column("n").to_numpy(), (1 << 32) - 1)
    shared = text.sparkSession.sparkContext.broadcast(counters)
    rows = written(map_batches(
        text, lambda it: _prefixes(it, shared.value),
        "doc_id bigint, n bigint, f1 bigint, f2 bigint, light bigint, prefix array<bigint>, sketch binary").withColumn(
        "row", F.monotonically_increasing_id()), "jaccard-sets")

    # One row stands for all with its set.
    key = ["n", "f1", "f2"]
    classes = written(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(
        F.min(F.struct("doc_id", "row")).alias("rep")).select(*key, "rep.*").withColumnRenamed("doc_id", "rep"),
        "jaccard-classes")
    sizes = {r["n"]: r["c"] for r in classes.filter(f"n <= {2 * max(BOUNDARIES)}").groupBy("n").agg(
        F.count(F.lit(1)).alias("c")).collect()}
    boundary = choose_boundary(sizes)

    small_ids = classes.filter(F.col("n") <= boundary).select(F.col("rep").alias("doc_id")).distinct()
    subsets = written(map_batches(
        only(text, small_ids), lambda it: _subsets(it, boundary), "doc_id bigint, n bigint, m bigint, s1 bigint, s2 bigint").distinct(),
        "jaccard-subsets")
    # All sets of a bucket share m shingles: any two whose sizes allow it link.
    # The least size links with whatever can link at all in the bucket; sets of
    # the same size link with each other through it or, if large enough, alone.
    buckets = subsets.groupBy("m", "s1", "s2").agg(
        F.min(F.struct("n", "doc_id")).alias("low"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    small_links = subsets.join(buckets, ["m", "s1", "s2"]).filter("doc_id <> low.doc_id").filter(
        (100 + PERCENT) * F.col("m") >= PERCENT * (F.col("n") + F.col("low.n"))).select(
        F.col("low.doc_id").alias("a"), F.col("doc_id").alias("b"))

    # A linked partner of a set beyond the boundary has at least this size.
    least = -(-PERCENT * (boundary + 1) // 100)
    large = classes.filter(F.col("n") >= least).select("row")
    tokens = only(rows.filter(F.col("n") >= least), large, "row").select(
        "doc_id", "n", "light", F.posexplode("prefix").alias("pos", "token"))
    lists = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "jaccard-lists")
    few = lists.count() <= BROADCAST_IDS
    posts = written(tokens.join(F.broadcast(lists) if few else lists, "token"), "jaccard-posts")
    centres = posts.groupBy("token").agg(F.min(F.struct(
        (F.col("light") / F.col("n")).alias("share"), "doc_id", "n", "pos")).alias("centre")).select(
        "token", F.col("centre.doc_id").alias("centre"), F.col("centre.n").alias("n_b"), F.col("centre.pos").alias("pos_b"))

    # No token before the first shared one is in both sets; a linked pair passes by that token.
    overlap = F.least(F.col("n") - F.col("pos"), F.col("n_b") - F.col("pos_b"))
    possible = (100 * F.least("n", "n_b") >= PERCENT * F.greatest("n", "n_b")) & (
        (100 + PERCENT) * overlap >= PERCENT * (F.col("n") + F.col("n_b")))
    star = written(posts.join(centres, "token").filter("doc_id <> centre").filter(possible).select(
        F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct(), "jaccard-pairs")
    sketches = only(rows, large, "row").select("doc_id", "n", "sketch")
    links = written(linked(star, text, sketches).unionByName(small_links), "jaccard-links")

    merged = written(components(links), "jaccard-merged")
    # A list of two is done: its only pair has been compared.
    known = posts.filter("c > 2").join(merged, F.col("doc_id") == F.col("vertex"), "left").select(
        "token", "doc_id", "n", "pos", F.coalesce("component", "doc_id").alias("part"))
    per_part = known.groupBy("token", "part").agg(F.count(F.lit(1)).alias("c"))
    mixed = per_part.groupBy("token").agg(
        F.max_by("part", F.struct("c", "part")).alias("most"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("token", "most")
    known = written(known.join(mixed, "token"), "jaccard-open")
    other = known.select("token", F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"), F.col("part").alias("part_b"))
    rest = known.filter("part <> most").withColumnRenamed("doc_id", "a").join(other, "token").filter(
        F.col("part") != F.col("part_b")).filter((F.col("part_b") == F.col("most")) | (F.col("a") < F.col("b"))).filter(possible)
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = linked(written(rest.join(tried, ["a", "b"], "left_anti"), "jaccard-rest"), text, sketches)
    # Links found so far are known by their components.
    final = components(written(merged.select(F.col("vertex").alias("a"), F.col("component").alias("b")).unionByName(more),
                               "jaccard-links"))

    named = classes.join(final, F.col("rep") == F.col("vertex"), "left").select(
        *key, F.coalesce("component", "rep").alias("component_id"))
    placed = rows.select("doc_id", *key).join(named, key, "left")
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
