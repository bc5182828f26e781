"""Repeated passages by longest-previous-factor arrays over suffix orders.

A position's longest previous factor is the longest string starting there that
also starts at an earlier position; in suffix order its source is the previous
or next entry with a smaller position. A string of ``length`` bytes that starts
at a position and earlier too is a factor of at least that length, so later
copies are the positions whose factor reaches ``length``, and first copies
those whose longest *following* factor (the same with positions reversed) does.

One suffix order of all documents would shuffle many times the text. So:

1. Each window of ``length`` bytes has an *anchor*: its gram of ``GRAM`` bytes
   with the least hash. Neighbouring windows share anchors; a *run* is a
   stretch of windows with one anchor (about 75 windows). Equal windows have
   equal anchors, so a window can repeat only in runs whose grams are equal.
   Runs with their gram and the name of their whole text are written to a
   table; grams that occur once are dropped at once.
2. A run whose whole text occurs again elsewhere repeats with all its windows.
3. Grams with runs of different texts (edges of copies, edits) get the text of
   one run of each kind, about 300 bytes. Rows are dealt by gram and sorted;
   a task takes whole grams until they fill a buffer and puts the buffer's
   suffixes in order (prefix doubling, from eight bytes on). Common prefixes of
   neighbours follow from the orders of the rounds, and one pass over the
   neighbours gives the longest previous factors (previous and next smaller
   positions on a stack).
4. A gram with more than ``MAX_GROUP`` kinds of run (a passage in very many
   different surroundings) is too large for one buffer: its windows are named
   one by one and dealt by name instead, with the same outcome.

Removed bytes are the union of the decided windows. ``keep="none"`` removes
every occurrence, ``keep="first"`` all but the first in order of (id, offset).

Defined results: a null text is an empty one; texts shorter than ``length``
are kept whole; rows equal in id and text share their decision (with
``keep="first"`` both stay whole where they are first); a null id is an id
before all others; an empty table gives no rows; columns other than the id and
text column are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorkit.llm.common import map_batches, slices, text_once, texts_of, worker_caches, written

LENGTH = 200
GRAM = 48
#: Rows up to which a side is broadcast (at most 100 bytes each); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Kinds of run of a gram that one task takes together (at most 352 bytes each).
MAX_GROUP = 4096
_SEGMENT = 1 << 19  # window starts of a part of a long text; positions fit in _POS_BITS
#: Bytes of short texts gone through at once, and of runs whose suffixes are put in order at once
#: (whole grams, so one more gram at most): a task holds some 100 times as much for a moment.
_BATCH = 1 << 18
_BUFFER = 1 << 17
_POS_BITS = 20
_M64 = (1 << 64) - 1


class Rolling:
    """Polynomial names of substrings modulo 2**64, from one running sum.

    Bytes are mapped to random 64-bit values first; the base is odd, so its
    powers have inverses.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.seed = seed
        self.values = rng.integers(1, _M64, 256, dtype=np.uint64)
        self.base = int(rng.integers(1 << 40, 1 << 62)) | 5

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        caches = worker_caches("lpf")
        if self.seed not in caches or len(caches[self.seed][0]) < n:
            made = []
            for base in (self.base, pow(self.base, -1, 1 << 64)):
                steps = np.full(n + n // 8, base, dtype=np.uint64)
                steps[0] = 1
                made.append(np.cumprod(steps, dtype=np.uint64))
            caches[self.seed] = tuple(made)
        return caches[self.seed]

    def sums(self, data: np.ndarray) -> np.ndarray:
        powers, _ = self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * powers[: len(data)], out=out[1:])
        return out

    def names(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, inverses = self._powers(len(sums))
        return mix((sums[end] - sums[start]) * inverses[start])

    def names_of_length(self, sums: np.ndarray, length: int) -> np.ndarray:
        _, inverses = self._powers(len(sums))
        n = len(sums) - length
        return mix((sums[length:] - sums[:n]) * inverses[:n])


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_FIRST, _SECOND = Rolling(11), Rolling(23)


def runs_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(start, windows, gram, name) of the runs of the texts laid end to end in ``data``.

    ``ends`` holds each text's end. Windows never cross an end. At most
    2**20 bytes at once.
    """
    if len(data) < length:
        return [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0, dtype=np.uint64)] * 2
    sums = _FIRST.sums(data)
    grams = _FIRST.names_of_length(sums, gram)
    low = np.uint64((1 << _POS_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = length - gram + 1  # grams in a window
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    anchor = (least & low).astype(np.int64)
    # A window is valid if its text doesn't end inside it.
    text_end = np.repeat(ends, np.diff(ends, prepend=0))[: len(anchor)]
    valid = np.flatnonzero(np.arange(len(anchor)) + length <= text_end)
    if not len(valid):
        return [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0, dtype=np.uint64)] * 2
    at = anchor[valid]
    new = np.empty(len(valid), dtype=bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
    first = np.flatnonzero(new)
    start = valid[first]
    windows = np.diff(np.append(first, len(valid)))
    stop = start + windows + (length - 1)
    # The anchor's place in the run belongs to the gram: windows match only at the same place.
    return start, windows, grams[at[first]], _FIRST.names(sums, start, stop)


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]]:
    """Batches of texts or parts of them: ([(row, offset, place)], data, ends)."""
    parts: list[tuple[int, int]] = []
    chunks: list[bytes] = []
    size = 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), _SEGMENT):
            chunk = text[at : at + _SEGMENT + length - 1]
            if parts and size + len(chunk) > _BATCH:
                yield _segment_batch(parts, chunks)
                parts, chunks, size = [], [], 0
            parts.append((row, at))
            chunks.append(chunk)
            size += len(chunk)
    if parts:
        yield _segment_batch(parts, chunks)


def _segment_batch(parts, chunks):
    ends = np.cumsum([len(c) for c in chunks])
    return parts, np.frombuffer(b"".join(chunks), dtype=np.uint8), ends


def _emit_runs(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("start", pa.int64()),
                        ("windows", pa.int64()), ("gram", pa.int64()), ("name", pa.int64())])
    for piece in slices(batches, 256):
        texts = [t or b"" for t in piece.column("text").to_pylist()]
        for parts, data, ends in _segments(texts, length):
            start, windows, grams, names = runs_of(data, ends, length, gram)
            part = np.searchsorted(ends, start, side="right")
            row = np.array([p[0] for p in parts], dtype=np.int64)[part]
            shift = np.array([p[1] for p in parts], dtype=np.int64)[part] - np.append(0, ends[:-1])[part]
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id").take(pa.array(row)), piece.column("key").take(pa.array(row)),
                pa.array(start + shift), pa.array(windows.astype(np.int64)),
                pa.array(grams.view(np.int64)), pa.array(names.view(np.int64))], schema=schema)


def _emit_open_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The text of each listed run."""
    for batch in slices(batches, 256):
        texts = batch.column("text")
        rows, runs_, pieces = [], [], []
        for row, runs in enumerate(batch.column("runs").to_pylist()):
            text = texts[row].as_py()
            for run in runs:
                rows.append(row)
                runs_.append(run)
                pieces.append(text[run["start"] : run["start"] + run["windows"] + length - 1])
            if len(rows) > 4000 or (rows and row == batch.num_rows - 1):
                at = pa.array(rows, type=pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["gram"] for r in runs_], type=pa.int64()),
                    pa.array([r["hot"] for r in runs_], type=pa.bool_()),
                    batch.column("doc_id").take(at), batch.column("key").take(at),
                    pa.array([r["start"] for r in runs_], type=pa.int64()), pa.array(pieces, type=pa.binary())],
                    names=["gram", "hot", "doc_id", "key", "start", "text"])
                rows, runs_, pieces = [], [], []


def _window_names(pieces: list[bytes], length: int):
    """(piece, place in the piece, name, second name) of every window of the pieces."""
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    sizes = np.array([len(x) for x in pieces])
    ends = np.cumsum(sizes)
    n1 = _FIRST.names_of_length(_FIRST.sums(data), length)
    n2 = _SECOND.names_of_length(_SECOND.sums(data), length)
    which = np.repeat(np.arange(len(pieces)), sizes)[: len(n1)]
    at = np.arange(len(n1))
    ok = np.flatnonzero(at + length <= ends[which])
    which = which[ok]
    return which, ok - (ends - sizes)[which], n1[ok], n2[ok]


def suffix_ranks(data: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, 32 ... bytes, up to their ends.

    ``left`` is how many bytes a suffix has. The last ranks are the suffix
    order; suffixes that are equal to their ends have equal ranks.
    """
    n = len(data)
    key = np.zeros(n, dtype=np.uint64)
    for b in range(8):
        here = np.zeros(n, dtype=np.uint64)
        here[: max(0, n - b)] = data[b:]
        key = (key << np.uint64(8)) | np.where(left > b, here, np.uint64(0))
    _, rank = np.unique(key, return_inverse=True)
    if (data == 0).any():  # ended suffixes come before longer ones that go on with zero bytes
        _, rank = np.unique(rank * 9 + np.minimum(left, 8), return_inverse=True)
    ranks = [rank.astype(np.int32)]
    size, longest = 8, int(left.max(initial=0))
    while size < longest and int(ranks[-1].max(initial=0)) + 1 < n:
        then = np.zeros(n, dtype=np.int64)
        then[: max(0, n - size)] = ranks[-1][size:] + 1
        then[left <= size] = 0
        _, rank = np.unique(ranks[-1].astype(np.int64) * (n + 1) + then, return_inverse=True)
        ranks.append(rank.ravel().astype(np.int32))
        size *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray], data: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes ``a[i]`` and ``b[i]``."""
    out = np.zeros(len(a), dtype=np.int64)
    most = np.minimum(left[a], left[b])

    def grow(step, equal):
        fits = np.flatnonzero(out + step <= most)
        same = fits[equal(a[fits] + out[fits], b[fits] + out[fits])]
        out[same] += step
        return len(same)

    for level in range(len(ranks) - 1, -1, -1):
        while grow(8 << level, lambda x, y: ranks[level][x] == ranks[level][y]) and level == len(ranks) - 1:
            pass
    for _ in range(7):
        if not grow(1, lambda x, y: data[x] == data[y]):
            break
    return out


def longest_previous(position: list[int], common: list[int]) -> list[int]:
    """Longest previous factors, given positions in suffix order and the common prefix of each entry with the one before.

    The stack holds entries with rising positions: below an entry is its
    previous smaller position, and what pops it is its next smaller one.
    """
    out = [0] * len(position)
    stack: list[tuple[int, int, int]] = []  # place, position, common prefix with the entry below
    for place, at in enumerate([*position, -1]):
        shared = common[place] if 0 < place < len(position) else 0
        while stack and stack[-1][1] > at:
            top, _, below = stack.pop()
            out[top] = below if below > shared else shared
            shared = below if below < shared else shared
        stack.append((place, at, shared))
    return out


def repeated_suffixes(pieces: list[bytes], length: int, keep: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, place in it, decided) of the windows of pieces that come in order of position.

    ``keep="first"``: decided are windows whose longest previous factor has
    ``length`` bytes; ``keep="none"``: or whose longest following factor has.
    """
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    sizes = np.array([len(x) for x in pieces])
    ends = np.cumsum(sizes)
    which = np.repeat(np.arange(len(pieces)), sizes)
    left = ends[which] - np.arange(len(data))
    ranks = suffix_ranks(data, left)
    windows = np.flatnonzero(left >= length)
    order = windows[np.argsort(ranks[-1][windows], kind="stable")]
    common = np.zeros(len(order), dtype=np.int64)
    common[1:] = common_prefixes(ranks, data, left, order[:-1], order[1:])
    # Entries that share less than a window with both neighbours have no factor of that length.
    near = np.flatnonzero((common >= length) | np.append(common[1:] >= length, False))
    position, shared = order[near].tolist(), np.where(common[near] >= length, common[near], 0).tolist()
    hit = np.array(longest_previous(position, shared), dtype=np.int64) >= length
    if keep == "none":
        hit |= np.array(longest_previous([len(data) - p for p in position], shared), dtype=np.int64) >= length
    decided = np.zeros(len(data), dtype=bool)
    decided[order[near[hit]]] = True
    return which[windows], windows - (ends - sizes)[which[windows]], decided[windows]


def _decide(batches: Iterator[pa.RecordBatch], keep: str, length: int) -> Iterator[pa.RecordBatch]:
    """Stretches of repeated windows; rows come sorted by gram and position."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("start", pa.int64()), ("windows", pa.int64())])

    def out(rows):
        which, place, decided = repeated_suffixes([r[4] for r in rows], length, keep)
        hit = np.flatnonzero(decided)
        if not len(hit):
            return None
        new = np.append(True, (hit[1:] != hit[:-1] + 1) | (which[hit[1:]] != which[hit[:-1]]))
        first = np.flatnonzero(new)
        windows = np.diff(np.append(first, len(hit)))
        row = which[hit[first]]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[r][1] for r in row], type=pa.int64()), pa.array([rows[r][2] for r in row], type=pa.binary()),
            pa.array([rows[r][3] + int(p) for r, p in zip(row, place[hit[first]])], type=pa.int64()),
            pa.array(windows, type=pa.int64())], schema=schema)

    rows, size = [], 0
    for batch in slices(batches, 2000):
        columns = [batch.column(c).to_pylist() for c in ("gram", "doc_id", "key", "start", "text")]
        for row in zip(*columns):
            if size > _BUFFER and row[0] != rows[-1][0]:
                if (found := out(rows)) is not None:
                    yield found
                rows, size = [], 0
            rows.append(row)
            size += len(row[4])
    if rows and (found := out(rows)) is not None:
        yield found


def _emit_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Names of all windows of runs."""
    for piece in slices(batches, 500):
        which, place, n1, n2 = _window_names(piece.column("text").to_pylist(), length)
        row = pa.array(which)
        start = np.asarray(piece.column("start").to_numpy(zero_copy_only=False))[which] + place
        yield pa.RecordBatch.from_arrays([
            piece.column("doc_id").take(row), piece.column("key").take(row), pa.array(start),
            pa.array(n1.view(np.int64)), pa.array(n2.view(np.int64))],
            names=["doc_id", "key", "start", "n1", "n2"])


def remove_ranges(text: bytes, ranges: list, length: int = LENGTH, characters: bool = False) -> tuple[bytes, int]:
    """(kept bytes, removed maximal runs) for ranges (start, windows) of removed windows.

    With ``characters``, a UTF-8 character at the edge of a run goes with it.
    """
    kept, at, spans, end = [], 0, 0, -1
    for start, windows in sorted(ranges):
        stop = start + windows + length - 1
        while characters and start > at and text[start] & 0xC0 == 0x80:
            start -= 1
        while characters and stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop += 1
        if start > end:
            spans += 1
            kept.append(text[at:start])
        at = end = max(end, stop)
    kept.append(text[at:])
    return b"".join(kept), spans


def _apply(batches: Iterator[pa.RecordBatch], text_col: str, length: int, characters: bool) -> Iterator[pa.RecordBatch]:
    types = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
             ("kept_sha256", pa.string()), ("kept", pa.binary())]
    for piece in slices(batches, 512):
        rows = []
        for text, ranges in zip(texts_of(piece, text_col), piece.column("ranges").to_pylist()):
            kept, spans = remove_ranges(text, [(r["start"], r["windows"]) for r in ranges or ()], length, characters)
            rows.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
        yield pa.RecordBatch.from_arrays(
            [piece.column("row"), *(pa.array(c, type=t) for c, (_, t) in zip(zip(*rows), types))],
            names=["row", *(n for n, _ in types)])


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, broadcast if it is known to be small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def repeated_windows(docs: DataFrame, keep: str = "none", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, key, start, windows): stretches of window starts to be removed.

    ``docs`` has doc_id, key (a digest of the text) and text (bytes).
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    runs = written(map_batches(
        docs, lambda it: _emit_runs(it, length, gram),
        "doc_id bigint, key binary, start bigint, windows bigint, gram bigint, name bigint"), "lpf-runs")

    twice = written(runs.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "lpf-grams")
    runs = written(runs.join(_small(twice, twice.count()), "gram", "left_semi"), "lpf-candidates")

    place = F.struct("doc_id", "key", "start")
    texts = written(runs.groupBy("gram", "name").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "key", "start", "windows")).alias("first")), "lpf-texts")

    # Runs that occur again as a whole.
    whole = texts.filter("n > 1").select("gram", "name", F.struct("first.doc_id", "first.key", "first.start").alias("source"))
    again = runs.join(whole, ["gram", "name"])
    if keep == "first":
        again = again.filter(~place.eqNullSafe(F.col("source")))
    again = again.select("doc_id", "key", "start", "windows")

    # Grams with runs of several kinds: the text of one run of each kind.
    several = texts.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "gram", (F.col("n") > MAX_GROUP).alias("hot"))
    open_runs = texts.join(several, "gram").select("first.*", "gram", "hot")
    lists = written(open_runs.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("start", "windows", "gram", "hot")).alias("runs")), "lpf-open")
    listed = lists.agg(F.sum(F.size("runs"))).first()[0] or 0
    lists = _small(lists.withColumnsRenamed({"doc_id": "o_id", "key": "o_key"}), 8 * lists.count())
    opened = docs.join(lists, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("key") == F.col("o_key")))
    pieces = written(map_batches(
        opened.select("doc_id", "key", "text", "runs"), lambda it: _emit_open_runs(it, length),
        "gram bigint, hot boolean, doc_id bigint, key binary, start bigint, text binary"), "lpf-pieces")
    if pieces.count() > listed:  # repeated rows: the same place, once for each
        pieces = pieces.dropDuplicates(["gram", "doc_id", "key", "start"])
    stretch = "doc_id bigint, key binary, start bigint, windows bigint"
    dealt = pieces.filter("NOT hot").drop("hot").repartition("gram").sortWithinPartitions("gram", "doc_id", "key", "start")
    decided = map_batches(dealt, lambda it: _decide(it, keep, length), stretch)

    windows = pieces.filter("hot").select("doc_id", "key", "start", "text").mapInArrow(
        lambda it: _emit_windows(it, length), "doc_id bigint, key binary, start bigint, n1 bigint, n2 bigint")
    names = windows.groupBy("n1", "n2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("source")).filter("n > 1")
    single = windows.join(names, ["n1", "n2"])
    if keep == "first":
        single = single.filter(~place.eqNullSafe(F.col("source")))
    single = single.select("doc_id", "key", "start", F.lit(1).cast("bigint").alias("windows"))

    # Stretches that touch become one (the windows of a text, at most).
    order = Window.partitionBy("doc_id", "key").orderBy("start", "windows")
    seen = F.max(F.col("start") + F.col("windows")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    joined = again.unionByName(decided).unionByName(single).withColumn("new", F.coalesce((F.col("start") > seen).cast("int"), F.lit(1)))
    joined = joined.withColumn("stretch", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return joined.groupBy("doc_id", "key", "stretch").agg(
        F.min("start").alias("start"), (F.max(F.col("start") + F.col("windows")) - F.min("start")).alias("windows")
    ).drop("stretch")


def dedup_passages(docs: DataFrame, keep: str = "none", length: int = LENGTH,
                   id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                   characters: bool = False) -> DataFrame:
    """row (struct of the ``carry`` columns, by default all), n_bytes, n_removed, n_spans, kept_sha256, kept (bytes).

    ``characters`` widens each cut to whole UTF-8 characters.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    wide = docs.select(F.struct(*(carry or docs.columns)).alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
                       F.unhex(F.md5(body)).alias("key"), body.alias("text"))
    ranges = written(repeated_windows(wide.drop("row"), keep, length).groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("start", "windows")).alias("ranges")), "lpf-ranges")
    ranges = _small(ranges.withColumnsRenamed({"doc_id": "r_id", "key": "r_key"}), 2 * ranges.count())
    joined = wide.join(ranges, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left")
    row = wide.schema["row"].dataType.simpleString()
    return map_batches(
        text_once(joined, text_col, "ranges"), lambda it: _apply(it, text_col, length, characters),
        f"row {row}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
