"""Harmonic packing of token sequences.

Class ``j`` takes pieces whose length lies in ``(C/(j+1), C/j]`` of the
capacity ``C``; a bin of class ``j`` always takes exactly ``j`` pieces. So a
bin's content is settled by counting alone, and each task fills its bins
without hearing of the others. Documents may be cut: a piece that would waste
more than ``1/SLACK`` of its slot is cut to the exact slot of the next class,
and the rest is treated the same way.

1. Each task tokenizes its documents, cuts them and fills its own bins. The
   pieces are written to a table, with their ids.
2. Pieces of bins a task left incomplete are numbered per class over all tasks
   (offsets from counts per task and class) and fill common bins.
3. What is then left is less than one bin per class: at most ``max_tail(C)``
   pieces whatever the corpus, packed first-fit by falling length.

Defined results: a null text is an empty one (its document is the end id
alone); an empty table gives no rows; repeated rows are packed once each;
columns other than the id and text column are ignored; a null id stays null.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorkit.llm.common import map_batches, worker_caches, written

CAPACITY = 2048
SLACK = 64
END_ID = 1

PIECE_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, ids_crc32 bigint, "
    "class int, part bigint, bin bigint, offset bigint, seq bigint"
)


def cut(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of a document of ``tokens`` ids."""
    out = []
    start = 0
    while tokens - start >= capacity:
        out.append((start, capacity, 1))
        start += capacity
    rest = tokens - start
    while rest > 0:
        cls = capacity // rest
        slot = capacity // cls
        if rest * 32 > capacity and (slot - rest) * SLACK > slot:
            cls += 1
            size = capacity // cls
        else:
            size = rest
        out.append((start, size, cls))
        start += size
        rest -= size
    return out


def max_tail(capacity: int = CAPACITY) -> int:
    """Bound on the pieces left in the incomplete bins of all classes together."""
    return sum(j - 1 for j in {capacity // n for n in range(1, capacity + 1)} | set(range(1, 34)))


class WordTokenizer(dict):
    """Ids of a text as little-endian 32-bit bytes; a dictionary from word to ids.

    The vocabulary never spans a blank, so a text's ids are those of its words
    one after another. Words are split at ASCII white space, which is white
    space for the vocabulary's rule too. A word of letters alone is one unit
    of that rule and goes to the model as it is, in lower case; marks at a
    word's end are a unit of their own; any other word takes the full way. At
    ``MAX_WORDS`` words the dictionary starts anew.
    """

    MAX_WORDS = 1_000_000
    MAX_BYTES = 48
    MARKS = b".,;:!?"

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # The byte-level alphabet: printable Latin-1 stands for itself, the rest for 256 and up.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.alphabet = {b: 256 + n for n, b in enumerate(others)}

    def __missing__(self, word: bytes) -> bytes:
        units = self._letters(word)
        if units is not None:
            ids = array("I", [t.id for t in self.model.tokenize(units)]).tobytes()
        else:
            stem = word.rstrip(self.MARKS)
            if stem and len(stem) < len(word) and self._letters(stem) is not None:
                ids = self[stem] + self[word[len(stem):]]
            else:
                found = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
                ids = array("I", found).tobytes()
        if len(word) <= self.MAX_BYTES:
            if len(self) >= self.MAX_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def _letters(self, word: bytes) -> str | None:
        """A word of Latin letters as the model's units; None for any other."""
        if len(word) > self.MAX_BYTES:
            return None
        if word.isalpha():  # ASCII letters
            return word.lower().decode("ascii")
        text = word.decode("utf-8", "replace")
        if not text.isalpha() or max(text) > "\u024f" or "\u0130" in text:
            return None
        return text.lower().encode().decode("latin-1").translate(self.alphabet)

    def encode(self, text: bytes) -> bytes:
        ids = b"".join(map(self.__getitem__, text.split()))
        return ids if sys.byteorder == "little" else np.frombuffer(ids, "=u4").astype("<u4").tobytes()


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer (and word cache) per Python worker."""
    caches = worker_caches("packing")
    if path not in caches:
        caches[path] = WordTokenizer(path)
    return caches[path]


def _fill(batches: Iterator[pa.RecordBatch], path: str, capacity: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    tok = tokenizer(path)
    end = np.array([END_ID], dtype="<u4").tobytes()
    open_bins: dict[int, list] = {}
    n_bins = 0
    rows: list[tuple] = []

    def emit():
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            piece = batch.slice(at, 64)
            doc_ids = piece.column(0).to_pylist()
            for doc_id, text in zip(doc_ids, piece.column(1).to_pylist()):
                raw = tok.encode(text or b"") + end
                total = len(raw) // 4
                for start, length, cls in cut(total, capacity):
                    ids = raw[4 * start : 4 * (start + length)]
                    bin_ = open_bins.setdefault(cls, [])
                    bin_.append((doc_id, start, length, total, ids, zlib.crc32(ids), cls, part))
                    if len(bin_) == cls:
                        at_token = 0
                        for p in bin_:
                            rows.append((*p, n_bins, at_token, None))
                            at_token += p[2]
                        n_bins += 1
                        open_bins[cls] = []
            if len(rows) > 500:
                yield emit()
                rows.clear()
    for cls, bin_ in open_bins.items():
        rows.extend((*p, None, None, n) for n, p in enumerate(bin_))
    if rows:
        yield emit()


def piece_table(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenized, cut and locally binned pieces, written to a shared table."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
        ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("class", pa.int32()), ("part", pa.int64()),
        ("bin", pa.int64()), ("offset", pa.int64()), ("seq", pa.int64()),
    ])

    def run(batches):
        return _fill(batches, tokenizer_path, capacity, schema)

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return written(map_batches(slim, run, PIECE_SCHEMA), "pieces")


def _first_fit(capacity: int):
    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        room: list[int] = []
        bins, offsets = [], []
        for length in pdf["length"]:
            at = next((i for i, r in enumerate(room) if r >= length), None)
            if at is None:
                at = len(room)
                room.append(capacity)
            bins.append(at)
            offsets.append(capacity - room[at])
            room[at] -= length
        return pd.DataFrame({**{c: pdf[c] for c in ("doc_id", "start", "length", "doc_tokens", "ids", "ids_crc32", "class")},
                             "sequence_id": [TAIL_BASE + b for b in bins], "offset": offsets})
    return run


#: Sequence ids: a task's own bins, then common bins per class, then the tail.
COMMON_BASE = 1 << 60
TAIL_BASE = 1 << 62
OUT = ("doc_id", "start", "length", "doc_tokens", "ids", "ids_crc32", "class", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Returns doc_id, start, length, doc_tokens, ids (little-endian 32-bit
    bytes), ids_crc32, class, sequence_id, offset. Sequence ids are unique,
    not consecutive.
    """
    pieces = piece_table(docs, tokenizer_path, capacity, id_col, text_col)
    own = pieces.filter("bin IS NOT NULL").withColumn(
        "sequence_id", F.expr("part * 4294967296 + bin")).select(*OUT)

    left = pieces.filter("bin IS NULL").drop("bin", "offset")
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = left.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row per task and class: what other tasks have left, not their pieces.
    places = counts.select(
        "class", "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.sum("n").over(Window.partitionBy("class")).alias("class_n"),
    )
    ranked = left.join(places, ["class", "part"]).withColumn("rank", F.col("first") + F.col("seq")).withColumn(
        "bin", F.floor(F.col("rank") / F.col("class"))).withColumn(
        "whole", F.expr("(bin + 1) * class <= class_n"))
    within = Window.partitionBy("class", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    common = ranked.filter("whole").withColumn(
        "sequence_id", F.lit(COMMON_BASE) + F.col("class").cast("bigint") * F.lit(1 << 40) + F.col("bin")).withColumn(
        "offset", F.coalesce(F.sum("length").over(within), F.lit(0))).select(*OUT)

    tail = ranked.filter("NOT whole").select(*[c for c in OUT if c not in ("sequence_id", "offset")])
    packed_tail = tail.groupBy(F.lit(1).alias("all")).applyInPandas(
        _first_fit(capacity),
        "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, ids_crc32 bigint, "
        "class int, sequence_id bigint, offset bigint").select(*OUT)
    return own.unionByName(common).unionByName(packed_tail)


def sequences(pieces: DataFrame) -> DataFrame:
    """Packed sequences: the pieces' ids joined in order of offset."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"), ordered.alias("parts")).select(
        "sequence_id", "tokens",
        F.expr("aggregate(parts, cast('' as binary), (acc, p) -> concat(acc, p.ids))").alias("ids"))
