"""What a task of each stage holds for a moment, whatever its batches' size."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mirrorkit.llm import jaccard_join, lpf_dedup, toxicity
from mirrorkit.llm.common import text_once, texts_of, worker_caches

MB = 1 << 20


def texts(n, words, seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = [b"w%d" % i for i in range(20_000)]
    return [b" ".join(vocabulary[i] for i in rng.integers(0, len(vocabulary), words)) for _ in range(n)]


def peak(run):
    """(MB held at most, MB of the largest batch handed on) over all batches of ``run()``."""
    worker_caches("none")
    tracemalloc.start()
    most = max((b.nbytes for b in run()), default=0)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return held / MB, most / MB


def test_runs_are_made_a_few_texts_at_a_time():
    some = texts(3000, 300)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array([b"k"] * len(some)), pa.array(some)], names=["doc_id", "key", "text"])
    assert peak(lambda: lpf_dedup._emit_runs(iter([batch]), 200, 48))[0] < 30


def test_suffixes_of_few_grams_are_in_order_at_once():
    some = [t[:300] for t in texts(6000, 60)]
    batch = pa.RecordBatch.from_arrays([
        pa.array([i // 3 for i in range(len(some))]), pa.array(range(len(some))), pa.array(some),
        pa.array([0] * len(some)), pa.array(some)], names=["gram", "doc_id", "key", "start", "text"])
    assert peak(lambda: lpf_dedup._decide(iter([batch]), "first", 200))[0] < 40


def test_shingles_are_named_and_counted_in_little_memory():
    some = texts(2000, 1500)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some)], names=["doc_id", "text"])
    assert peak(lambda: jaccard_join._local_counts(iter([batch])))[0] < 70
    counters = np.zeros(jaccard_join.COUNTERS, dtype=np.uint32)
    held, batch_mb = peak(lambda: jaccard_join._prefixes(iter([batch]), counters))
    assert held < 25 and batch_mb < 0.2


def test_counted_shingles_are_those_that_repeat():
    a, b, c = (b" ".join(b"%s%d" % (name, i) for i in range(9)) for name in (b"a", b"b", b"c"))
    lines = [a, b + b" x", b + b" y", b + b" z", c]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(lines)], names=["doc_id", "text"])
    got = next(jaccard_join._local_counts(iter([batch])))
    counters = jaccard_join.counter_of(jaccard_join.shingle_sets([b])[0]).tolist()
    assert dict(zip(*(col.to_pylist() for col in got.columns))) == dict.fromkeys(counters, 3)


def test_scored_rows_come_in_small_batches():
    some = [t.decode() for t in texts(3000, 300)]
    row = pa.StructArray.from_arrays([pa.array(range(len(some))), pa.array(some)], names=["doc_id", "text"])
    batch = pa.RecordBatch.from_arrays([row], names=["row"])
    assert peak(lambda: toxicity._score(iter([batch]), toxicity.ChainField(), "text"))[0] < 10
    assert [b.num_rows for b in toxicity._score(iter([batch.slice(5)]), toxicity.ChainField(), "text")] == [512] * 5 + [435]


def test_a_text_is_sent_once(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    whole = df.select(F.struct("doc_id", "text").alias("row"), F.col("text").cast("binary").alias("text"))
    assert text_once(whole, "text").columns == ["row"]
    assert text_once(df.select(F.struct("doc_id").alias("row"), F.col("text").cast("binary").alias("text")), "text").columns == ["row", "text"]
    batch = text_once(whole, "text").coalesce(1).toArrow().combine_chunks().to_batches()[0]
    assert texts_of(batch, "text") == [b"a b", b""]
    assert texts_of(batch.slice(1), "text") == [b""]
