from collections import Counter, defaultdict

import numpy as np
from llm_edges import edge_docs, no_docs
from pyspark.sql import functions as F

from mirrorkit.llm import sharding


def test_hypergeometric_draw_has_the_law(small_shuffles):
    spark = small_shuffles
    n = 20_000
    for good, bad, draws in ((5, 7, 4), (30, 50, 20), (3, 100, 60), (4000, 6000, 500)):
        u = f"(id + 0.5D) / {n}D"
        got = spark.range(n).select(F.expr(sharding._hypergeometric(f"{good}L", f"{bad}L", f"{draws}L", u)).alias("x"))
        c = {r.x: r.n / n for r in got.groupBy("x").agg(F.count("*").alias("n")).collect()}
        xs = np.arange(max(0, draws - bad), min(good, draws) + 1)
        logs = [sum(np.log(np.arange(a - b + 1, a + 1)).sum() - np.log(np.arange(1, b + 1)).sum()
                    for a, b in ((good, int(x)), (bad, draws - int(x)))) for x in xs]
        p = np.exp(np.array(logs) - max(logs))
        p /= p.sum()
        # Inversion of evenly spaced numbers: shares are right to within a step or two.
        assert all(abs(c.get(int(x), 0.0) - q) < 3 / n for x, q in zip(xs, p))


def test_matrix_has_exact_margins(small_shuffles):
    spark = small_shuffles
    sizes = [10, 0, 33, 7, 1, 250]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n], "part bigint, n bigint")
    for seed in range(3):
        rows = {r.part: r.counts for r in sharding.communication_matrix(spark, frame, 4, seed).collect()}
        assert {p: sum(c) for p, c in rows.items() if sum(c)} == {i: n for i, n in enumerate(sizes) if n}
        total = [sum(c[k] for c in rows.values()) for k in range(4)]
        assert sum(total) == sum(sizes) and max(total) - min(total) <= 1 and all(min(c) >= 0 for c in rows.values())


def test_exact_sizes_gapless_slots_and_mixing(small_shuffles):
    df = small_shuffles.range(5003).withColumnRenamed("id", "doc_id").repartition(5)
    got = sharding.shuffle_to_shards(df, 16, seed=2, block_rows=100).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append((r.slot, r.row.doc_id))
    assert sorted(by) == list(range(16)) and sorted(r.row.doc_id for r in got) == list(range(5003))
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    for v in by.values():
        assert sorted(s for s, _ in v) == list(range(len(v)))
    # Neighbouring slots hold unrelated ids.
    gaps = [abs(a[1] - b[1]) for v in by.values() for a, b in zip(sorted(v), sorted(v)[1:])]
    assert 1400 < np.mean(gaps) < 1950  # a third of the range if uniform


def test_edge_documents(small_shuffles):
    df = edge_docs(small_shuffles)
    got = sharding.shuffle_to_shards(df, 16).collect()
    assert Counter((r.row.doc_id, r.row.text) for r in got) == Counter((r.doc_id, r.text) for r in df.collect())
    assert sharding.shuffle_to_shards(no_docs(small_shuffles), 16).count() == 0
