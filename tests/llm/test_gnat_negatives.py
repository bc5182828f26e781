"""Hard negatives against a scan of all rows."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mirrorkit.llm import gnat_negatives as gn
from mirrorkit.llm import queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, row int, ask int, own string, leaf string, vec int, score double"
EXTRA = (1, 2, "o", "l", 3, 0.5)
ODD = [(901, None, 1), (902, [0.0] * 8, 1), (903, [1.0] * 7 + [float("nan")], 1), (904, [float("-inf")] + [1.0] * 7, 2),
       (905, [None] + [1.0] * 7, 2), (906, [], 2), (None, [1.0] * 8, 1), (907, [1.0] * 8, None), (None, None, None),
       (908, [2.0, -1.0], 1), (700, [], 3), (800, [0.5] * 3, 3)]


def vector_table(spark, ids, x, labels, extra=()):
    rows = [(int(i), [float(c) for c in v], int(k), *EXTRA) for i, v, k in zip(ids, x, labels)]
    return spark.createDataFrame(rows + [(*r, *EXTRA) for r in extra], SCHEMA)


def expected(rows):
    """Plain scan over collected rows; each distinct anchor asks once."""
    taking = []
    for r in rows:
        if r.vec_id is None or r.label is None or r.embedding is None or not all(c is not None and np.isfinite(c) for c in r.embedding):
            continue
        taking.append((r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label,
                       tuple(int(np.floor(256 * np.float64(c))) for c in r.embedding)))
    out = []
    for anchor, label, a in {t for t in taking if t[0] % 100 == 0}:
        scored = sorted((-sum(p * q for p, q in zip(a, v)), i, k) for i, k, v in taking if i != anchor)
        for s, positive, _ in [t for t in scored if t[2] == label][:5]:
            fits = [t for t in scored if t[2] != label and 30 * -s <= 100 * -t[0] <= 90 * -s][:10]
            out += [(anchor, positive, n, i, -s, -t) for n, (t, i, _) in enumerate(fits, 1)]
    return out


def got(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return [tuple(r) for r in gn.hard_negatives(df, F.col("vec_id") % 100 == 0, label=label).collect()]


def clustered(n=900, groups=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 8))
    x = centres[rng.integers(0, groups, n)] + 0.2 * rng.normal(size=(n, 8))
    x[100:160] = x[100]  # one common vector
    return np.arange(n), x.astype(np.float32), rng.integers(0, 4, n)


@pytest.fixture()
def small_trees(monkeypatch):
    monkeypatch.setattr(gn, "LEAF_ROWS", 40)
    monkeypatch.setattr(gn, "BLOCK_ROWS", 25)
    monkeypatch.setattr(gn, "MAX_SAMPLE", 300)


def test_against_a_scan(small_shuffles, small_trees):
    df = vector_table(small_shuffles, *clustered(), extra=ODD).repartition(3)
    mine = got(df)
    assert Counter(mine) == Counter(expected(df.collect())) and len(mine) > 300


def test_the_same_as_sql(small_shuffles, small_trees):
    ids, x, labels = clustered(500, seed=3)
    df = vector_table(small_shuffles, ids, x, labels)
    con = duckdb.connect()
    con.register("embeddings", df.select("vec_id", "embedding", "label").toPandas())
    assert Counter(got(df)) == Counter(con.sql(queries.OP11_SQL).fetchall())


def test_repeated_rows_and_ids(small_shuffles, small_trees):
    ids, x, labels = clustered(400, seed=4)
    ids = np.concatenate([ids, [0, 0, 100, 5, 5]])
    x, labels = np.concatenate([x, x[[0, 0, 7, 5, 6]]]), np.concatenate([labels, labels[[0, 0, 7, 5, 6]]])
    df = vector_table(small_shuffles, ids, x, labels).repartition(3)
    assert Counter(got(df)) == Counter(expected(df.collect()))


def test_one_vector_repeated_very_often(small_shuffles, small_trees):
    df = small_shuffles.range(3000).select(
        F.when(F.col("id") < 2000, F.lit(100)).otherwise(F.col("id")).cast("bigint").alias("vec_id"),
        F.array(*[F.lit(0.5).cast("float")] * 4).alias("embedding"), (F.col("id") % 3).cast("int").alias("label"))
    rows = gn.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert rows == []  # all scores are equal, above 90 per cent
    wide = gn.hard_negatives(df, F.col("vec_id") == 100, high=100).collect()
    first = sorted(r.negative_id for r in wide if r.positive_id == wide[0].positive_id)
    assert len(first) % 10 == 0 and min(first) >= 2000


def test_few_rows_and_no_rows(small_shuffles):
    spark = small_shuffles
    assert got(vector_table(spark, [], [], [])) == []
    assert got(vector_table(spark, [], [], [], ODD[:1])) == []
    assert got(vector_table(spark, [1, 2], np.eye(8)[:2], [0, 0])) == []
    df = vector_table(spark, [0, 1, 2], [[1, 0], [1, 0], [0.5, 0]], [0, 1, 0])
    df = df.withColumn("label", F.col("label"))
    assert Counter(got(df)) == Counter(expected(df.collect()))
    with pytest.raises(ValueError, match="too long"):
        got(vector_table(spark, [0, 1], [[1e9, 0], [1, 0]], [0, 0]))


def test_ranges_spare_parts_and_lose_nothing():
    rng = np.random.default_rng(2)
    x = (256 * (rng.normal(size=(40, 6))[rng.integers(0, 40, 6000)] + 0.05 * rng.normal(size=(6000, 6)))).astype(np.int64)
    top = int((x * x).sum(axis=1).max())
    tree = gn.Tree()
    tree.grow(gn.lifted(x[:2000], top), 3.0, 100, rng)
    for at, (low, high) in enumerate(zip(tree.low, tree.high)):
        assert low.shape == high.shape == (len(tree.kids[at]),) * 2
    for r in gn._ranges(iter([__import__("pyarrow").record_batch({"vec": x.tolist()})]), tree, 6, top):
        for row in r.to_pylist():
            tree.low[row["split"]][row["centre"], row["part"]] = row["low"]
            tree.high[row["split"]][row["centre"], row["part"]] = row["high"]
    leaf = tree.descend(gn.lifted(x, top))
    q = x[:50]
    scores = q @ x.T
    best = np.sort(scores, axis=1)[:, -6]
    outer = np.sqrt((q * q).sum(axis=1) + top - 2.0 * best)
    lifted = np.concatenate([q, np.zeros((50, 1))], axis=1).astype(float)
    seen = {i: set() for i in range(50)}
    for number, rows in tree.visits(lifted, np.zeros(50), outer, 1e-6 * (1 + top**0.5)):
        for i in rows:
            seen[i].add(number)
    for i in range(50):
        assert set(leaf[scores[i] >= best[i]]) <= seen[i]
    assert np.mean([len(s) for s in seen.values()]) < 0.5 * tree.leaves
