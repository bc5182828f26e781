from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from mirrorkit.llm import hnsw_dedup, kmeans_tree

SCHEMA = "vec_id bigint, embedding array<float>, label int, leaf int, vec string, size int, score double"


def table_of(spark, ids, x, extra=()):
    rows = [(int(i), [float(c) for c in v], 0, 1, "v", 2, 0.5) for i, v in zip(ids, x)]
    return spark.createDataFrame(rows + [(i, v, 0, 1, "v", 2, 0.5) for i, v in extra], SCHEMA)


ODD = [(901, None), (902, [0.0] * 8), (903, [1.0] * 7 + [float("nan")]), (904, [float("inf")] + [1.0] * 7),
       (905, [None] + [1.0] * 7), (906, []), (None, [1.0] * 8), (None, None)]


def sample(seed=1, n=600):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 8)).astype(np.float32)
    for g in range(20):  # near copies
        at = rng.integers(0, n)
        for _ in range(rng.integers(1, 12)):
            x[rng.integers(0, n)] = x[at] + 0.05 * rng.normal(size=8)
    x[50:110] = x[50]  # one common vector
    return np.arange(n), x


def test_nearest_against_brute_force(small_shuffles):
    ids, x = sample()
    got = kmeans_tree.nearest(table_of(small_shuffles, ids, x, ODD).repartition(3), F.col("vec_id") % 20 == 0, 10).collect()
    x = x.astype(float)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in range(0, 600, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [i for i in np.lexsort((ids, d)) if i != q][:10]
        mine = sorted(by[q])
        assert [m[0] for m in mine] == list(range(1, 11)) and all(m[2] == d[m[1]] for m in mine)
        assert [m[1:] for m in mine] == sorted((m[1:] for m in mine), key=lambda m: (m[1], m[0]))
        hits += len(set(want) & {m[1] for m in mine})
        total += 10
    assert set(by) == set(range(0, 600, 20)) and hits >= 0.9 * total


def test_a_repeated_query_row_asks_once(small_shuffles):
    ids, x = sample()
    ids, x = np.append(ids, [0, 0]), np.concatenate([x, x[:1], x[:1]])
    got = kmeans_tree.nearest(table_of(small_shuffles, ids, x).repartition(3), F.col("vec_id") == 0, 10).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 11)) and len({r.vec_id for r in got}) == 10


def test_one_id_repeated_very_often(small_shuffles):
    df = small_shuffles.range(30_100).select(
        F.when(F.col("id") < 30_000, F.lit(100)).otherwise(F.col("id")).cast("bigint").alias("vec_id"),
        F.array(F.when(F.col("id") < 30_000, F.lit(0.5)).otherwise(F.col("id") / 1e5), F.lit(1.0)).alias("embedding"))
    got = kmeans_tree.nearest(df, F.col("vec_id") == 100, 10).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [30_099 - n for n in range(10)] or [
        r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [30_000 + n for n in range(10)]
    other = kmeans_tree.nearest(df, F.col("vec_id") == 30_000, 10).collect()
    assert len(other) == 10 and {r.query_id for r in other} == {30_000}


def test_vectors_of_different_lengths_are_an_error(small_shuffles):
    df = small_shuffles.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0, 3.0])], "vec_id bigint, embedding array<float>")
    for search in (lambda: kmeans_tree.nearest(df, F.col("vec_id") == 0), lambda: hnsw_dedup.near_duplicates(df)):
        with pytest.raises(ValueError, match="different lengths"):
            search()


@pytest.mark.parametrize("table", ["sf0.1/embeddings.parquet", "check_s/embeddings.parquet"])
def test_recall_on_the_test_tables(spark, table):
    path = Path("/root/testdata") / table
    if not path.exists():
        pytest.skip("no such table here")
    df = spark.read.parquet(str(path))
    rows = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in df.select("vec_id", "embedding").collect()
            if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding) and any(r.embedding)}
    ids, x = np.array(list(rows)), np.stack(list(rows.values()))
    found = {}
    for r in kmeans_tree.nearest(df, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in [i for i in ids if i % 100 == 0]:
        d = np.sqrt(((x - rows[q]) ** 2).sum(axis=1))
        true = [i for i in ids[np.lexsort((ids, d))][:11] if i != q][:10]
        hits, total = hits + len(found[q] & set(true)), total + len(true)
    print(f"recall {hits / total:.4f} of {total}")
    assert hits >= 0.9 * total


def test_few_rows_and_no_rows(small_shuffles):
    spark = small_shuffles
    got = kmeans_tree.nearest(table_of(spark, [0, 1, 2], np.eye(8)[:3]), F.col("vec_id") % 100 == 0, 10).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]
    assert kmeans_tree.nearest(table_of(spark, [], []), F.col("vec_id") % 100 == 0).count() == 0
    assert kmeans_tree.nearest(table_of(spark, [1, 2], np.eye(8)[:2]), F.col("vec_id") % 100 == 0).count() == 0
    assert hnsw_dedup.near_duplicates(table_of(spark, [], [])).count() == 0


def test_tree_visits_every_leaf_once():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    tree = kmeans_tree.fit_tree(x, 30_000)
    assert tree.leaves > 20 and sorted(tree.best_bins(x[0])) == list(range(tree.leaves))
    leaf = tree.assign(x)
    first = [next(tree.best_bins(v)) for v in x[:50]]
    assert (leaf[:50] == first).all()


def test_near_duplicates_against_brute_force(small_shuffles):
    ids, x = sample(5)
    df = table_of(small_shuffles, ids, x, ODD + [(0, [float(c) for c in x[0]])]).repartition(3)
    got = sorted((tuple(r) for r in hnsw_dedup.near_duplicates(df).collect()), key=repr)
    all_ids = list(ids) + [0]
    u = np.concatenate([x, x[:1]]).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    root = {int(i): int(i) for i in all_ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in zip(*np.nonzero(links)):
        p, q = find(int(all_ids[a])), find(int(all_ids[b]))
        root[max(p, q)] = min(p, q)
    want = [(int(i), int(links[k].sum()), find(int(i)), find(int(i)) == int(i)) for k, i in enumerate(all_ids)]
    want += [(i, 0, i, i is not None) for i, _ in ODD]
    assert got == sorted(want, key=repr)


def test_graph_finds_members_of_large_groups():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 32))
    x[200:500] = x[200] + 0.03 * rng.normal(size=(300, 32))
    u = hnsw_dedup._unit(x)
    graph = hnsw_dedup.Graph(u)
    found = graph.within(u[190:210].astype(np.float32), graph.audited_beam(0.9), 0.9 - 1e-4)
    want = u[190:210] @ u.T >= 0.9
    assert sum(len(set(f) & set(np.flatnonzero(w))) for f, w in zip(found, want)) >= 0.99 * want.sum()
