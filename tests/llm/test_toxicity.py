import numpy as np
from itertools import product

from llm_edges import edge_docs, no_docs
from pyspark.sql import functions as F

from mirrorkit.llm import toxicity
from mirrorkit.llm.common import crc32_mod
from mirrorkit.llm.queries import op4_toxicity_field


def test_marginals_equal_sums_over_all_taggings():
    field = toxicity.ChainField(emit=np.array([-3.0, 0.5, 1.0, 2.0, 3.0, 4.0]), move=np.array([[0.0, -1.0], [0.3, 0.7]]))
    classes = [0, 3, 0, 0, 5, 1, 0]
    weight = {}
    for tags in product((0, 1), repeat=len(classes)):
        before, score = 0, 0.0
        for k, t in zip(classes, tags):
            score += field.move[before, t] + (field.emit[k] if t else 0.0)
            before = t
        weight[tags] = np.exp(score)
    total = sum(weight.values())
    want = [sum(w for t, w in weight.items() if t[i]) / total for i in (1, 4, 5)]
    assert np.allclose(field.marginals([3, 5, 1], [1, 2, 0, 1]), want)
    x = np.array([classes], dtype=np.uint8)
    _, p1, pairs = toxicity.chain_expectations(x, np.array([len(classes)]), field.emit, field.move)
    assert np.allclose(p1[0, [1, 4, 5]], want) and np.isclose(pairs.sum(), len(classes))


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (5, 8)).astype(np.uint8)
    length = np.array([8, 3, 5, 1, 8])
    emit, move = rng.normal(size=6), rng.normal(size=(2, 2))
    z, p1, _ = toxicity.chain_expectations(x, length, emit, move)
    for k in range(6):
        more = emit.copy()
        more[k] += 1e-5
        z2, _, _ = toxicity.chain_expectations(x, length, more, move)
        live = np.arange(8)[None] < length[:, None]
        assert np.isclose((z2 - z).sum() / 1e-5, p1[live & (x == k)].sum(), atol=1e-3)


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = op4_toxicity_field(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    n = {(r.toxic, r.predicted): r.c for r in got.groupBy("toxic", "predicted").agg(F.count("*").alias("c")).collect()}
    assert n[(1, 1)] >= 0.85 * (n[(1, 1)] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.03 * (n[(0, 0)] + n.get((0, 1), 0))


def test_edge_documents(small_shuffles):
    spark = small_shuffles
    docs = edge_docs(spark)
    learn = ~F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False))
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 0), (5, 1), (5, None), (None, 1), (8, 0)], "doc_id bigint, toxic int")
    for lab in (labels, labels.filter("toxic = 0"), labels.limit(0)):
        model = toxicity.fit(docs, lab, learn)
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(no_docs(spark), toxicity.ChainField()).count() == 0


def test_spans_are_byte_offsets(small_shuffles):
    spark = small_shuffles
    rows = [(i, f"été bon mot numéro {i}" if i % 2 else f"été méchant crétin! numéro {i}", i % 2 == 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    for r in toxicity.score(docs, model).collect():
        assert (r.score >= 0.3) == (r.row.doc_id % 2 == 0)
        found = {r.row.text.encode()[s.start : s.end].decode() for s in r.spans}
        assert found == ({"méchant", "crétin!"} if r.row.doc_id % 2 == 0 else set())


def test_stretches_are_maximal(small_shuffles):
    spark = small_shuffles
    texts = [f"été bon mot {i} fin" if i % 2 else f"été  méchant\n crétin! numéro {i} loin de tout encore méchant" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    field = toxicity.fit(docs, labels, F.lit(True))
    field.lexicon = {k: v for k, v in field.lexicon.items() if k in ("=méchant", "=crétin")}
    for r in toxicity.score(docs, field).collect():
        found = [r.row.text.encode()[s.start : s.end].decode() for s in r.stretches]
        assert found == (["méchant\n crétin!", "méchant"] if r.row.doc_id % 2 == 0 else []) and len(r.spans) == (3 if found else 0)


def test_maximal_runs():
    assert toxicity.maximal([(0, 0, 2, 0.5), (1, 3, 4, 0.9), (3, 6, 7, 0.6)]) == [
        {"start": 0, "end": 4, "p": 0.9}, {"start": 6, "end": 7, "p": 0.6}]
    assert toxicity.maximal([]) == []


def test_long_clean_documents_first_leave_the_toxic_ones_in_the_fit(small_shuffles):
    spark = small_shuffles
    clean = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("mot "), 6400).alias("text"))
    toxic = spark.range(300, 600, 1, 1).select(F.col("id").alias("doc_id"), F.lit("été méchant crétin! numéro").alias("text"))
    docs = clean.unionByName(toxic)
    labels = docs.select("doc_id", (F.col("doc_id") >= 300).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, F.lit(True))
    for r in toxicity.score(toxic.limit(5), model).collect():
        assert r.score >= 0.3 and {r.row.text.encode()[s.start : s.end].decode() for s in r.spans} >= {"méchant", "crétin!"}


def test_chunks_hold_every_token_once_in_any_order():
    rng = np.random.default_rng(2)
    rows = []
    for i, tokens in enumerate([0, 1, 64, 65, 128, 700, 20_000, 640]):
        at = np.flatnonzero(rng.random(tokens) < (0.02 if i != 7 else 0)).tolist()
        rows.append({"toxic": i % 2, "tokens": tokens, "at": at, "classes": rng.integers(1, 6, len(at)).tolist()})
    x, y, length, count = toxicity._chunks(rows)
    assert (length * count).sum() == sum(r["tokens"] for r in rows)
    assert ((x > 0).sum(axis=1) * count).sum() == sum(len(r["at"]) for r in rows)
    assert (y.sum(axis=1) * count).sum() == sum(len(r["at"]) for r in rows if r["toxic"])
    assert all(np.array_equal(a, b) for a, b in zip((x, y, length, count), toxicity._chunks(rows[::-1])))
    for a, b in zip(toxicity.fit_chain(x, y, length, count, rounds=5),
                    toxicity.fit_chain(*(np.repeat(v, count, axis=0) for v in (x, y, length)), rounds=5)):
        assert np.allclose(a, b)
