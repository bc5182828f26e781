import corpus_pipeline
from llm_edges import edge_docs, no_docs

from mirrorkit.llm.common import written
from mirrorkit.llm.components import components

SF = "/root/testdata/sf0.001"


def test_stages_on_edge_documents(small_shuffles):
    for docs in (edge_docs(small_shuffles), no_docs(small_shuffles)):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = written(stage(small_shuffles, docs, SF), f"test-{name}")
            if name != "packing":
                assert docs.columns == columns, name
        docs.count()


def test_near_copies_keep_one_of_each_group(small_shuffles):
    docs = edge_docs(small_shuffles)
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(small_shuffles, docs, SF).collect()]
    assert sorted(kept, key=repr) == sorted([1, 2, 3, 4, 6, 7, 8, 9, None, None], key=repr)


def test_rows_that_share_an_id_keep_their_own_texts(small_shuffles):
    first = " ".join(f"wort{i}" for i in range(80))
    other = " ".join(f"mot{i}" for i in range(80))
    rows = [(1, first), (5, first + " edited"), (5, other), (5, other), (6, other + " edited"), (7, "a third text"),
            (7, "quite another one"), (7, None), (7, ""), (8, "a third text")]
    docs = small_shuffles.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.drop_near_copies(small_shuffles, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(1, first), (5, other), (7, "a third text"), (7, "quite another one"), (7, None), (7, "")], key=repr)


def test_run(small_shuffles):
    out = corpus_pipeline.run(small_shuffles, SF)
    assert out.count() > 0 and out.columns[:3] == ["doc_id", "start", "length"]


def test_components(small_shuffles):
    import random
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    df = small_shuffles.createDataFrame(edges, "a bigint, b bigint")
    assert {(r.vertex, r.component) for r in components(df).collect()} == {(v, find(v)) for v in list(root)}
    assert components(df.limit(0)).count() == 0
