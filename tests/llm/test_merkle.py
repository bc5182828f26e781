"""Manifests against a plain tree made in one place."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from llm_edges import edge_docs, no_docs
from pyspark.sql import functions as F

from mirrorkit.llm import merkle, queries


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, lower=False):
    text = r.text
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    parts = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def tree(nodes):
    """Levels from the nodes to their root, by slices of eight."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def way(levels, at):
    out = []
    for level in levels[:-1]:
        start = at - at % 8
        out.append((level[start:at], level[at + 1 : start + 8]))
        at //= 8
    return out


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.lang].append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees[lang] = tree([leaf_of(r) for r in by[lang]])
    upper = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for at, r in enumerate(by[lang]):
            steps = way(trees[lang], at) + way(upper, place)
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            acc = leaf_of(r, tampered)
            for left, right in steps:
                acc = h("".join(left) + acc + "".join(right))
            proof = h("".join("".join(left) + "".join(right) for left, right in steps))
            root = upper[-1][0]
            out.append((r.doc_id, leaf_of(r), trees[lang][-1][0], root, proof, acc, acc == root))
    return out


def got(df, stride=merkle.STRIDE):
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
            for r in queries.merkle_rows(df, stride).collect()]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# One leaf, one run, runs of one, a block's edge, more than one block, three stored levels.
@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8, None: 9}, {"a": 65, "b": 1, "": 2}, {"a": 512, "b": 513},
                                   {"hot": 4700, "b": 3, "c": 600}])
def test_against_a_plain_tree(small_shuffles, sizes):
    rows = [(i * 7 + k, f"Text {i} Öß" if i % 3 else None, lang, f"s{i % 4}", i)
            for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    df = small_shuffles.createDataFrame(rows, SCHEMA).repartition(5)
    assert Counter(got(df)) == Counter(expected(df.collect()))


def test_stored_levels_of_a_higher_tree(small_shuffles):
    df = small_shuffles.range(700).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("T"), "id").alias("text"), F.lit("x").alias("lang"),
        F.lit("s").alias("source"), F.lit(1).cast("bigint").alias("n_chars"))
    forest = merkle.build(merkle.leaves_of(df, F.lit(False)), ["doc_id"], ["doc_id"], stride=1)
    assert [level.count() for level in forest.levels] == [88, 11, 2, 1]
    assert Counter(got(df, stride=1)) == Counter(expected(df.collect()))


def test_many_languages(small_shuffles):
    df = small_shuffles.createDataFrame([(i, "A", f"l{i % 90}", None, None) for i in range(270)], SCHEMA)
    assert Counter(got(df)) == Counter(expected(df.collect()))


def test_edge_documents(small_shuffles):
    df = edge_docs(small_shuffles)
    assert Counter(got(df)) == Counter(expected(df.collect()))
    assert got(no_docs(small_shuffles)) == []


def test_proof_columns_show_tampering(small_shuffles):
    df = small_shuffles.createDataFrame([(i, "Upper" if i % 2 else "lower", "x", "s", 5) for i in range(100)], SCHEMA)
    for r in queries.merkle_rows(df).collect():
        assert r.verified == (r.doc_id % 2 == 0 or zlib.crc32(str(r.doc_id).encode()) % 3 != 0)
