import contextlib
import io
import math
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from llm_edges import edge_docs, no_docs
from pyspark.sql import functions as F

from mirrorkit.llm import mixing


def test_exponent_meets_the_limits():
    tokens = [1000, 100, 10]
    e = mixing.choose_exponent(tokens, max_repeats=4.0)
    assert math.isclose(max(mixing.repeats(tokens, mixing.weights_at(tokens, e), None)), 4.0, rel_tol=1e-6)
    e = mixing.choose_exponent(tokens, max_repeats=None, target_entropy=0.9)
    assert math.isclose(mixing.entropy(mixing.weights_at(tokens, e)), 0.9, rel_tol=1e-6)
    assert mixing.choose_exponent(tokens, max_repeats=1.0) == pytest.approx(1.0)
    assert mixing.choose_exponent([], max_repeats=2.0) == 0.0


def docs_of(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "big" if i % 10 else "small") for i in range(2000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string"), rows


def test_budget_and_whole_epochs(small_shuffles):
    df, rows = docs_of(small_shuffles)
    tokens = Counter()
    for i, t, s in rows:
        tokens[s] += len(t.split())
    for repeats, budget in ((2.5, None), (2.0, 3000.0)):
        got = mixing.mix(df, max_repeats=repeats, budget=budget, block_tokens=500).collect()
        plan = {s.source: s for s in mixing.shares(
            [(s, sum(1 for r in rows if r[2] == s), t) for s, t in sorted(tokens.items())], repeats, None, budget)}
        used = Counter()
        times = Counter((r.row.doc_id, r.row.source) for r in got)
        for r in got:
            used[r.row.source] += r.tokens
        for s, share in plan.items():
            assert 0 <= used[s] - share.epochs * share.tokens < 7  # less than a document over
            each = {times[(i, s)] for i, _, src in rows if src == s}
            assert each <= {int(share.epochs + 1e-9), int(share.epochs + 1e-9) + 1}
        places = sorted((r.block, r.turn) for r in got)
        assert len(set(places)) == len(got)
        # A stretch of the mixture has the mixture's weights.
        half = Counter()
        for r in got:
            if r.place < 0.5:
                half[r.row.source] += r.tokens
        for s in plan:
            assert abs(half[s] - used[s] / 2) < 0.15 * used[s] + 10


def by_hand(df, seed, repeats, budget, block_tokens):
    """(id, source, epoch, block) by plain Python, from the operator's hashes alone."""
    rows = df.select("doc_id", "source", "text", F.xxhash64("text").alias("text_hash"),
                     *[mixing._hash01(seed, F.lit(e), F.col("doc_id"), F.xxhash64("text")).alias(f"u{e}") for e in range(6)]).collect()
    tokens = {s: 0 for s in sorted({r.source for r in rows}, key=lambda s: (s is not None, s))}
    for r in rows:
        tokens[r.source] += len((r.text or "").split())
    shares = mixing.shares([(s, sum(r.source == s for r in rows), t) for s, t in tokens.items()], repeats, None, budget)
    blocks = max(1, math.ceil(sum(s.epochs * s.tokens for s in shares) / block_tokens))
    out = []
    for share in shares:
        mine = [r for r in rows if r.source == share.source]
        whole = int(share.epochs + 1e-9)
        used = [(r, e) for e in range(whole) for r in mine]
        left = max(0.0, (share.epochs - whole) * share.tokens)
        for r in sorted(mine, key=lambda r: r[f"u{whole}"]):
            if left <= 0:
                break
            used.append((r, whole))
            left -= len((r.text or "").split())
        for r, e in used:
            place = (e + r[f"u{e}"]) / max(share.epochs, e + r[f"u{e}"] + 1e-9)
            out.append((r.doc_id, r.source, e, min(int(place * blocks), blocks - 1)))
    return Counter(out)


@pytest.mark.parametrize("repeats, budget", [(2.5, None), (2.0, 3000.0), (1.0, None)])
def test_selection_against_plain_python(small_shuffles, repeats, budget):
    df, _ = docs_of(small_shuffles)
    df = df.withColumn("source", F.when(F.col("doc_id") % 50 != 3, F.col("source")))
    got = mixing.mix(df, max_repeats=repeats, budget=budget, block_tokens=300, carry=["doc_id", "source"]).collect()
    assert Counter((r.row.doc_id, r.row.source, r.epoch, r.block) for r in got) == by_hand(df, 7, repeats, budget, 300)


def test_no_exchange_on_the_source(small_shuffles):
    df, _ = docs_of(small_shuffles)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        mixing.mix(df, carry=["doc_id"]).explain(mode="formatted")
        mixing.mixture(df).explain(mode="formatted")
    assert "hashpartitioning(source" not in out.getvalue() and "hashpartitioning(m_source" not in out.getvalue()
    assert out.getvalue().count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in out.getvalue()


def test_files_in_name_order_are_the_mixture(small_shuffles, tmp_dir):
    df, _ = docs_of(small_shuffles)
    want = [r.row.doc_id for r in sorted(mixing.mix(df, block_tokens=200, carry=["doc_id"]).collect(), key=lambda r: (r.block, r.turn))]
    mixed = mixing.mixture(df, block_tokens=200, partitions=5)
    assert mixed.columns == df.columns
    mixed.write.parquet(f"{tmp_dir}/m")
    files = sorted(Path(f"{tmp_dir}/m").glob("part-*.parquet"))
    assert len(files) == 5
    assert [i for f in files for i in pq.read_table(f).column("doc_id").to_pylist()] == want


def test_edge_documents(small_shuffles):
    df = edge_docs(small_shuffles)
    got = mixing.mix(df).collect()
    assert {(r.row.doc_id, r.row.text) for r in got} == {(r.doc_id, r.text) for r in df.collect()}
    assert sorted(df.columns) == sorted(got[0].row.asDict())
    mixed = mixing.mixture(df).collect()
    assert Counter((r.doc_id, r.text) for r in mixed) == Counter((r.row.doc_id, r.row.text) for r in got)
    assert mixing.mix(no_docs(small_shuffles)).count() == mixing.mixture(no_docs(small_shuffles)).count() == 0
