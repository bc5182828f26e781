import datetime as dt
import string
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mirrorkit.operators import chunks as ch
from mirrorkit.registry import source_frame
from tests.conftest import SF_SMALL, rows_of


def test_inclusive_chunks_lose_key_between_ranges(spark):
    preds = ch.inclusive_range_chunks("parid", width=100, count=2, digits=4)
    assert preds[0] == "parid BETWEEN '0000' AND '0099'"
    df = spark.createDataFrame([("0050",), ("0099A",), ("0150",), ("ABC",), (None,)], "parid string")
    cov = dict(rows_of(ch.chunk_coverage(df, preds), "hits", "n"))
    assert cov == {0: 1, 1: 4}  # '0099A' sorts between the ranges: lost


def test_chunked_scan_is_union_all(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "k int")
    preds = ["k < 6", "k > 4", "k IS NULL"]  # 5 is in two chunks, none are gaps
    got = rows_of(ch.chunked_scan(df, preds, "chunk"), "chunk", "k")
    expected = sorted([(i, r["k"]) for i, p in enumerate(preds) for r in df.where(p).collect()], key=repr)
    assert got == expected
    assert ch.chunked_scan(df, None) is df


def test_trap_view_counts_at_sf_small(spark):
    src = source_frame(spark, SF_SMALL, "orders_src")
    preds = ch.inclusive_range_chunks("PARID", width=250, count=6)
    cov = dict(rows_of(ch.chunk_coverage(src, preds), "hits", "n"))
    assert cov[0] == 5 and sum(cov.values()) == 1500


def test_derived_chunks_cover_every_row_once(spark):
    src = source_frame(spark, SF_SMALL, "orders_src")
    preds = ch.derived_chunks(src, "PARID", 6)
    assert len(preds) <= 8 and preds[-1] == "PARID IS NULL"
    assert rows_of(ch.chunk_coverage(src, preds), "hits", "n") == [(1, 1500)]
    counts = rows_of(ch.chunk_counts(src, preds), "chunk", "n")
    assert sum(n for _, n in counts) == 1500


def test_numeric_bounds(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    preds = ch.derived_chunks(df, "k", 4)
    assert rows_of(ch.chunk_coverage(df, preds), "hits", "n") == [(1, 1000)]
    assert "'" not in preds[1]


def test_quotes_in_bounds():
    preds = ch.half_open_chunks("k", ["a'b"])
    assert list(preds) == ["k < 'a''b'", "k >= 'a''b'", "k IS NULL"]


keys = st.one_of(st.none(), st.text(alphabet=string.digits + "A'", min_size=0, max_size=16))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(keys, min_size=0, max_size=60), bounds=st.lists(st.text(string.digits, max_size=15), max_size=6))
def test_half_open_chunks_property(spark, values, bounds):
    df = spark.createDataFrame([(v,) for v in values], "parid string")
    preds = ch.half_open_chunks("parid", bounds)
    cov = rows_of(ch.chunk_coverage(df, preds), "hits", "n")
    assert cov == ([(1, len(values))] if values else [])


def test_hot_key_is_split_exactly(spark):
    # One key (and the null key) hold a third of the rows each.
    rows = [("00000000000007", i % 50) for i in range(3000)]
    rows += [(None, i % 40) for i in range(3000)]
    rows += [(f"{i:014d}", i % 30) for i in range(3000)]
    rows += [("00000000000007", None)] * 5
    df = spark.createDataFrame(rows, "parid string, yr int")
    plain = ch.derived_chunks(df, "parid", 6)
    split = ch.derived_chunks(df, "parid", 6, split_column="yr")
    assert rows_of(ch.chunk_coverage(df, split), "hits", "n") == [(1, len(rows))]
    biggest_plain = max(n for _, n in rows_of(ch.chunk_counts(df, plain), "chunk", "n"))
    biggest_split = max(n for _, n in rows_of(ch.chunk_counts(df, split), "chunk", "n"))
    assert biggest_plain >= 3000
    assert biggest_split < 2 * len(rows) / 6
    assert any("parid = '00000000000007' AND" in p for p in split)
    assert any(p.startswith("parid IS NULL AND") for p in split)


def test_derived_chunks_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "parid string, yr int")
    for preds in (ch.derived_chunks(empty, "parid", 4), ch.derived_chunks(empty, "parid", 4, split_column="yr")):
        assert preds[-1] == "parid IS NULL"
        later = spark.createDataFrame([("x", 1), (None, 2)], "parid string, yr int")
        assert rows_of(ch.chunk_coverage(later, preds), "hits", "n") == [(1, 2)]


def _tested_row_by_row(df, preds):
    """The coverage with every predicate tested on every row."""
    return rows_of(ch.chunk_coverage(df, list(preds)), "hits", "n")


def test_long_lists_are_checked_once_per_cell(spark, monkeypatch):
    # Each row would be tested with each of 2,002 predicates; now rows between two bounds share the tests.
    tested = []
    hits = ch.chunk_hits
    monkeypatch.setattr(ch, "chunk_hits", lambda p: tested.append(len(p)) or hits(p) + F.col("__n") * 0)
    keys = [(f"{i:06d}" + ("A" if i % 7 == 0 else ""),) for i in range(9000)] + [(None,)] * 3 + [("",), ("~",), ("é",)]
    df = spark.createDataFrame(keys, "parid string")
    preds = ch.half_open_chunks("parid", [f"{i * 4:06d}" for i in range(1, 2001)])
    assert len(preds) == 2002
    assert rows_of(ch.chunk_coverage(df, preds), "hits", "n") == [(1, len(keys))] and tested == [2002]


def test_faults_of_long_lists_are_found(spark):
    """The predicates are what is tested: overlaps and gaps of a list show, at the bounds and between them."""
    df = spark.createDataFrame([(i // 2,) for i in range(800)] + [(None,), (-(2**60),), (2**60,)], "k long")
    bounds = list(range(3, 303, 3))
    sound = ch.half_open_chunks("k", bounds)
    texts = list(sound)
    texts[5] = texts[5].replace(">=", ">")  # loses its bound
    texts[9] = texts[9].replace("<", "<=")  # takes the next one's bound
    texts[20] = "false"  # loses all of its rows
    texts[30] = f"({texts[30]}) -- a note"
    faulty = ch.ChunkList(texts, compared=("k", bounds))
    assert rows_of(ch.chunk_coverage(df, sound), "hits", "n") == [(1, 803)]
    found = rows_of(ch.chunk_coverage(df, faulty), "hits", "n")
    assert found == [(0, 8), (1, 793), (2, 2)] == _tested_row_by_row(df, faulty)


def test_long_inclusive_lists_lose_the_same_keys(spark):
    preds = ch.inclusive_range_chunks("k", width=10, count=90, digits=4)
    df = spark.createDataFrame([(f"{i:04d}" + "A" * (i % 5 == 4),) for i in range(1000)] + [(None,)], "k string")
    found = rows_of(ch.chunk_coverage(df, preds), "hits", "n")
    assert found == _tested_row_by_row(df, preds) and found[0][0] == 0


@pytest.mark.parametrize("type_name, values, bounds", [
    ("double", [float(i) for i in range(200)] + [float("nan"), float("inf"), -0.0, None], [i / 2 for i in range(100)]),
    ("double", [1.0, float("nan"), None], [float(i) for i in range(99)] + [float("nan")]),
    ("decimal(10,3)", [Decimal(i) / 8 for i in range(200)], [Decimal(i) / 4 for i in range(80)]),
    ("date", [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(200)], [dt.date(2020, 1, 1) + dt.timedelta(2 * i) for i in range(70)]),
    ("timestamp_ntz", [dt.datetime(2020, 1, 1) + dt.timedelta(hours=i) for i in range(200)],
     [dt.datetime(2020, 1, 1) + dt.timedelta(hours=2 * i, microseconds=i) for i in range(70)]),
    ("int", list(range(120)), [str(i) for i in range(100)]),  # text bounds, sorted as text, of numbers
    ("string", ["a\\b", "a'b", "\\", None] + [f"\\{i}" for i in range(99)], [f"\\{i}" for i in range(80)]),
])
def test_long_lists_of_every_type(spark, type_name, values, bounds):
    df = spark.createDataFrame([(v,) for v in values], f"`a key` {type_name}")
    for preds in (ch.half_open_chunks("a key", bounds), ch.half_open_chunks("a key", bounds[:1] * 3)):
        assert rows_of(ch.chunk_coverage(df, preds), "hits", "n") == _tested_row_by_row(df, preds)
    assert len(ch.half_open_chunks("a key", bounds)) > ch.FEW_CHUNKS
