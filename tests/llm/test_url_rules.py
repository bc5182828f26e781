"""URL rules against all token subsets counted in one place."""

from collections import Counter, defaultdict
from itertools import combinations
from math import ceil

import duckdb
import pytest
from pyspark.sql import functions as F

from mirrorkit.llm import queries, url_rules

SCHEMA = "page_id bigint, url string, html string, host string, path string, rule string, verdict string, tokens string, items int"
EXTRA = ("h", "x", "y", "z", "v", "t", 1)
ODD = [None, "", "no scheme at all", "http://", "https://Example.NET", "https://example.net/en", "https://a.example.NET/en/1",
       "https://net/", "http://internet/x", "http://org/fr/x", "ftp://www.a.b.ORG/fr/1", "http://x.org?u=http://y.net/en/",
       "http://x.org#a/fr/", "http://example.com/de/?a=1&b=2&a=3&&=4", "http://notexample.com/de/1", "x\n://y.com/\nde/a.b.c\n",
       "http://ü.example.org/É/é/1/22/333.tar.gz?é=1", "http://u:p@h.com:80/de/", "https://" + "a." * 3000 + "com/" + "b/" * 9000,
       "http://x.com//de//..//", "https://..net/", "://", "http://h.com/?://net/"]


def page_table(spark, urls):
    return spark.createDataFrame([(None if i == 3 else i, u, *EXTRA) for i, u in enumerate(urls)], SCHEMA)


def many():
    urls = []
    for i in range(240):
        host = ("", "www.", "blog.")[i % 3] + f"s{i % 17}.example." + ("net", "com", "org", "info")[i % 4]
        urls.append(f"http{'s' * (i % 2)}://{host}/{('en', 'de', 'fr', 'es')[i // 4 % 4]}/{i}" + ("", ".html", "?ref=1", "#top", "/a/b")[i % 5])
    return urls


def expected(df, support, confidence):
    """Every subset of every labelled URL's tokens is counted."""
    rows = df.select("page_id", url_rules.host_of(F.col("url")).alias("h"), url_rules.path_of(F.col("url")).alias("p"),
                     url_rules.tokens_of(F.col("url")).alias("t")).collect()

    def listed(r):
        fits = [(n + p, v) for n, p, v in url_rules.LISTED if (r.h == n or r.h.endswith("." + n)) and r.p.startswith(p)]
        return max(fits, key=lambda f: len(f[0]), default=(None, None))

    def subsets(tokens):
        return [s for k in range(1, len(tokens) + 1) for s in combinations(sorted(tokens), k)]

    counts, n = defaultdict(Counter), 0
    for r in rows:
        if (verdict := listed(r)[1]) is not None:
            n += 1
            for s in subsets(r.t):
                counts[s][verdict] += 1
    least = ceil(support * n)
    rules = {s: [(-c / sum(by.values()), -c, v == "allow", len(s), " & ".join(s)) for v, c in by.items()
                 if c >= least and c / sum(by.values()) >= confidence] for s, by in counts.items()}
    out = []
    for r in rows:
        rule, verdict = listed(r)
        mined = None
        if verdict is None:
            best = min((x for s in subsets(r.t) for x in rules.get(s, ())), default=None)
            verdict, mined = ("allow", None) if best is None else ("allow" if best[2] else "block", best[4])
        out.append((r.page_id, r.h, r.p, rule, verdict, mined))
    return out


def got(df, **options):
    return [tuple(r) for r in url_rules.judge(df, **options).collect()]


@pytest.mark.parametrize("support, confidence", [(0.01, 0.9), (0.1, 0.6), (0.02, 1.0)])
def test_against_all_subsets(small_shuffles, support, confidence):
    df = page_table(small_shuffles, ODD + many() + many()[:30]).repartition(3)
    mine = got(df, min_support=support, min_confidence=confidence)
    assert Counter(mine) == Counter(expected(df, support, confidence))
    assert {r[4] for r in mine} == {"allow", "block"} and any(r[5] for r in mine)


def test_the_same_as_sql(small_shuffles):
    df = page_table(small_shuffles, [u for u in ODD if u is None or len(u) < 1000] + many())
    con = duckdb.connect()
    con.register("pages", df.select("page_id", "url").toPandas())
    assert Counter(got(df)) == Counter(con.sql(queries.OP12_SQL).fetchall())


def test_hosts_and_paths(small_shuffles):
    df = page_table(small_shuffles, ODD)
    rows = {r[0]: r[1:5] for r in got(df)}
    assert rows[0] == rows[1] == rows[2] == ("", "", None, "allow")
    assert rows[4] == ("example.net", "", None, "allow")  # the path does not start with /
    assert rows[5] == ("example.net", "/en", "net/", "block") and rows[6] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert rows[8][2] is None and rows[9][2:] == ("org/fr/", "allow") and rows[10][2] == "org/fr/"
    assert rows[11][:2] == ("x.org", "") and rows[12][:2] == ("x.org", "")
    assert rows[13][2:] == ("example.com/de/", "block") and rows[14][2] is None
    assert rows[15][:2] == ("y.com", "/\nde/a.b.c\n") and rows[18][1].count("b/") == 9000


def test_tokens_take_in_the_whole_url(small_shuffles):
    df = page_table(small_shuffles, [f"http://a.b.c.d.e/1/2/3/{x}/5.html?z={x}&y#q" for x in "vw"])
    a, b = (r.t for r in df.select(url_rules.tokens_of(F.col("url")).alias("t")).collect())
    assert set(a) ^ set(b) == {"rest=0/v/0.html", "rest=0/w/0.html"}
    assert {"scheme=http", "sub=a.b", "site=c.d.e", "keys=y&z", "file=html", "mark=#"} <= set(a)


def test_pruned_rules_decide_nothing(small_shuffles):
    labelled = small_shuffles.createDataFrame(
        [(["a=1", "b=1"], "block")] * 6 + [(["a=1", "b=2"], "block")] * 3 + [(["a=2", "b=2"], "allow")] * 3, "tokens array<string>, verdict string")
    rules = {(tuple(r.tokens), r.verdict): (r["count"], r.confidence) for r in url_rules.mine(labelled, 0.1, 0.9).collect()}
    assert rules == {(("a=1",), "block"): (9, 1.0), (("b=1",), "block"): (6, 1.0), (("a=2",), "allow"): (3, 1.0)}


def test_no_rows_no_labels_one_label(small_shuffles):
    assert got(page_table(small_shuffles, ["http://a.de/"]).limit(0)) == []
    assert got(page_table(small_shuffles, ["http://a.de/x", None])) == [
        (0, "a.de", "/x", None, "allow", None), (1, "", "", None, "allow", None)]
    rows = got(page_table(small_shuffles, ["http://a.net/x"] * 3 + ["http://b.de/x", "http://b.de"]))
    assert [r[4] for r in sorted(rows, key=repr)].count("block") == 5  # all labelled URLs have that scheme
