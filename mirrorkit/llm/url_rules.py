"""URL filter: listed rules first, rules mined from labelled URLs for the rest.

A URL is described by one token per *attribute* (``ATTRIBUTES``: scheme, host
parts, first path parts, extension, query keys ...). Together they take in the
whole URL: what the named parts leave over is one token of its own, so a URL
has a bounded number of tokens however long it is.

Mining: Spark's FP-growth finds the token combinations that at least
``MIN_SUPPORT`` of the labelled URLs share together with a label. A
combination whose URLs carry the label with ``MIN_CONFIDENCE`` or more is a
rule; rules that a part of theirs makes needless (same label, at least the
same confidence) are pruned. A URL supports at most ``2 ** len(ATTRIBUTES)``
combinations, so there are at most that many over ``MIN_SUPPORT`` rules: the
bound behind sending them to every task.

Matching: an inverted index files each rule under the token that the fewest
rules have; a URL looks up its tokens and checks the rest of the rules it meets. The rule with the
highest confidence decides, then the one with more URLs behind it, then
``block`` before ``allow``, then the shorter and lesser text. Without a rule a
URL is allowed.

Listed rules (host, path) fit the host and its subdomains, where the path
starts with theirs; the longest decides, and they serve as the labels of the
URLs they fit.

Defined results: a null URL, or one without ``://``, has empty host and path
and no tokens, and is allowed; repeated rows are judged alike and count as
often as they come; without labelled URLs nothing is mined; an empty table
gives no rows; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorkit.llm.common import map_batches, written

#: (host, path, verdict) of the listed rules.
LISTED = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
ATTRIBUTES = ("scheme", "top", "domain", "site", "sub", "first", "second", "rest", "file", "keys", "mark")
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
BLOCK, ALLOW = "block", "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "label="


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens ``attribute=value``; none for a URL without ``://``. Runs of digits count as ``0``."""
    def plain(text):
        return F.regexp_replace(text, "[0-9]+", "0")

    host, path = host_of(url), path_of(url)
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    parts = F.split(host, r"\.")
    n = F.size(parts)
    file = F.regexp_extract(path, r"(?s)\.([^./]*)\z", 1)
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    keys = F.array_join(F.array_sort(F.array_distinct(F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.regexp_extract(x, "(?s)^([^=]*)", 1)))), "&")
    found = {
        "scheme": F.lower(scheme),
        "top": parts[n - 1],
        "domain": F.when(n >= 2, F.array_join(F.slice(parts, -2, 2), ".")),
        "site": F.when(n >= 3, F.array_join(F.slice(parts, -3, 3), ".")),
        "sub": F.when(n >= 4, F.array_join(F.slice(parts, 1, n - 3), ".")),
        "first": F.when(F.size(segments) >= 1, plain(segments[0])),
        "second": F.when(F.size(segments) >= 2, plain(segments[1])),
        "rest": F.when(F.size(segments) >= 3, plain(F.array_join(F.slice(segments, 3, F.greatest(F.size(segments) - 2, F.lit(0))), "/"))),
        "file": F.when(file != "", plain(file)),
        "keys": F.when(keys != "", keys),
        "mark": F.when(url.contains("#"), F.lit("#")),
    }
    listed = F.array(*[F.concat(F.lit(f"{name}="), found[name]) for name in ATTRIBUTES])
    return F.when(url.contains("://"), F.array_compact(listed)).otherwise(F.array().cast("array<string>"))


def listed_rule(host: Column, path: Column, rules=LISTED) -> Column:
    """struct(rule, verdict) of the longest listed rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


@dataclass(frozen=True)
class Rule:
    tokens: tuple[str, ...]
    verdict: str
    count: int
    confidence: float

    @property
    def order(self):
        return (-self.confidence, -self.count, self.verdict == ALLOW, len(self.tokens), self.text)

    @property
    def text(self) -> str:
        return " & ".join(self.tokens)


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, verdict, count, confidence) of the rules in rows (tokens, verdict); tokens sorted."""
    spark = labelled.sparkSession
    none = "tokens array<string>, verdict string, count bigint, confidence double"
    if not labelled.limit(1).count():
        return spark.createDataFrame([], none)
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(_LABEL), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sets = written(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("count")), "url-itemsets")

    def is_label(token):
        return token.startswith(_LABEL)

    plain = sets.filter(~F.exists("items", is_label)).select(F.col("items").alias("tokens"), F.col("count").alias("all"))
    with_label = sets.filter(F.exists("items", is_label) & (F.size("items") > 1)).select(
        F.filter("items", lambda x: ~is_label(x)).alias("tokens"), "count",
        F.substring(F.filter("items", is_label)[0], len(_LABEL) + 1, 1 << 20).alias("verdict"))
    rules = written(with_label.join(plain, "tokens").withColumn("confidence", F.col("count") / F.col("all")).filter(
        F.col("confidence") >= min_confidence).select("tokens", "verdict", "count", "confidence"), "url-rules")
    # A rule is needless if it holds without one of its tokens as surely.
    less = rules.filter(F.size("tokens") > 1).select("tokens", "verdict", "confidence", F.explode("tokens").alias("one")).select(
        "tokens", "verdict", "confidence", F.array_remove("tokens", F.col("one")).alias("fewer"))
    shorter = rules.select(F.col("tokens").alias("fewer"), "verdict", F.col("confidence").alias("as_sure"))
    needless = less.join(shorter, ["fewer", "verdict"]).filter("as_sure >= confidence").select("tokens", "verdict").distinct()
    return rules.join(needless, ["tokens", "verdict"], "left_anti")


class Index:
    """Rules by the token that the fewest rules have."""

    def __init__(self, rules: list[Rule]):
        often: dict[str, int] = {}
        for rule in rules:
            for token in rule.tokens:
                often[token] = often.get(token, 0) + 1
        self.by: dict[str, list[tuple[frozenset, Rule]]] = {}
        for rule in sorted(rules, key=lambda r: r.order):
            rarest = min(rule.tokens, key=lambda t: (often[t], t))
            self.by.setdefault(rarest, []).append((frozenset(rule.tokens), rule))

    def best(self, tokens: list[str]) -> Rule | None:
        have, found = set(tokens), None
        for token in tokens:
            for needed, rule in self.by.get(token, ()):  # best first
                if found is not None and found.order <= rule.order:
                    break
                if needed <= have:
                    found = rule
                    break
        return found


def _judged(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        verdicts, why = [], []
        for verdict, tokens in zip(batch.column("verdict").to_pylist(), batch.column("tokens").to_pylist()):
            rule = index.best(tokens) if verdict is None else None
            verdicts.append(verdict or (rule.verdict if rule else ALLOW))
            why.append(rule.text if rule else None)
        kept = ["page_id", "host", "path", "rule"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept], pa.array(verdicts, type=pa.string()), pa.array(why, type=pa.string())],
            names=[*kept, "verdict", "mined"])


def judge(pages: DataFrame, rules=LISTED, id_col: str = "page_id", url_col: str = "url",
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule (listed), verdict, mined (tokens of the mined rule that decided)."""
    url = F.col("url")
    split = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url")).select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    found = written(split.withColumn("listed", listed_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "tokens", F.col("listed.rule").alias("rule"), F.col("listed.verdict").alias("verdict")), "url-tokens")
    mined = mine(found.filter("verdict IS NOT NULL").select("tokens", "verdict"), min_support, min_confidence)
    index = Index([Rule(tuple(r["tokens"]), r["verdict"], r["count"], r["confidence"]) for r in mined.collect()])  # bounded, see above
    shared = pages.sparkSession.sparkContext.broadcast(index)
    return map_batches(found, lambda it: _judged(it, shared.value),
                       "page_id bigint, host string, path string, rule string, verdict string, mined string")
