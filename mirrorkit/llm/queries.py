"""Registered queries of the training-data operators, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorkit.llm import gnat_negatives, hnsw_dedup, jaccard_join, kmeans_tree, lang_id, lpf_dedup, merkle, mixing, packing, sharding, toxicity, url_rules, warc
from mirrorkit.llm.common import crc32_mod, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first, count(*) AS c FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.c > 1 AND (page_id IS NULL OR page_id <> f.first) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.c > 1 AND (page_id IS NULL OR page_id <> f.first) THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100 AND f.first IS NOT NULL
"""


def op3_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf_dedup.dedup_passages(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# All windows of 200 bytes are named and counted.
OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS id, doc_id, encode(coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT id, pos, md5_number(x[pos + 1:pos + 200]) AS name FROM (
  SELECT id, x, unnest(generate_series(0, n - 200)) AS pos FROM d WHERE n >= 200)),
h AS (SELECT id, pos FROM w WHERE name IN (SELECT name FROM w GROUP BY name HAVING count(*) > 1)),
g AS (SELECT id, pos, CASE WHEN pos > lag(pos) OVER (PARTITION BY id ORDER BY pos) + 200 THEN 1 ELSE 0 END AS new FROM h),
i AS (SELECT id, pos, sum(new) OVER (PARTITION BY id ORDER BY pos) AS island FROM g),
s AS (SELECT id, min(pos) AS a, max(pos) + 200 AS b FROM i GROUP BY id, island),
k AS (SELECT id, count(*) AS spans, sum(b - a) AS gone, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends FROM s GROUP BY id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN spans IS NULL THEN hex(x) ELSE array_to_string(list_transform(generate_series(0, spans), lambda j:
  hex(x[coalesce(ends[j], 0) + 1:coalesce(starts[j + 1], n)])), '') END)) AS kept_sha256
FROM d LEFT JOIN k USING (id)
"""


def op4_toxicity_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model, carry=["doc_id"]).select("row.doc_id", "score", "stretches").select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.col("stretches").alias("spans"))


def op5_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op6_segmentation_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False))
    model = lang_id.fit(docs, tokenizer_path("piece_bpe_32k.model"), ~held_out)
    return lang_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id", "source"]).select(
        "row.doc_id", "row.source", "epoch", "tokens", "block", "turn")


def op8_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"))
    return sharding.shuffle_to_shards(slim, 16).select(
        "row.*", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_heavy_light_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


# All pairs that share a shingle are counted; what links reach is followed to its end.
OP9_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{merkle._UPPER}', '{merkle._LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')] ELSE list_distinct(
  list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i+4], ' '))) END AS shingles FROM w),
t AS (SELECT doc_id, len(shingles) AS n, hash(unnest(shingles)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS shared FROM t a JOIN t b ON a.h = b.h AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id, a.n, b.n),
l AS (SELECT a, b FROM p WHERE 100 * shared >= 80 * (na + nb - shared)),
r AS (SELECT DISTINCT a AS id, a AS met FROM l UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.met)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, coalesce(m.least, doc_id) AS component_id
FROM s LEFT JOIN (SELECT id, min(met) AS least FROM r GROUP BY id) m ON m.id = doc_id
"""


def op10_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0) a JOIN v b ON a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""


def op12_fpgrowth_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def _op12_sql() -> str:
    """All token subsets of the labelled URLs are counted; FP-growth visits the frequent ones only."""
    def plain(text):
        return f"regexp_replace({text}, '[0-9]+', '0', 'g')"

    longest_first = sorted(url_rules.LISTED, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}')", h + p, v) for h, p, v in longest_first]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{name}'" for f, name, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"
    found = {
        "scheme": "lower(regexp_extract(url, '(?s)^(.*?)://', 1))",
        "top": "p[n]",
        "domain": "CASE WHEN n >= 2 THEN array_to_string(p[n-1:n], '.') END",
        "site": "CASE WHEN n >= 3 THEN array_to_string(p[n-2:n], '.') END",
        "sub": "CASE WHEN n >= 4 THEN array_to_string(p[1:n-3], '.') END",
        "first": plain("s[1]"),
        "second": plain("s[2]"),
        "rest": f"CASE WHEN len(s) >= 3 THEN {plain('array_to_string(s[3:], chr(47))')} END",
        "file": plain(r"nullif(regexp_extract(path, '(?s)\.([^./]*)\z', 1), '')"),
        "keys": "nullif(array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split(regexp_extract("
                r"url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> ''), "
                "lambda x: regexp_extract(x, '(?s)^([^=]*)', 1)))), '&'), '')",
        "mark": "CASE WHEN contains(url, '#') THEN '#' END",
    }
    tokens = ", ".join(f"'{name}=' || {found[name]}" for name in url_rules.ATTRIBUTES)
    subsets = "list_sort(list_filter(tokens, lambda t, i: (m >> (i - 1)) & 1 = 1))"
    return (
        "WITH u AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), "
        f"'{url_rules._UPPER}', '{url_rules._LOWER}') AS host, "
        "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages), "
        "q AS (SELECT *, string_split(host, '.') AS p, len(string_split(host, '.')) AS n, "
        "list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM u), "
        f"k AS (SELECT row_number() OVER () AS id, page_id, host, path, {rule} AS rule, {verdict} AS verdict, "
        f"CASE WHEN contains(url, '://') THEN list_filter([{tokens}], lambda x: x IS NOT NULL) ELSE [] END AS tokens FROM q), "
        "x AS (SELECT *, unnest(generate_series(1, (1 << len(tokens)) - 1)) AS m FROM k), "
        f"y AS (SELECT id, verdict, {subsets} AS t FROM x), "
        "c AS (SELECT t, verdict, count(*) AS n, sum(count(*)) OVER (PARTITION BY t) AS total FROM y "
        "WHERE verdict IS NOT NULL GROUP BY t, verdict), "
        f"r AS (SELECT t, verdict, n, n / total AS sure FROM c WHERE n >= (SELECT ceil({url_rules.MIN_SUPPORT} * count(*)) FROM k "
        f"WHERE verdict IS NOT NULL) AND n / total >= {url_rules.MIN_CONFIDENCE}), "
        "b AS (SELECT y.id, r.verdict, array_to_string(r.t, ' & ') AS mined, row_number() OVER (PARTITION BY y.id ORDER BY "
        "sure DESC, n DESC, r.verdict = 'allow', len(r.t), array_to_string(r.t, ' & ')) AS place "
        "FROM y JOIN r ON y.t = r.t WHERE y.verdict IS NULL) "
        "SELECT page_id, host, path, rule, coalesce(k.verdict, b.verdict, 'allow') AS verdict, mined "
        "FROM k LEFT JOIN b ON k.id = b.id AND b.place = 1")


OP12_SQL = _op12_sql()


def merkle_rows(docs: DataFrame, stride: int = merkle.STRIDE) -> DataFrame:
    folded = merkle.folded(F.coalesce("changed", "leaf"), F.col("steps"))
    return merkle.manifest(docs, stride).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_rows(table(spark, sf_dir, "documents"))


def _op13_sql(levels: int = 6, upper: int = 3) -> str:
    """The trees level by level: ``levels`` inside languages, ``upper`` above them."""
    def field(name):
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(CAST({name} AS VARCHAR)) || ':' || {name} END"

    def leaf(text):
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = f"translate(text, '{merkle._UPPER}', '{merkle._LOWER}')"
    crc = ("xor(list_reduce(list_transform(generate_series(1, length(s)), lambda i: CAST(ascii(s[i]) AS UBIGINT)), "
           "lambda acc, b: list_reduce(CAST([1, 2, 3, 4, 5, 6, 7, 8] AS UBIGINT[]), "
           "lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(acc, b)), CAST(4294967295 AS UBIGINT)), "
           "CAST(4294967295 AS UBIGINT))")
    parts = [
        f"d AS (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf(lowered)} AS low, CAST(doc_id AS VARCHAR) AS s FROM documents)",
        f"k AS (SELECT doc_id, coalesce('=' || lang, '') AS g, leaf, CASE WHEN coalesce({crc} % 3 = 0, false) THEN low ELSE leaf END "
        "AS changed, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)",
        "l0 AS (SELECT g, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM k)"]

    def up(name, groups):
        return (f"SELECT {groups}pos // 8 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h, "
                f"(n + 7) // 8 AS n FROM {name} GROUP BY {groups}pos // 8, n")

    parts += [f"l{i + 1} AS ({up(f'l{i}', 'g, ')})" for i in range(levels)]
    parts.append(f"u0 AS (SELECT g, row_number() OVER (ORDER BY g) - 1 AS pos, h, count(*) OVER () AS n FROM l{levels})")
    parts += [f"u{i + 1} AS ({up(f'u{i}', '')})" for i in range(upper)]
    # Each document's way: its place, what it folds to so far, and the siblings met.
    parts.append("w0 AS (SELECT row_number() OVER () AS id, doc_id, leaf, g, pos, changed AS acc, '' AS met FROM k)")

    def step(i, name, same_group):
        return (f"SELECT w.id, w.doc_id, w.leaf, w.g, w.pos // 8 AS pos, CASE WHEN max(n) > 1 THEN sha256(string_agg("
                f"CASE WHEN x.pos = w.pos THEN acc ELSE h END, '' ORDER BY x.pos)) ELSE acc END AS acc, "
                f"met || coalesce(string_agg(h, '' ORDER BY x.pos) FILTER (x.pos <> w.pos), '') AS met "
                f"FROM w{i} w JOIN {name} x ON {same_group}x.pos // 8 = w.pos // 8 "
                f"GROUP BY w.id, w.doc_id, w.leaf, w.g, w.pos, acc, met")

    parts += [f"w{i + 1} AS ({step(i, f'l{i}', 'x.g = w.g AND ')})" for i in range(levels)]
    parts.append(f"v0 AS (SELECT w.* EXCLUDE (pos), u0.pos, u0.h AS subroot FROM w{levels} w JOIN u0 ON w.g = u0.g)")
    for i in range(upper):
        body = step(i, f"u{i}", "").replace(f"FROM w{i} w", f"FROM v{i} w").replace("w.leaf, w.g,", "w.leaf, w.subroot, w.g,")
        parts.append(f"v{i + 1} AS ({body})")
    return (f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, r.h AS root, sha256(met) AS proof_sha256, acc AS folded_root, "
            f"acc = r.h AS verified FROM v{upper}, u{upper} r")


OP13_SQL = _op13_sql()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_warc_chain": op2_warc_chain,
    "op3_lpf_dedup": op3_lpf_dedup,
    "op4_toxicity_field": op4_toxicity_field,
    "op5_kmeans_tree": op5_kmeans_tree,
    "op6_segmentation_langid": op6_segmentation_langid,
    "op7_temperature_mixing": op7_temperature_mixing,
    "op8_hypergeometric_shards": op8_hypergeometric_shards,
    "op9_heavy_light_jaccard": op9_heavy_light_jaccard,
    "op10_hnsw_dedup": op10_hnsw_dedup,
    "op11_gnat_negatives": op11_gnat_negatives,
    "op12_fpgrowth_urls": op12_fpgrowth_urls,
    "op13_merkle_checkpoints": op13_merkle_checkpoints,
}

ORACLES: dict[str, str] = {
    "op2_warc_chain": OP2_SQL,
    "op3_lpf_dedup": OP3_SQL,
    "op9_heavy_light_jaccard": OP9_SQL,
    "op11_gnat_negatives": OP11_SQL,
    "op12_fpgrowth_urls": OP12_SQL,
    "op13_merkle_checkpoints": OP13_SQL,
}
