"""Corpus pipeline: clean, deduplicate, mix and pack the documents table.

Each stage takes (spark, docs, sf_dir), where docs is all that its predecessor
kept, and returns a DataFrame; ``run`` writes each stage's result as Parquet
and reads it as the next one's docs. All but the last return the columns they
were given.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorkit.llm import jaccard_join, lpf_dedup, mixing, packing, toxicity
from mirrorkit.llm.common import crc32_mod, drop_tables, made_since, table, tables_made, written
from mirrorkit.llm.queries import tokenizer_path


#: Intermediate tables of the stages run so far, by stage number.
_TABLES: dict[int, list[str]] = {}


def _stage(number: int):
    """Marks a stage. When it starts, its predecessors' results have been
    written, so the tables they worked with are deleted."""
    def mark(run):
        @wraps(run)
        def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for done in range(number):
                drop_tables(spark, _TABLES.pop(done, []))
            before = tables_made()
            result = run(spark, docs, sf_dir)
            _TABLES[number] = made_since(before)
            return result
        return stage
    return mark


@_stage(0)
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of at least 0.3 (as query op4 predicts).

    Null and empty texts have no token and are scored like a text without
    evidence, so they stay unless most labelled texts are toxic; without
    labelled rows of both classes everything stays. Repeated rows are judged
    alike; an empty table gives no rows; all columns are kept.
    """
    held_out = F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def _first_texts(docs: DataFrame) -> DataFrame:
    """The first row by id and digest of each group, where several rows have one id.

    Each (id, digest of the text) is a document with a name of its own.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                       F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("digest"))
    names = written(rows.select("id", "digest").distinct().withColumn("name", F.monotonically_increasing_id()),
                    "pipeline-names")
    rows = written(rows.join(names, ["id", "digest"]).dropDuplicates(["name"]).select("name", "row"), "pipeline-rows")
    found = jaccard_join.jaccard_components(rows.select("name", "row.text"), id_col="name")
    first = found.join(names, F.col("doc_id") == F.col("name")).groupBy("component_id").agg(
        F.min(F.struct("id", "digest", "name")).alias("least"))
    first = written(first.select("least.name"), "pipeline-groups")
    return jaccard_join.only(rows, first, "name").select("row.*")


@_stage(1)
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group linked by shingle similarity.

    Documents without words or id are linked with nothing and stay. Rows equal
    in id and text are one document; other rows that share an id are several.
    """
    with_id = docs.filter("doc_id IS NOT NULL")
    if with_id.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").limit(1).count():
        kept = _first_texts(with_id)
    else:
        found = written(jaccard_join.jaccard_components(docs), "pipeline-groups")
        kept = jaccard_join.only(docs, found.filter("doc_id = component_id").select("doc_id"))
    return kept.unionByName(docs.filter("doc_id IS NULL"))


@_stage(2)
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 200 bytes or more that an earlier document or place has; every document stays."""
    cut = lpf_dedup.dedup_passages(docs, keep="first", characters=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("row.text"))
    out = cut.select("row", text.alias("cut"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.col("cut")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("row.text").isNull(), F.col("row.n_chars")).otherwise(
            F.char_length("cut").cast(docs.schema["n_chars"].dataType))
    return out.select(*[col.alias(c) for c, col in columns.items()])


@_stage(3)
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources (at most twice) towards even weights; files are in the mixture's order.

    Every row is used once at least, those without text or source too (a null
    source is a source). Rows equal in id and text go together; ties in the
    order are broken by id and epoch; an empty table gives no rows; all columns
    are kept.
    """
    return mixing.mixture(docs)


@_stage(4)
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens.

    Null and empty texts are the end token alone; rows that repeat an id are
    documents of their own; an empty table gives no rows; other columns don't
    matter.
    """
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages learn a model, hash and tokenize: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
