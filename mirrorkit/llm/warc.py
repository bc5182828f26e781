"""WARC archives: writing with revisit records, reading by boundary chains.

Writing. A page's payload is its html in UTF-8. Of equal payloads of at least
``min_revisit`` bytes the smallest page id is written whole, the others as
revisit records without a block. Records go through Spark's text writer with
the record separator as line separator, so files are plain WARC, written by
the JVM with Spark's commit protocol to whatever file system the folder names.

Reading. Files are split among tasks. A task finds each occurrence of the
magic line in its range and takes it as a *candidate* record: it reads the
header behind it and emits the candidate's offset and the offset its length
header names as its successor. Payloads may contain the magic, so a candidate
is kept only if the chain that starts at the file's first byte reaches it:

* candidates whose successor is the very next candidate form runs;
* from run to run, pointer jumping doubles the distance each round, starting
  with the run at offset 0, until no new run is reached;
* of a reached run the candidates from the entry point on are records.

A record whose block holds rejected candidates is put together from the rows
between its magic and its successor's: the files that have such records (and
only those) are split again, and only these rows are kept. No task holds more
than a record; ``RECORDS_PER_FILE`` bounds what offsets are summed over.

Defined results: null html is an empty payload; a null or unprintable url is
written percent-encoded; null page ids are written as ``null`` and read back
as null; equal rows are written once each; an empty table writes no record and
reads as no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mirrorkit.llm.common import written
from mirrorkit.session import work_dir

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT = 100
RECORDS_PER_FILE = 20_000
#: Rows of torn blocks (offsets, under 100 bytes each) up to which they are broadcast.
BROADCAST_ROWS = 200_000


def _revisits(pages: DataFrame, min_revisit: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages to be written as revisits.

    Only digests and ids are shuffled; the first id of a digest is found with
    partial aggregates, so a payload that a third of the pages share is one
    row per task there. Written, so that its true size decides how it joins.
    """
    digests = pages.filter(F.col("n") >= min_revisit).select("page_id", "digest")
    first = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
    first = first.filter("copies > 1 AND refers_to IS NOT NULL").drop("copies")
    found = digests.join(first, "digest").filter("page_id IS NULL OR page_id <> refers_to").distinct()
    return written(found.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to"),
                   "warc-revisits")


def write_warc(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT,
               id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write one record per row of ``pages`` into WARC files under ``path``."""
    slim = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    hashed = slim.withColumn("n", F.octet_length("payload")).withColumn("digest", F.sha2("payload", 256))
    revisits = _revisits(hashed, min_revisit)
    joined = hashed.join(
        revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    again = F.col("r_digest").isNotNull()
    url = F.coalesce(F.col("url"), F.lit(""))
    url = F.when(url.rlike(r"^[\x21-\x7e]+$"), url).otherwise(F.concat(F.lit("urn:encoded:"), F.url_encode(url)))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    header = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">\r\n")),
        line("WARC-Target-URI", url),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("n").cast("string")),
        F.when(again, F.concat(
            F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">\r\n"),
            F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.when(again, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit("\r\n"),
    )
    record = F.concat(header, F.when(again, F.lit("")).otherwise(F.col("payload")))
    joined.select(record.alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", records_per_file).text(path)


def _raw(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, file, block, row): the text up to each magic line, numbered in the reader's order."""
    return spark.read.option("lineSep", MAGIC).text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _torn_digests(spark: SparkSession, placed: DataFrame, true_at: DataFrame, torn: DataFrame, files: list[str]) -> DataFrame:
    """(file, at, block_digest) of the records whose blocks hold magic lines.

    A row belongs to the last true record before it. The rows of the torn
    records are read again by their place in their split, and joined.
    """
    in_files = placed.join(torn.select("file").distinct(), "file", "left_semi")
    firsts = in_files.groupBy("file", "block").agg(F.min("row").alias("first"))
    order = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owner = F.last(F.when(F.col("alone_").isNotNull(), F.struct("at", "alone_")), ignorenulls=True).over(order)
    owned = in_files.join(firsts, ["file", "block"]).join(true_at.withColumnRenamed("alone", "alone_"), ["file", "at"], "left").select(
        F.col("file").alias("o_file"), F.col("block").alias("o_block"), (F.col("row") - F.col("first")).alias("o_rank"), "at",
        F.col("size").alias("o_size"), owner.alias("owner")).filter("NOT owner.alone_").select(
        "o_file", "o_block", "o_rank", "at", "o_size", F.col("owner.at").alias("record_at"))
    owned = written(owned, "warc-owned")
    raw = _raw(spark, files)
    begins = raw.groupBy("file", "block").agg(F.min("row").alias("begin")).withColumnsRenamed({"file": "b_file", "block": "b_block"})
    again = raw.join(begins, (F.col("file") == F.col("b_file")) & (F.col("block") == F.col("b_block"))).withColumn(
        "rank", F.col("row") - F.col("begin"))
    small = owned.count() <= BROADCAST_ROWS
    rows = again.join(F.broadcast(owned) if small else owned, (F.col("file") == F.col("o_file")) & (F.col("block") == F.col("o_block")) & (
        F.col("rank") == F.col("o_rank"))).select("o_file", "record_at", "at", "o_size", "value")
    same = F.when(F.octet_length("value") == F.col("o_size"), F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("archive changed while it was read: "), F.col("o_file"))).cast("string"))
    records = rows.groupBy("o_file", "record_at").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("at", same.alias("value")))), lambda x: x.value), MAGIC).alias("text"))
    block = F.expr("substring(CAST(text AS BINARY), int(head_len) + 1, int(content))")
    return records.join(torn, (F.col("o_file") == F.col("file")) & (F.col("record_at") == F.col("at"))).select(
        "file", torn["at"], F.sha2(block, 256).alias("block_digest"))


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every occurrence of the magic line with its offset and its successor's.

    A row is the text from one magic line to the next. Row order inside a
    split is the reader's; offsets are running sums over the splits of a file.
    The digest of a whole block is taken here, so no text travels on.
    """
    raw = _raw(spark, [path])
    head_len = F.expr(f"locate('{END}', value)").cast("bigint") + 3  # the header with its empty line
    rows = (
        raw.withColumn("size", F.octet_length("value").cast("bigint"))
        .withColumn("head_len", F.when(F.expr(f"locate('{END}', value)") > 0, head_len))
        .withColumn("head", F.expr("CASE WHEN head_len IS NOT NULL THEN substring(value, 1, int(head_len)) END"))
    )

    def field(pattern):
        got = F.regexp_extract("head", pattern, 1)
        return F.when(got != "", got)

    rows = rows.select(
        "file", "block", "row", "size", "head_len", "value",
        field(r"(?:^|\r\n)Content-Length: (\d{1,18})\r\n").cast("bigint").alias("content"),
        field(r"(?:^|\r\n)WARC-Type: (\w+)\r\n").alias("record_type"),
        field(r"(?:^|\r\n)WARC-Record-ID: <urn:page:(-?\d+|null)>\r\n").alias("page"),
        field(r"(?:^|\r\n)WARC-Refers-To: <urn:page:(-?\d+)>\r\n").cast("bigint").alias("refers_to"),
        field(r"(?:^|\r\n)WARC-Payload-Digest: sha256:([0-9a-f]{64})\r\n").alias("named_digest"),
        field(r"(?:^|\r\n)WARC-Payload-Length: (\d{1,18})\r\n").cast("bigint").alias("named_length"),
    )
    # The whole record is this row if block and separator end where the next magic stands.
    alone = F.coalesce(F.col("size") == F.col("head_len") + F.col("content") + 4, F.lit(False))
    block = F.expr("substring(CAST(value AS BINARY), int(head_len) + 1, int(content))")
    return rows.withColumn("alone", alone).withColumn(
        "block_digest", F.when(F.col("alone"), F.sha2(block, 256))).drop("value")


def _with_offsets(rows: DataFrame) -> DataFrame:
    """Adds ``at``, the magic's byte offset (negative: text before the first one), and ``next``."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    n = len(MAGIC)
    splits = rows.groupBy("file", "block").agg(F.sum(F.col("size") + n).alias("bytes"))
    starts = splits.select(F.col("file").alias("s_file"), F.col("block").alias("s_block"),
                           F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    placed = rows.withColumn("inner", F.coalesce(F.sum(F.col("size") + n).over(inside), F.lit(0))).join(
        starts, (F.col("file") == F.col("s_file")) & (F.col("block") == F.col("s_block"))).drop("s_file", "s_block")
    placed = placed.withColumn("at", F.col("base") + F.col("inner") - n).drop("base", "inner")
    return placed.withColumn("next", F.col("at") + n + F.col("head_len") + F.col("content") + 4)


def chain_runs(candidates: DataFrame) -> DataFrame:
    """Adds ``run``: the offset of the first candidate of the unbroken chain a candidate is in."""
    order = Window.partitionBy("file").orderBy("at")
    start = F.coalesce(F.lag("next").over(order) != F.col("at"), F.lit(True))
    return candidates.withColumn("head_at", F.when(start, F.col("at"))).withColumn(
        "run", F.last("head_at", ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("head_at")


def reached_runs(runs: DataFrame) -> DataFrame:
    """(file, run, entry): the runs that the chain from offset 0 reaches, by pointer jumping.

    ``runs`` has file, at, next and run per candidate. A run's pointer is the
    successor of its last candidate: the run that holds a candidate at that
    very offset, entered there. Each round follows the pointers of all runs
    reached so far and replaces each pointer by its pointer's pointer, so a
    path of n runs takes log2(n) rounds. Files without false magic lines are
    one run, and no round is needed.
    """
    exits = runs.groupBy("file", "run").agg(F.max_by("next", "at").alias("exit"))
    to = runs.select("file", F.col("at").alias("exit"), F.col("run").alias("to_run"), F.col("at").alias("entry"))
    jump = written(exits.join(to, ["file", "exit"]).select("file", "run", "to_run", "entry"), "warc-jumps")
    reached = written(runs.filter("at = 0").select("file", F.col("run"), F.col("at").alias("entry")), "warc-reached")
    found = reached.count()
    while True:
        step = reached.drop("entry").join(jump, ["file", "run"]).select("file", F.col("to_run").alias("run"), "entry")
        merged = reached.unionByName(step).groupBy("file", "run").agg(F.min("entry").alias("entry"))
        reached = written(merged, "warc-reached")
        now = reached.count()
        if now == found:
            return reached
        found = now
        ahead = jump.select("file", F.col("run").alias("to_run"), F.col("to_run").alias("far_run"),
                            F.col("entry").alias("far_entry"))
        jump = written(jump.join(ahead, ["file", "to_run"]).select(
            "file", "run", F.col("far_run").alias("to_run"), F.col("far_entry").alias("entry")), "warc-jumps")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files under ``path``.

    Returns page_id, record_type, refers_to, payload_bytes, payload_digest
    (of a revisit: as its header names them), block_bytes, block_digest.
    """
    rows = written(_candidates(spark, path), "warc-rows")
    placed = _with_offsets(rows)
    whole = placed.filter("next IS NOT NULL AND at >= 0 AND page IS NOT NULL")
    runs = written(chain_runs(whole.select("file", "at", "next", "alone")), "warc-runs")
    reached = reached_runs(runs)
    true_at = runs.join(reached, ["file", "run"]).filter("at >= entry").select("file", "at", "alone")

    fields = ("file", "at", "page", "record_type", "refers_to", "named_digest", "named_length", "content", "block_digest")
    easy = placed.filter("alone").join(true_at.filter("alone").drop("alone"), ["file", "at"], "left_semi").select(*fields)

    # Blocks with a magic line inside: put together from their rows.
    torn = written(placed.join(true_at.filter("NOT alone").drop("alone"), ["file", "at"], "left_semi").select(
        *[c for c in fields if c != "block_digest"], "head_len"), "warc-torn")
    files = [r["file"] for r in torn.select("file").distinct().collect()]  # names only
    mended = None
    if files:
        digests = _torn_digests(spark, placed, true_at, torn, files)
        mended = torn.join(digests, ["file", "at"]).select(*fields)

    again = F.col("record_type") == "revisit"
    return (easy.unionByName(mended) if mended is not None else easy).select(
        F.when(F.col("page") != "null", F.col("page")).cast("bigint").alias("page_id"),
        F.when(again, F.col("named_length")).otherwise(F.col("content")).alias("payload_bytes"),
        F.when(again, F.col("named_digest")).otherwise(F.col("block_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        F.col("content").alias("block_bytes"),
        "block_digest",
    )


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as WARC under the shared folder and read the archives back."""
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path)
