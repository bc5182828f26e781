import hashlib

from mirrorkit.llm import warc
from mirrorkit.llm.common import written
from mirrorkit.session import work_dir

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: {n}\r\n\r\n{body}\r\n\r\n"


def expected(rows):
    out = []
    first = {}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and page_id is not None:
            first[raw] = min(first.get(raw, page_id), page_id)
    counts = {}
    for _, _, html in rows:
        counts[html or ""] = counts.get(html or "", 0) + 1
    for page_id, _, html in rows:
        raw = (html or "").encode()
        again = raw in first and counts[html or ""] > 1 and page_id != first[raw]
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                    first[raw] if again else None))
    return sorted(out, key=repr)


def rows_read(df):
    return sorted((tuple(r) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def pages():
    nested = "".join(FAKE.format(n=len(b), body=b) for b in ("hello", "x" * 40))
    rows = [
        (1, "http://a/", "<p>" + "same " * 40), (2, "http://b/", "<p>" + "same " * 40), (3, None, None), (4, "http://d/", ""),
        (5, "http://é/ü", "é" * 300), (6, "http://f/\r\nX: y", nested), (7, "http://g/", "WARC/1.1\r\n" * 30),
        (8, "u", "before " + FAKE.format(n=999_999, body="far") + "after"), (None, None, "<p>" + "same " * 40),
        (9, "u", "tail WARC/1.1\r\n"), (10, "u", "short"), (11, "u", "short"), (12, "u", "\r\n\r\n" * 5), (13, "u", "z" * 50_000),
        (14, "u", "WARC/1.1\r\nContent-Length: 0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\n\r\n\r\n\r\n"),
    ]
    return rows + [(100 + i, "http://p/", f"page {i} " * (i % 37)) for i in range(120)] + [(1, "http://a/", "<p>" + "same " * 40)]


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "s", 1, "h") for r in rows],
        "page_id bigint, url string, html string, digest string, n int, file string")


def test_round_trip_with_false_magic(small_shuffles):
    rows = pages()
    assert rows_read(warc.warc_round_trip(frame(small_shuffles, rows).repartition(2))) == expected(rows)


def test_splits_inside_records_and_payloads(small_shuffles):
    spark = small_shuffles
    rows = pages()
    path = work_dir(spark, "warc-test")
    warc.write_warc(frame(spark, rows).coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert rows_read(warc.read_warc(spark, path)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_pointer_jumping_follows_many_runs(small_shuffles):
    # Every real record's payload holds a false one, so that each record is a run of its own.
    rows = [(i, "u", FAKE.format(n=3, body="abc") + "rest") for i in range(40)]
    assert rows_read(warc.warc_round_trip(frame(small_shuffles, rows).coalesce(1))) == expected(rows)


def test_no_file_is_read_whole(small_shuffles, monkeypatch):
    from pyspark.sql import DataFrameReader

    spark = small_shuffles
    torn = FAKE.format(n=3, body="abc") + "WARC/1.1\r\n" + "é" * 200 + FAKE.format(n=5, body="12345")
    rows = [(i, "u", torn + str(i) if i % 50 == 7 else f"page {i} " * 800) for i in range(300)]
    path = work_dir(spark, "warc-test")
    warc.write_warc(frame(spark, rows).coalesce(1), path)
    sizes = spark.read.format("binaryFile").load(path).agg({"length": "max"}).first()[0]
    assert sizes > 1_500_000  # one file; its torn records have under 1,000 bytes each
    plain = DataFrameReader.format

    def refused(self, source):
        assert source != "binaryFile", "a file was read whole"
        return plain(self, source)

    monkeypatch.setattr(DataFrameReader, "format", refused)
    kept = []

    def watched(df, purpose):
        out = written(df, purpose)
        if purpose == "warc-owned":
            kept.extend(out.groupBy("o_file", "record_at").sum("o_size").collect())
        return out

    monkeypatch.setattr(warc, "written", watched)
    assert rows_read(warc.read_warc(spark, path)) == expected(rows)
    assert len(kept) == 6 and max(r[2] for r in kept) < 2_000  # what a task puts together


def test_no_pages(small_shuffles):
    assert warc.warc_round_trip(frame(small_shuffles, [])).count() == 0


def test_files_are_plain_warc(small_shuffles):
    spark = small_shuffles
    path = work_dir(spark, "warc-test")
    warc.write_warc(frame(spark, [(1, "http://a/", "héllo")]).coalesce(1), path)
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect())
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith("\r\n\r\nhéllo\r\n\r\n".encode())
    assert b"Content-Length: 6\r\n" in raw
