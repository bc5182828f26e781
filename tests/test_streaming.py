from pathlib import Path

from mirrorkit.streaming.logs import ship_log_events


def test_ship_only_new_log_files(spark, tmp_dir):
    logs = Path(tmp_dir) / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("2026-01-02_03:04:05.678 INFO a: one\nTraceback x\n")
    sink, ckpt = f"{tmp_dir}/events", f"{tmp_dir}/ckpt"
    assert ship_log_events(spark, str(logs), sink, ckpt) == 2
    (logs / "b.log").write_text("2026-01-02_03:04:06.000 WARN b: two\n")
    assert ship_log_events(spark, str(logs), sink, ckpt) == 1
    rows = sorted((r["message"], r["ts_ms"]) for r in spark.read.parquet(sink).collect())
    assert rows == [("INFO a: one", 1767323045678), ("Traceback x", None), ("WARN b: two", 1767323046000)]
    files = {Path(r["source_file"]).name for r in spark.read.parquet(sink).select("source_file").collect()}
    assert files == {"a.log", "b.log"}
