from pathlib import Path

from mirrorkit.sources.logs import read_log_events


def test_log_lines_to_sorted_events(spark, tmp_dir):
    path = Path(tmp_dir) / "spark.log"
    path.write_text(
        "2026-01-02_03:04:05.678 INFO a.b: hello world  \n"
        "Traceback x\n"
        "2026-01-02_03:04:04.001 WARN c: y\n"
        "2026-01-02_03:04:05.678 INFO a.b: second at same time\n"
        "\n"
    )
    events = [(r["ts_ms"], r["message"]) for r in read_log_events(spark, str(path)).collect()]
    assert events == [
        (1767323044001, "WARN c: y"),
        (1767323045678, "INFO a.b: hello world"),
        (1767323045678, "INFO a.b: second at same time"),
        (None, "Traceback x"),
    ]


def test_ties_keep_file_order_across_files(spark, tmp_dir):
    logs = Path(tmp_dir) / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("2026-01-02_03:04:05.000 INFO x: a1\n")
    (logs / "b.log").write_text("".join(f"2026-01-02_03:04:05.000 INFO x: b{i}\n" for i in range(50)))
    got = [r["message"] for r in read_log_events(spark, str(logs)).collect()]
    assert got == ["INFO x: a1"] + [f"INFO x: b{i}" for i in range(50)]
