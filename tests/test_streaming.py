"""Live tracking of logs that are still written, over restarts."""

import os

import pytest

from tidemark.sources import tail
from tidemark.streaming import live_tracking as live


def put(path, text, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode, newline="") as f:
        f.write(text)


@pytest.fixture
def tracked(spark, tmp_path):
    def run(quiet=3600.0):
        stream = live.watch_trim_logs(spark, str(tmp_path / "logs"), quiet_seconds=quiet)
        live.start(stream, str(tmp_path / "counts"), str(tmp_path / "state")).awaitTermination()
        counts = sorted(tuple(r) for r in live.read_counts(spark, str(tmp_path / "counts")).collect())
        waiting = sorted(tuple(r) for r in live.waiting_logs(spark, str(tmp_path / "counts")).collect())
        return counts, waiting

    return run


def test_a_log_written_in_parts(tracked, tmp_path):
    log = tmp_path / "logs" / "S1_trim_pass1.txt"
    put(log, "cutadapt 4\nTotal read pairs proc")
    assert tracked() == ([], [("S1", "raw")])
    put(log, "essed:   1,0", "a")
    assert tracked() == ([], [("S1", "raw")])  # half a number is no count
    put(log, "00\nTotal read pairs processed: 7\n", "a")
    put(tmp_path / "logs" / "deep" / "S2_trim_pass2.txt", "Pairs written (passing filters):  800 (80.0%)\r\n")
    assert tracked() == ([("S1", "raw", 1000), ("S2", "trimmed", 800)], [])
    put(log, "Total read pairs processed: 5\n", "a")
    assert tracked()[0] == [("S1", "raw", 1000), ("S2", "trimmed", 800)]  # the first count line counts


def test_late_files_and_unfinished_last_lines(tracked, tmp_path):
    put(tmp_path / "logs" / "S1_trim_pass1.txt", "Total read pairs processed: 10\n")
    assert tracked()[0] == [("S1", "raw", 10)]
    late = tmp_path / "logs" / "S0_trim_pass1.txt"
    put(late, "Total read pairs processed: 3")  # without a line end, but old
    os.utime(late, (0, 0))
    put(tmp_path / "logs" / "notes.txt", "Total read pairs processed: 99\n")
    assert tracked() == ([("S0", "raw", 3), ("S1", "raw", 10)], [])
    assert tracked() == ([("S0", "raw", 3), ("S1", "raw", 10)], [])


def test_lines_delivered_again_or_out_of_order(spark, tmp_path):
    """The state keeps the earliest count line, whatever the batches bring."""
    schema = "file string, offset bigint, value string"
    source = tmp_path / "in"
    line = "Total read pairs processed: {}"
    batches = [
        [("x/A_trim_pass1.txt", 50, line.format("2,000")), ("x/A_trim_pass1.txt", 90, "rubbish")],
        [("x/A_trim_pass1.txt", 50, line.format("2,000")), ("x/B_trim_pass1.txt", 0, "start")],
        [("x/A_trim_pass1.txt", 20, line.format("1,000")), ("x/A_trim_pass1.txt", 50, line.format("2,000"))],
        [("x/B_trim_pass1.txt", 0, "start"), ("x/A_trim_pass1.txt", 90, line.format(7))],
    ]
    wants = [({"A": 2000}, 1), ({"A": 2000}, 2), ({"A": 1000}, 3), ({"A": 1000}, 3)]
    for k, (rows, (want, written)) in enumerate(zip(batches, wants)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = live.first_counts(live.count_lines(spark.readStream.schema(schema).parquet(str(source))))
        live.start(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        assert {r["sample"]: r.reads for r in live.read_counts(spark, str(tmp_path / "out")).collect()} == want, k
        assert spark.read.parquet(str(tmp_path / "out")).count() == written  # nothing new, nothing written


def test_parts_of_a_file_give_every_line_once(tmp_path, monkeypatch):
    text = "".join(f"line {k} {'é' * (k % 9)}\n" for k in range(200)) + "end"
    put(tmp_path / "a.txt", text)
    raw = text.encode()
    want = [(i, t.decode()) for i, t in zip([0] + [k + 1 for k, b in enumerate(raw) if b == 10], raw.split(b"\n"))]
    reader = tail._TailReader({"path": str(tmp_path), "suffix": ".txt", "quiet_seconds": 0})
    for part, chunk in ((1 << 27, 1 << 16), (100, 7), (13, 64)):
        monkeypatch.setattr(tail, "PART", part)
        monkeypatch.setattr(tail, "CHUNK", chunk)
        parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
        got = [(offset, value) for p in parts for _, offset, value in reader.read(p)]
        assert got == want and (part > 1000 or len(parts) > 10)


def test_nothing_there(tracked, spark, tmp_path):
    (tmp_path / "logs").mkdir()
    stream = live.watch_trim_logs(spark, str(tmp_path / "logs"))
    live.start(stream, str(tmp_path / "counts"), str(tmp_path / "state")).awaitTermination()
    put(tmp_path / "logs" / "S1_trim_pass2.txt", "Pairs written (passing filters): 4\n")
    assert tracked()[0] == [("S1", "trimmed", 4)]
