import json

import pytest

from tidecast.sources import message_files
from tidecast.sources.message_files import MessageReader, message_stream


def lines_of(reader, start, end):
    out = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            out += zip(*(c.to_pylist() for c in batch.columns))
    return out


@pytest.mark.parametrize("range_bytes", [1, 2, 3, 7, 1000])
def test_every_line_is_in_one_range(tmp_path, range_bytes):
    """Whatever the ranges, also with empty lines, long ones, several bytes a letter and bad bytes."""
    (tmp_path / "b").mkdir()
    (tmp_path / "a.txt").write_bytes("one\n\nüü\n".encode() + b"\xff\n" + b"x" * 50 + b"\nno break")
    (tmp_path / "b" / "c.txt").write_bytes(b"last\nnot yet")
    (tmp_path / "_done").write_bytes(b"no message\n")
    reader = MessageReader({"path": str(tmp_path), "range_bytes": str(range_bytes)})
    end = reader.latestOffset()
    assert end == {"segment": "b/c.txt", "position": 5}
    got = lines_of(reader, reader.initialOffset(), end)
    assert [v for _, _, v in got] == ["one", "", "üü", "�", "x" * 50, "no break", "last"]
    assert [p for n, p, _ in got if n == "a.txt"] == [0, 4, 5, 10, 12, 63]
    with (tmp_path / "b" / "c.txt").open("ab") as f:
        f.write(b", now\n")
    assert lines_of(reader, end, reader.latestOffset()) == [("b/c.txt", 5, "not yet, now")]
    assert lines_of(reader, reader.latestOffset(), reader.latestOffset()) == []


def test_empty_and_missing_folders(tmp_path):
    for path in (tmp_path, tmp_path / "none"):
        reader = MessageReader({"path": str(path)})
        assert reader.latestOffset() == reader.initialOffset() and reader.partitions({"segment": "", "position": 0}, reader.latestOffset()) == []


def test_a_last_line_longer_than_a_block(tmp_path, monkeypatch):
    monkeypatch.setattr(message_files, "BLOCK", 4)
    (tmp_path / "a").write_bytes(b"one\n" + b"y" * 30)
    reader = MessageReader({"path": str(tmp_path)})
    assert reader.latestOffset() == {"segment": "a", "position": 4}
    (tmp_path / "b").write_bytes(b"z" * 30)
    assert reader.latestOffset() == {"segment": "a", "position": 4}


def test_restart_loses_and_doubles_nothing(spark, tmp_path):
    folder, table, state, done = (str(tmp_path / n) for n in ("in", "table", "state", "done.json"))
    (tmp_path / "in").mkdir()

    def run():
        stream = message_stream(spark, folder, range_bytes=16, committed=done)
        stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["value"] for r in spark.read.schema("value string").parquet(table).collect())

    (tmp_path / "in" / "0").write_text("".join(f"message {i}\n" for i in range(20)) + "mess")
    assert run() == sorted(f"message {i}" for i in range(20))
    assert run() == sorted(f"message {i}" for i in range(20))
    with (tmp_path / "in" / "0").open("a") as f:
        f.write("age 20\n")
    (tmp_path / "in" / "1").write_text("message 21\n")
    assert run() == sorted(f"message {i}" for i in range(22))
    assert set(json.loads((tmp_path / "done.json").read_text())) == {"segment", "position"}
