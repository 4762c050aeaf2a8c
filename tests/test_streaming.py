import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import series
from tidecast.streaming import filling, messages

EVENTS = "key string, ts timestamp, n int"


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def event(key, ts, n):
    return {"key": key, "ts": ts, "n": n}


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_bad_messages_are_kept_apart(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "1.json", [{"text": t} for t in ('{"price": 5, "ticker": "X"}', "{broken", '{"price": "high"}', "[1]")] + [{"other": 1}])
    stream = messages.file_stream(spark, str(source), "text string", "json")
    parsed = messages.parse_messages(stream, "text", "price INT, ticker STRING")
    run(messages.store_messages(parsed, str(tmp_path / "out"), str(tmp_path / "state")))
    out = spark.read.parquet(str(tmp_path / "out"))
    good = out.where(~F.col("is_bad").cast("boolean")).collect()
    assert [(r["body"]["price"], r["body"]["ticker"]) for r in good] == [(5, "X")]
    assert out.where(F.col("is_bad").cast("boolean")).count() == 4


def test_latest_per_key_over_restarts(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def once():
        stream = messages.file_stream(spark, str(source), EVENTS, "json", files="*.json")
        run(messages.store_latest(messages.latest_changes(stream, ["key"], ["ts"], ["n"]), out, state))
        return {r["key"]: r["n"] for r in messages.read_latest(spark, out, ["key"], ["ts"]).collect()}

    write(source, "1.json", [event("a", "2024-01-01T10:00:00Z", 1), event("b", "2024-01-01T10:00:00Z", 2)])
    assert once() == {"a": 1, "b": 2}
    # A late message does not replace a newer one.
    write(source, "2.json", [event("a", "2024-01-01T09:00:00Z", 3), event("b", "2024-01-01T11:00:00Z", 4)])
    assert once() == {"a": 1, "b": 4}
    write(source, "3.json", [event("c", "2024-01-01T09:00:00Z", 5)])
    assert once() == {"a": 1, "b": 4, "c": 5}


def test_daily_counts_come_out_when_the_day_is_closed(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def once():
        stream = messages.file_stream(spark, str(source), EVENTS, "json", files="*.json")
        run(messages.store_closed_days(messages.daily_counts(stream, F.col("ts"), ["key"], "2 hours", F.col("n").cast("double")), out, state))
        return {(r["key"], r["date"]): (r["n"], r["y"]) for r in spark.read.parquet(out).collect()}

    write(source, "1.json", [event("a", "2024-01-01T10:00:00Z", 1), event("a", "2024-01-01T23:00:00Z", 2), event("a", "2024-01-02T01:00:00Z", 4)])
    assert once() == {}  # the watermark is still on the first day
    # Late but within the delay: counted.
    write(source, "2.json", [event("a", "2024-01-01T23:59:00Z", 8), event("b", "2024-01-02T03:00:00Z", 16)])
    assert once() == {("a", dt.date(2024, 1, 1)): (3, 11.0)}
    # Too late for the first day: dropped; closes the second.
    write(source, "3.json", [event("a", "2024-01-01T12:00:00Z", 32), event("b", "2024-01-03T03:00:00Z", 64)])
    assert once() == {("a", dt.date(2024, 1, 1)): (3, 11.0), ("a", dt.date(2024, 1, 2)): (1, 4.0), ("b", dt.date(2024, 1, 2)): (1, 16.0)}


@pytest.mark.parametrize("text, bad", [('{"k": 1}', False), ("{}", False), ("", True), (None, True), ("7", True), ('{"k": 1', True)])
def test_parse_messages_on_a_table(frame, text, bad):
    row = messages.parse_messages(frame("t string", [(text,)]), "t", "k INT").first()
    assert row["is_bad"] is bad and row["message"] == text


def test_latest_survives_a_lost_checkpoint_and_compaction(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")

    def once(state):
        stream = messages.file_stream(spark, str(source), EVENTS, "json", files="*.json", per_trigger=1)
        run(messages.store_latest(messages.latest_changes(stream, ["key"], ["ts"], ["n"]), out, str(tmp_path / state)))

    def current():
        return {r["key"]: r["n"] for r in messages.read_latest(spark, out, ["key"], ["ts"]).collect()}

    for k in range(3):
        write(source, f"{k}.json", [event("a", f"2024-01-0{1 + k}T10:00:00Z", k), event(f"k{k}", "2024-01-01T10:00:00Z", k)])
        once("state")
    write(source, "3.json", [event("a", "2024-01-09T10:00:00Z", 9)])
    once("new-state")  # batch numbers start at 0 again
    want = {"a": 9, "k0": 0, "k1": 1, "k2": 2}
    assert current() == want
    messages.compact_latest(spark, out, ["key"], ["ts"])
    assert current() == want and len(list((tmp_path / "out").glob("batch=*"))) == 1
    write(source, "4.json", [event("k1", "2024-01-02T10:00:00Z", 5)])
    once("new-state")
    messages.compact_latest(spark, out, ["key"], ["ts"])
    assert current() == want | {"k1": 5} and len(list((tmp_path / "out").glob("batch=*"))) == 1


def test_day_parts_lose_nothing_and_list_late_rows(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")

    def once():
        stream = messages.file_stream(spark, str(source), EVENTS, "json", files="*.json")
        run(messages.store_day_parts(stream, F.col("ts"), ["key"], out, f"{out}/state", "2 hours", F.col("n").cast("double")))
        return {(r["key"], r["date"].day): (r["n"], r["y"], r["is_open"]) for r in messages.read_days(spark, out, ["key"], "2 hours").collect()}

    write(source, "1.json", [event("a", "2024-01-01T10:00:00Z", 1), event("a", "2024-01-02T01:00:00Z", 2)])
    assert once() == {("a", 1): (1, 1.0, True), ("a", 2): (1, 2.0, True)}
    write(source, "2.json", [event("a", "2024-01-01T23:00:00Z", 4), event("b", "2024-01-02T03:00:00Z", 8)])
    assert once() == {("a", 1): (2, 5.0, False), ("a", 2): (1, 2.0, True), ("b", 2): (1, 8.0, True)}
    write(source, "3.json", [event("a", "2024-01-01T12:00:00Z", 16)])
    assert once()["a", 1] == (3, 21.0, False)
    assert [(r["key"], r["value"]) for r in messages.read_late(spark, out, ["key"]).collect()] == [("a", 16.0)]


def test_repeated_messages_are_left_out(spark, tmp_path):
    """Also over a restart and across batches; a message without time or key is kept each time."""
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def once():
        stream = messages.file_stream(spark, str(source), EVENTS, "json", files="*.json")
        own = messages.once(stream, ["key", "n"], "ts", "2 hours")
        run(own.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start())
        return sorted((r["key"] or "", r["n"]) for r in spark.read.parquet(out).collect())

    with messages.state_in_rocksdb(spark):
        write(source, "1.json", [event("a", "2024-01-01T10:00:00Z", 1), event("a", "2024-01-01T10:00:00Z", 1), event("b", "2024-01-01T10:00:00Z", 2)])
        assert once() == [("a", 1), ("b", 2)]
        write(source, "2.json", [event("a", "2024-01-01T10:00:00Z", 1), event("a", "2024-01-01T11:00:00Z", 3), event(None, "2024-01-01T11:00:00Z", 4)])
        assert once() == [("", 4), ("a", 1), ("a", 3), ("b", 2)]
        write(source, "3.json", [event("b", "2024-01-01T10:00:00Z", 2), event(None, "2024-01-01T11:00:00Z", 4)])
        assert once() == [("", 4), ("", 4), ("a", 1), ("a", 3), ("b", 2)]
    assert "RocksDB" not in str(spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""))


PARTS = "series_id string, date date, y double"


def day_of(k):
    return (dt.date(2024, 1, 1) + dt.timedelta(days=k)).isoformat()


@pytest.mark.parametrize("open_days", [0, 5, 1000])
def test_fill_by_batches_equals_one_fill(spark, frame, tmp_path, open_days):
    """Random batches over shared and own days, late ones too, against a fill of everything so far."""
    rng = np.random.default_rng(open_days)
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    seen = []
    for k in range(3):
        batch = [(f"s{rng.integers(3)}", day_of(int(rng.integers(20 * k, 20 * k + 60))), float(rng.integers(1, 100))) for _ in range(25)]
        if k == 2:
            batch += [("new", day_of(3), 5.0), (None, day_of(4), 1.0), (None, day_of(9), 2.0), ("s0", None, 7.0), ("s0", day_of(5), None)]
        frame(PARTS, batch).write.mode("append").parquet(str(source))
        seen += [r for r in batch if r[1] and r[2] is not None]
        run(filling.store_filled(filling.filled_changes(messages.file_stream(spark, str(source), PARTS), open_days=open_days), out, state))
        got = sorted(tuple(r) for r in filling.read_filled(spark, out).collect() if r["series_id"])
        want = sorted(tuple(r) for r in series.fill_gaps(frame(PARTS, [r for r in seen if r[0]]), on_duplicate="sum").collect())
        assert [r[:2] + r[3:] for r in got] == [r[:2] + r[3:] for r in want]
        assert [r[2] for r in got] == pytest.approx([r[2] for r in want])
    lost = sorted((r["date"].day, r["y"], r["is_filled"]) for r in filling.read_filled(spark, out).where("series_id is null").collect())
    assert [x[0] for x in lost] == [5, 6, 7, 8, 9, 10] and lost[0][1:] == (1.0, False) and lost[3][1] == pytest.approx(1.6)


def test_a_batch_gives_its_own_days_only(spark, frame, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def batch(rows):
        frame(PARTS, rows).write.mode("append").parquet(str(source))
        run(filling.store_filled(filling.filled_changes(messages.file_stream(spark, str(source), PARTS), open_days=50), out, state))
        log = spark.read.parquet(out)
        newest = log.agg(F.max("batch")).first()[0]
        return sorted((r["date"].isoformat(), r["y"], r["is_filled"], r["is_late"]) for r in log.where(F.col("batch") == newest).collect())

    assert len(batch([("a", day_of(k), 1.0) for k in range(40)])) == 40
    assert batch([("a", day_of(42), 4.0)]) == [(day_of(40), 2.0, True, False), (day_of(41), 3.0, True, False), (day_of(42), 4.0, False, False)]
    assert batch([("a", day_of(41), 9.0)]) == [(day_of(40), 5.0, True, False), (day_of(41), 9.0, False, False)]  # opened again
    assert batch([("a", day_of(7), 1.0)]) == [(day_of(7), 2.0, False, False)]
    assert len(batch([("a", day_of(100), 1.0)])) == 58
    assert batch([("a", day_of(7), 1.0)]) == [(day_of(7), 1.0, False, True)]  # long closed


def test_a_gap_too_long_stops_the_stream(spark, frame, tmp_path):
    frame(PARTS, [("a", "1900-01-01", 1.0), ("a", "2024-01-01", 1.0)]).write.parquet(str(tmp_path / "in"))
    changes = filling.filled_changes(messages.file_stream(spark, str(tmp_path / "in"), PARTS))
    with pytest.raises(Exception, match="gap of more than 3660 days after 1900-01-01"):
        filling.store_filled(changes, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
