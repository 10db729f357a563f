"""Appends that happen once, whatever is lost in between."""

import json
import pathlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caseledger.sources import ledger
from caseledger.sources.tables import describe, fresh, partition_columns
from caseledger.streaming import sinks
from tests.conftest import rows


def batch(spark, *values):
    return spark.createDataFrame([(v, d) for v, d in values], "v int, day date").repartition(4)


def days(*values):
    return [(v, None if d is None else datetime(2024, 1, d).date()) for v, d in values]


FIRST = days((1, 1), (2, 1), (3, 2), (4, None), (5, 2), (6, 1))


def test_a_batch_is_appended_once(spark, name):
    t = name("log")
    for stream, number, added in (("a", 0, True), ("a", 0, False), ("a", 1, True), ("b", 0, True), ("a", 1, False)):
        assert ledger.append_once(batch(spark, *FIRST), t, stream, number, "day") is added
    assert fresh(spark, t).count() == 3 * len(FIRST) and partition_columns(spark, t) == ["day"]
    assert fresh(spark, t).where("day = DATE'2024-01-02'").count() == 6 and fresh(spark, t).where("day IS NULL").count() == 3


def test_without_partitions_and_empty(spark, name):
    t = name("log")
    one = spark.createDataFrame([(1, "x")], "v int, s string")
    assert ledger.append_once(one.where("false"), t, "a", 0) and not ledger.append_once(one, t, "a", 0)
    ledger.append_once(one, t, "a", 1)
    # Another order of columns and a new one.
    ledger.append_once(one.selectExpr("s", "v", "2L AS more"), t, "a", 2)
    assert rows(fresh(spark, t), "v", "s", "more") == [(1, "x", None), (1, "x", 2)]


class Stopped(RuntimeError):
    pass


@pytest.mark.parametrize("stop_at", [0, 1, 2])
def test_a_crash_between_moves(spark, name, monkeypatch, stop_at):
    t = name("log")
    ledger.append_once(batch(spark, *FIRST[:1]), t, "a", 0, "day")
    moved, move = [], ledger._Folder.move

    def stopping(self, source, target):
        if len(moved) == stop_at:
            raise Stopped
        moved.append(target)
        move(self, source, target)
    monkeypatch.setattr(ledger._Folder, "move", stopping)
    with pytest.raises(Stopped):
        ledger.append_once(batch(spark, *FIRST), t, "a", 1, "day")
    monkeypatch.setattr(ledger._Folder, "move", move)
    # The repeated batch may come with other values (a clock, say): the rows of the first try count.
    assert ledger.append_once(batch(spark, *FIRST).withColumn("v", F.col("v") + 100), t, "a", 1, "day")
    assert sorted(r["v"] for r in fresh(spark, t).collect()) == sorted([1] + [v for v, _ in FIRST])


def test_a_crash_before_the_rows_are_complete_and_before_the_end(spark, name, monkeypatch):
    t = name("log")
    ledger.append_once(batch(spark, *FIRST[:1]), t, "a", 0, "day")
    write = ledger._write_rows

    def half(rows_, keys, path):
        write(rows_, keys, path)
        (pathlib.Path(path.removeprefix("file:")) / "_SUCCESS").unlink()
        raise Stopped
    monkeypatch.setattr(ledger, "_write_rows", half)
    with pytest.raises(Stopped):
        ledger.append_once(batch(spark, *FIRST), t, "a", 1, "day")
    monkeypatch.setattr(ledger, "_write_rows", write)
    monkeypatch.setattr(ledger._Folder, "touch", lambda self, path: (_ for _ in ()).throw(Stopped()))
    with pytest.raises(Stopped):
        ledger.append_once(batch(spark, *FIRST), t, "a", 1, "day")
    monkeypatch.undo()
    assert ledger.append_once(batch(spark, *FIRST), t, "a", 1, "day")
    assert fresh(spark, t).count() == 1 + len(FIRST)
    entry = pathlib.Path(describe(spark, t)["Location"].removeprefix("file:")) / "_ledger" / "a" / "1"
    assert sorted(p.name for p in entry.iterdir() if not p.name.startswith(".")) == ["done"]


def test_a_stream_whose_last_commit_was_lost(spark, folder, name):
    t, source = name("bronze"), pathlib.Path(folder) / "in"
    source.mkdir()
    for n in range(3):
        (source / f"{n}.json").write_text("\n".join(json.dumps({"v": 10 * n + k, "at": f"2024-01-0{n + 1}T10:00:00"}) for k in range(4)))

    def run():
        stream = spark.readStream.schema("v int, at timestamp").option("maxFilesPerTrigger", 1).json(str(source))
        sinks.stream_append(stream, t, f"{folder}/ck", None, ts="at", day="day").awaitTermination()
    run()
    commits = pathlib.Path(folder) / "ck" / "commits"
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (commits / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert sorted(r["v"] for r in fresh(spark, t).collect()) == [10 * n + k for n in range(3) for k in range(4)]
    # A new checkpoint is a new stream: its batches are its own.
    stream = spark.readStream.schema("v int, at timestamp").json(str(source))
    sinks.stream_append(stream, t, f"{folder}/other", None, ts="at", day="day").awaitTermination()
    assert fresh(spark, t).count() == 24


def test_a_processing_time_trigger_takes_what_arrives(spark, folder, name):
    t, source = name("bronze"), pathlib.Path(folder) / "in"
    source.mkdir()
    (source / "0.json").write_text(json.dumps({"v": 1, "at": "2024-01-01T10:00:00"}))
    stream = spark.readStream.schema("v int, at timestamp").json(str(source))
    query = sinks.stream_append(stream, t, f"{folder}/ck", "200 milliseconds", ts="at", day="day")
    try:
        query.processAllAvailable()
        (source / "1.json").write_text(json.dumps({"v": 2, "at": "2024-01-02T10:00:00"}))
        query.processAllAvailable()
        assert query.isActive
        assert rows(fresh(spark, t), "v") == [(1,), (2,)]
    finally:
        query.stop()
