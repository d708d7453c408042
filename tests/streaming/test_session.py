import threading

import pytest
from pyspark.sql import functions as F

from visloom.streaming import frames
from visloom.streaming.commit import ExactlyOnceSink
from visloom.streaming.session import CaptureSession, Health, Status

HEAP = "session string, arrival_seq long, kind string, ts_raw long, frequency int, payload long"


def test_capture_session_with_failing_receiver(spark, tmp_path):
    rows = [("s", k, "data", 10 * (k // 2), 4 * (k % 2), k) for k in range(10)] + [("s", 10, "stop", 0, 0, 0)]
    spark.createDataFrame(rows[:6], HEAP).coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame(rows[6:], HEAP).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(HEAP).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    session, got = CaptureSession(str(tmp_path / "log")), []

    def broken(batch, epoch):
        raise OSError("unreachable")

    session.add_receiver("good", lambda batch, epoch: got.extend(batch.where(F.col("reason") == "ok").collect()))
    session.add_receiver("bad", broken)
    with pytest.raises(ValueError):
        session.add_receiver("bad", broken)
    session.start("b1", {"frames": frames.assemble(stream, 10, 1, 4, 0, 8)}, available_now=True)
    with pytest.raises(RuntimeError):
        session.start("b2", {})
    session.join()
    session.stop()
    assert session.status is Status.COMPLETE and session.health is Health.DEGRADED
    with pytest.raises(RuntimeError):
        session.stop()
    session.drop_receiver("bad")
    with pytest.raises(ValueError):
        session.drop_receiver("bad")
    assert sorted((r["idx"], r["frequency"], r["payload"]) for r in got) == [(k // 2, 4 * (k % 2), k) for k in range(10)]


def test_endpoints_wraps_and_quiet_end(spark, tmp_path):
    """All endpoints must stop; incomplete records after the first stop are not reported; timestamps wrap."""
    ts = lambda k: (1000 + 10 * k) % 1024
    rows = [("s", 0, "incomplete", ts(0), 0, 0), ("s", 1, "data", ts(1), 0, 1), ("s", 2, "data", ts(3), 0, 2), ("s", 3, "stop", 0, 0, 0), ("s", 4, "incomplete", ts(4), 0, 0)]
    rows += [("s", 5, "data", ts(3), 4, 5), ("s", 6, "stop", 0, 0, 0), ("s", 7, "data", ts(4), 0, 7), ("t", 8, "data", ts(2), 0, 8), ("t", 9, "stop", 0, 0, 0)]
    for part in (rows[:3], rows[3:]):
        spark.createDataFrame(part, HEAP).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(HEAP).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = frames.assemble(stream, 10, 4, 4, 0, 8, endpoints=2, bits=10).writeStream.format("memory").queryName("ends").option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r["session"], r["arrival_seq"], r["idx"], r["reason"]) for r in spark.table("ends").collect()}
    assert got == {("s", 0, 0, "incomplete"), ("s", 1, 1, "ok"), ("s", 2, 3, "ok"), ("s", 5, 3, "ok")}


class Receiver:
    def __init__(self, fails=False):
        self.told, self.fails = [], fails

    def begin(self, block):
        self.told.append(("begin", block))
        if self.fails:
            raise OSError("unreachable")

    def __call__(self, batch, epoch):
        self.told.append(("rows", batch.count()))

    def end(self, block):
        self.told.append(("end", block))


def test_markers_grace_and_stop_from_two_sides(spark, tmp_path):
    """What has arrived is worked off before the stop; receivers hear begin and end; of two calls one stops."""
    spark.createDataFrame([(k,) for k in range(6)], "v long").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("v long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    session, good, bad = CaptureSession(str(tmp_path / "log"), grace=30.0), Receiver(), Receiver(fails=True)
    session.add_receiver("good", good)
    session.add_receiver("bad", bad)
    session.start("b1", {"rows": stream})
    told = []
    both = threading.Barrier(2)

    def stop():
        both.wait()
        told.append(session.stop())

    threads = [threading.Thread(target=stop) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(told) == [False, True]
    assert session.status is Status.COMPLETE and session.health is Health.DEGRADED
    assert good.told[0] == ("begin", "b1") and good.told[-1] == ("end", "b1")
    assert sum(n for kind, n in good.told[1:-1]) == 6
    session.start("b2", {})
    assert session.stop() is True


def test_sink_tells_begin_and_end(spark, tmp_path):
    sink = ExactlyOnceSink(f"file://{tmp_path}/p", "q")
    sink.begin("b")
    assert not sink.ended("b")
    sink.end("b")
    assert sink.ended("b")
