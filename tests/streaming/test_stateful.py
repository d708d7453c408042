"""Stateful streams over several triggers against their batch forms; the endpoint source; writes that happen once."""

import random
import threading
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from visloom.operators import average
from visloom.operators import frames as batch
from visloom.sources import endpoints
from visloom.streaming import cadence, commit, frames, history

HEAP = "session string, arrival_seq long, kind string, ts_raw long, frequency int, payload long"


def feed(spark, rows, schema, folder, pieces):
    """Rows as so many files, one a trigger. Files are ordered by time of writing."""
    size = -(-len(rows) // pieces)
    for k in range(pieces):
        spark.createDataFrame(rows[k * size : (k + 1) * size], schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain(stream, tmp_path, name):
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-log")).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name)).collect()


def test_frames_over_triggers_equal_batch(spark, tmp_path):
    """However the records are cut into triggers, each session's frames are those of the batch operator."""
    rng, rows, now = random.Random(1), [], {"a": 50, "b": 900}
    for seq in range(600):
        session = rng.choice("ab")
        now[session] += rng.choice([0, 0, 0, 5, 10, 40])
        kind = rng.choices(["data", "incomplete", "metadata", "no-descriptor", "bad-heap", "bad-item"], [20, 1, 1, 1, 1, 1])[0]
        ts = (now[session] // 10 * 10 - rng.choice([0, 0, 0, 10, 30, 70]) + rng.choice([0] * 9 + [3])) % 1024
        rows.append((session, seq, kind, ts, rng.choice([0, 4, 8, 3, 12]), seq))
    ended = [*rows, ("a", 600, "stop", 0, 0, 0), ("b", 601, "stop", 0, 0, 0), ("a", 602, "data", 0, 0, 0)]
    got = drain(frames.assemble(feed(spark, ended, HEAP, tmp_path / "in", 7), 10, 3, 4, 0, 12, bits=10), tmp_path, "out")
    expected = Counter()
    for session in "ab":
        classed = batch.classify(spark.createDataFrame([r for r in rows if r[0] == session], HEAP), 10, 3, 4, 0, 12, bits=10).cache()
        expected.update((session, r["idx"], r["frequency"], r["payload"], "ok") for r in batch.items(classed).collect())
        expected.update((session, None if r["idx"] is None else r["idx"], r["frequency"], None, r["reason"]) for r in classed.where("reason <> 'ok'").collect())
    assert Counter((r["session"], r["idx"], r["frequency"], r["payload"], r["reason"]) for r in got) == expected
    assert len({r["reason"] for r in got}) == 8


SAMPLE = "bl int, dump long, channel int, re int, im int, flags int"


@pytest.mark.parametrize("pieces", [1, 5])
def test_count_windows_skip_and_flush(spark, tmp_path, pieces):
    rng, rows = random.Random(2), []
    for dump in [0, 1, 2, 3, 4, 9, 10, 41, 42, 43, 47, 48]:
        rows += [(b, dump, c, rng.randint(-9, 9), rng.randint(-9, 9), rng.choice([0, 0, 2, 16])) for b in range(2) for c in range(3) if not (b and dump == 43)]
    stream = feed(spark, [*rows, *[(b, None, None, None, None, None) for b in range(2)]], SAMPLE, tmp_path / "in", pieces)
    got = drain(cadence.count_windows(stream, ["bl"], 4), tmp_path, "out")
    direct = average.partials(spark.createDataFrame(rows, SAMPLE), ["bl", average.group_index("dump", 4).alias("out_idx"), "channel"]).collect()
    columns = ["bl", "out_idx", "channel", *average.SUMS, "any_flags"]
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(tuple(r[c] for c in columns) for r in direct)
    # Groups 3 to 9 have no dump; the last one, partial, came out with the end of the stream.
    assert {r["out_idx"] for r in got} == {0, 1, 2, 10, 11, 12} and not any(r["late"] for r in got)


def test_count_windows_tell_late_samples(spark, tmp_path):
    rows = [(0, 0, 0, 1, 1, 0), (0, 4, 0, 2, 2, 0), (0, 1, 0, 9, 9, 0), (0, 5, 0, 3, 3, 0), (0, 8, 0, 4, 4, 0)]
    got = drain(cadence.count_windows(feed(spark, rows, SAMPLE, tmp_path / "in", 5), ["bl"], 4), tmp_path, "out")
    assert sorted((r["out_idx"], r["n_u"], r["re_u"], r["late"]) for r in got) == [(0, 1, 1, 0), (1, 2, 5, 1)]


EVENT = "seq long, sensor long, ts timestamp, value double, at timestamp"


def lookup(spark, rows, tmp_path, pieces):
    from datetime import datetime, timedelta, timezone

    when = lambda s: None if s is None else datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=s)
    stream = feed(spark, [(k, s, when(ts), v, when(at)) for k, (s, ts, v, at) in enumerate(rows)], EVENT, tmp_path / "in", pieces)
    questions = stream.where("at IS NOT NULL").select("sensor", "seq", "ts", "at", F.col("seq").alias("id"))
    out = history.as_of(stream.where("value IS NOT NULL").select("sensor", "seq", "ts", "value"), questions, -1.0)
    return {r["id"]: r["value"] for r in drain(out, tmp_path, "out")}


def test_as_of_over_triggers(spark, tmp_path):
    rng, rows = random.Random(3), []
    for ts in range(0, 600, 2):
        sensor = rng.randrange(3)
        rows.append((sensor, ts, float(ts), None) if rng.random() < 0.6 else (sensor, ts, None, ts + 20))
    got = lookup(spark, rows, tmp_path, 6)
    edge = max(ts for _, ts, _, _ in rows)
    asked = {k: (s, at) for k, (s, _, _, at) in enumerate(rows) if at is not None and at < edge}
    assert got == {k: max((v for t, ts, v, _ in rows if t == s and v is not None and ts <= at), default=-1.0) for k, (s, at) in asked.items()}


def test_questions_that_go_back_fail(spark, tmp_path):
    with pytest.raises(StreamingQueryException, match="go back in time"):
        lookup(spark, [(0, 1, 1.0, None), (0, 2, None, 10), (0, 3, None, 9)], tmp_path, 3)


def test_endpoints_that_are_not_wanted_are_not_opened(spark, tmp_path):
    rows = [(k, "data", k, (k * 3) % 32 if k % 11 else None, k) for k in range(400)]
    folder = f"file://{tmp_path}/capture"
    endpoints.record(spark.createDataFrame(rows, "arrival_seq long, kind string, ts_raw long, frequency int, payload long"), folder, 8)
    key = lambda df: sorted(tuple(r)[:5] for r in df.collect())
    everything = endpoints.read(spark, folder, 8)
    assert everything.rdd.getNumPartitions() == 5 and [r[0] for r in key(everything)] == list(range(400))
    # Files of all but endpoints 1 and 2 are destroyed: who opens them fails.
    for file in tmp_path.glob("capture/_folder=*/*.parquet"):
        if file.parent.name not in ("_folder=1", "_folder=2"):
            file.write_bytes(b"not a file")
    with pytest.raises(Exception):
        everything.collect()
    for condition, n in (("frequency >= 8 AND frequency < 24", 2), ("frequency > 9 AND frequency <= 12", 1), ("frequency IN (9, 22)", 2), ("frequency = 23", 1), ("endpoint = 2", 1), ("endpoint > 0 AND endpoint <= 2", 2), ("frequency < 16 AND endpoint >= 1", 1), ("frequency = 9 AND frequency = 17", 0)):
        found = endpoints.read(spark, folder, 8).where(condition)
        assert found.rdd.getNumPartitions() == n, condition
        plain = spark.createDataFrame([(*r, r[3] // 8 if r[3] is not None else -1) for r in rows], endpoints.SCHEMA).where(condition)
        assert key(found) == key(plain), condition


def test_endpoints_as_a_stream(spark, tmp_path):
    folder = f"file://{tmp_path}/capture"
    schema = "arrival_seq long, kind string, ts_raw long, frequency int, payload long"
    seen = []
    for part in range(3):
        endpoints.record(spark.createDataFrame([(10 * part + k, "data", k, 4 * k, k) for k in range(6)], schema), folder, 8)
        query = endpoints.read_stream(spark, folder, 8).writeStream.foreachBatch(lambda b, _: seen.extend(r["arrival_seq"] for r in b.collect())).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert sorted(seen) == [10 * p + k for p in range(part + 1) for k in range(6)]


def test_sessions_race_for_one_base(spark, tmp_path):
    """All read what one of them wrote; whoever comes later does too."""
    path, got, start = f"{tmp_path}/b/first", [], threading.Barrier(8)

    def race(k):
        start.wait()
        got.append(commit.first_writer(spark, path, k))

    threads = [threading.Thread(target=race, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(got) == 8 and len(set(got)) == 1
    assert commit.first_writer(spark, path, 99) == got[0]
    heaps = lambda rows: spark.createDataFrame([("s", k, *r) for k, r in enumerate(rows)], HEAP)
    folder = f"file://{tmp_path}/shared"
    none, early, late = heaps([("metadata", 5, 0, 0)]), heaps([("data", 100, 0, 1)]), heaps([("data", 90, 0, 1), ("data", 120, 0, 2)])
    assert [commit.shared_base(spark, folder, "one", h) for h in (none, early, late, none)] == [None, 100, 100, 100]
    assert commit.shared_base(spark, folder, "two", late) == 90
    classed = batch.classify(late, 10, 3, 4, 0, 8, base=100).orderBy("arrival_seq").collect()
    assert [(r["idx"], r["reason"]) for r in classed] == [(-1, "too-old"), (2, "ok")]


def test_interrupted_batches_leave_no_row_twice(spark, tmp_path):
    """A batch dies half way, once within the retries and once beyond them; the query runs again from its log."""
    schema = "substream int, value long"
    stream = feed(spark, [(k % 2, k) for k in range(40)], schema, tmp_path / "in", 4)
    failures = {1: 1, 2: 3}

    def write(batch_rows, folder):
        epoch = int(folder.rsplit("=", 1)[1])
        if failures.get(epoch):
            failures[epoch] -= 1
            batch_rows.limit(3).write.mode("overwrite").partitionBy("substream").parquet(folder)
            raise OSError("the receiver went away")
        batch_rows.write.mode("overwrite").partitionBy("substream").parquet(folder)

    def run():
        sink = commit.ExactlyOnceSink(f"file://{tmp_path}/product", "spectral", attempts=2, wait=0.01, write=write)
        query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        query.awaitTermination()
        return sink

    with pytest.raises(StreamingQueryException):
        run()
    reader = commit.ExactlyOnceSink(f"file://{tmp_path}/product", "spectral")
    assert reader.committed(spark) == [0, 1]  # what epoch 2 left is not seen
    assert reader.read(spark, schema).count() == 20
    sink = run()
    assert sink.committed(spark) == [0, 1, 2, 3]
    assert sorted((r["substream"], r["value"]) for r in sink.read(spark, schema).collect()) == sorted((k % 2, k) for k in range(40))
    sink(spark.createDataFrame([(0, 777)], schema), 3)  # a committed epoch is not written again
    assert sink.read(spark, schema).where("value = 777").count() == 0


def test_rows_of_a_session_are_held_compactly():
    n = 20_000
    part = lambda k: pd.DataFrame({"session": ["s" * 40] * n, "arrival_seq": range(k * n, k * n + n), "kind": [("data", "incomplete")[i % 2] for i in range(n)], "ts_raw": [7] * n, "frequency": np.zeros(n, np.int32), "payload": [1] * n})
    held = frames.compact(iter([part(1), part(0)]))
    assert held["arrival_seq"].tolist() == list(range(2 * n)) and set(held["kind"]) == {"data", "incomplete"}
    assert held.memory_usage(deep=True).sum() < 40 * len(held)


def test_sensors_share_states(spark, tmp_path, monkeypatch):
    """Many sensors with a row each make no more states than there are buckets."""
    monkeypatch.setattr(history, "BUCKETS", 3)
    rows = [(s if s else None, s, s + 60) for s in range(300)]
    spark.createDataFrame(rows, "sensor long, seq long, at long").coalesce(1).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema("sensor long, seq long, at long").parquet(str(tmp_path / "in")).withColumn("ts", F.timestamp_seconds("at"))
    out = history.as_of(read().select("sensor", "seq", "ts", F.lit(0.5).alias("value")), read().select("sensor", "seq", "ts", F.timestamp_seconds("at").alias("at"), F.col("seq").alias("id")))
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) < 30
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect()
    assert {(r["sensor"], r["id"], r["value"]) for r in got} == {(s if s else None, s, 0.5) for s in range(299)}
