"""Backward as-of lookups on a stream: samples and questions of a sensor meet in one state.

A question at a time can be answered when the watermark has passed that time, as no sample up to it can follow. Until then it waits;
a timer wakes the state at its earliest question. Questions of a sensor must not go back in time: answers prune the
history to the last sample that they can need, so a question about what is pruned raises instead of being answered wrongly. Of
samples, only those strictly newer than all before are kept.

Sensors are many and have few rows each, so a state is that of a bucket of sensors: its rows are handled by columns and are kept as
Arrow tables. A bucket grows with the rows that are held, one in ``BUCKETS`` of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import use_rocksdb

OUTPUT = "sensor long, id long, at long, value double"
BUCKETS = 256
#: A sensor without a name is one of its own.
SENSOR = ["unnamed", "sensor"]


def _pack(df: pd.DataFrame) -> tuple[bytes]:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(df, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpack(parts: Iterator[tuple]) -> pd.DataFrame | None:
    tables = [pa.ipc.open_stream(p[0]).read_pandas() for p in parts]
    return pd.concat(tables, ignore_index=True) if tables else None


class History(StatefulProcessor):
    def __init__(self, default: float | None):
        self.default = default

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", "rows binary")
        self.waiting = handle.getListState("waiting", "rows binary")
        self.newest = handle.getValueState("newest", "rows binary")
        self.asked = handle.getValueState("asked", "rows binary")

    @staticmethod
    def _seen(state, rows: pd.DataFrame, column: str) -> pd.Series:
        """For each row, the greatest of ``column`` that came before it from its sensor, null for none; the state gets the greatest of each sensor."""
        old = _unpack([state.get()]) if state.exists() else rows.head(0)
        both = pd.concat([old[[*SENSOR, column]], rows[[*SENSOR, column]]], ignore_index=True)
        by = both.groupby(SENSOR, sort=False)[column]
        top = both.assign(top=by.cummax())
        state.update(_pack(by.max().reset_index()))
        return top.groupby(SENSOR, sort=False)["top"].shift().astype("Int64").iloc[len(old) :]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat([part.drop(columns=["bucket", "came"]) for part in rows]).sort_values("seq", kind="stable")
        new = df[df["question"] == 0]
        if len(new):
            before = self._seen(self.newest, new, "ts")
            kept = new[(before.isna() | (before < new["ts"].to_numpy())).to_numpy(bool)]
            if len(kept):
                self.samples.appendValue(_pack(kept[[*SENSOR, "ts", "value"]].astype({"value": float})))
        asked = df[df["question"] == 1]
        if len(asked):
            before = self._seen(self.asked, asked, "at")
            back = (before > asked["at"].to_numpy()).fillna(False).to_numpy(bool)
            if back.any():
                raise ValueError(f"questions of sensor {asked['sensor'].to_numpy()[back][0]} go back in time")
            self.handle.registerTimer(self._wake(int(asked["at"].min())))
            self.waiting.appendValue(_pack(asked[[*SENSOR, "at", "id"]]))
        return iter([])

    @staticmethod
    def _wake(at: int) -> int:
        """The first whole millisecond after a time in microseconds."""
        return at // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = _unpack(self.waiting.get())
        if waiting is None:
            return
        due, left = waiting[waiting["at"] < passed], waiting[waiting["at"] >= passed]
        if len(due):
            held = _unpack(self.samples.get())
            if held is None:
                held = pd.DataFrame({"unnamed": [False], "sensor": [0], "ts": [0], "value": [0.0]}).head(0)
            found = pd.merge_asof(due.sort_values("at", kind="stable"), held.sort_values("ts", kind="stable"), left_on="at", right_on="ts", by=SENSOR)
            # What comes before the last sample that was used cannot be asked for again.
            if len(held):
                used = found.groupby(SENSOR, sort=False)["ts"].max().rename("used").reset_index()
                first = held[SENSOR].merge(used, on=SENSOR, how="left")["used"].to_numpy(float)
                if (past := held["ts"].to_numpy() < first).any():
                    self.samples.put([_pack(held[~past])])
            if len(left):
                self.waiting.put([_pack(left)])
            else:
                self.waiting.clear()
            value = found["value"].where(found["ts"].notna(), np.nan if self.default is None else self.default)
            yield pd.DataFrame({"sensor": found["sensor"].astype("Int64").mask(found["unnamed"]), "id": found["id"], "at": found["at"], "value": pd.array(value, "Float64")})
        if len(left):
            self.handle.registerTimer(self._wake(int(left["at"].min())))

    def close(self) -> None:
        pass


def as_of(samples: DataFrame, questions: DataFrame, default: float | None = None, delay: str = "0 seconds") -> DataFrame:
    """(sensor, id, at, value). ``samples``: sensor, seq, ts, value; ``questions``: sensor, seq, ts, at, id, where ``ts`` is when a row comes and
    ``seq`` orders rows that come together. All times are timestamps; ``at`` comes back in microseconds."""
    use_rocksdb(samples.sparkSession)
    sensor = [F.pmod(F.hash(F.col("sensor").cast("long")), F.lit(BUCKETS)).alias("bucket"), F.col("sensor").isNull().alias("unnamed"), F.coalesce(F.col("sensor").cast("long"), F.lit(0).cast("long")).alias("sensor")]
    zero = F.lit(0).cast("long")
    a = samples.select(*sensor, F.col("seq").cast("long"), F.lit(0).alias("question"), F.col("ts").alias("came"), F.unix_micros("ts").alias("ts"), F.col("value").cast("double"), zero.alias("at"), zero.alias("id"))
    b = questions.select(*sensor, F.col("seq").cast("long"), F.lit(1).alias("question"), F.col("ts").alias("came"), F.unix_micros("ts").alias("ts"), F.lit(None).cast("double").alias("value"), F.unix_micros("at").alias("at"), F.col("id").cast("long"))
    both = a.unionByName(b).withWatermark("came", delay)
    return both.groupBy("bucket").transformWithStateInPandas(History(default), OUTPUT, "Append", "EventTime")
