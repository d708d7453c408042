"""Frame assembly on a stream: one state per session, with the batch operator's rules in order of arrival.

Sessions are the unit of distribution: a capture with several servers, or several captures, are several sessions.
A task holds the rows of one session and trigger, which ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` of the source bounds.

Watermarks drop late rows without a trace and know no counts, so the window of open frames is kept as state: a typed row
with the first timestamp and the newest frame, and a map of the items of the frames that are still open. Frames leave the
window when a newer one pushes them out, or at the end of the stream. The rows of a trigger are handled by columns; only
items that outlive it touch the map. Needs the RocksDB state store, which ``session.use_rocksdb`` sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..constants import TIMESTAMP_BITS
from ..operators.frames import UNTIMED
from ..session import use_rocksdb

OUTPUT = "session string, idx long, frequency int, payload long, reason string, arrival_seq long"
HEAD = "ts0 long, top long, previous long, wraps long, stops int"
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]
NONE = -(1 << 62)


REASONS = ("ok", "incomplete", "too-old", "bad-timestamp", "bad-heap", "bad-channel")
#: Rows that are handed on at once.
TOLD = 50_000


def compact(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of a session and trigger in order of arrival, some 30 bytes each: kinds as categories, other strings left out."""
    parts, kinds = [], {}
    for df in rows:
        code = np.array([kinds.setdefault(k, len(kinds)) for k in df["kind"]], np.int16)
        parts.append(pd.DataFrame({"arrival_seq": df["arrival_seq"], "kind": code, "ts_raw": df["ts_raw"], "frequency": df["frequency"], "payload": df["payload"]}))
    out = pd.concat(parts, ignore_index=True)
    parts.clear()
    if (np.diff(out["arrival_seq"].to_numpy()) < 0).any():
        out = out.iloc[np.argsort(out["arrival_seq"].to_numpy(), kind="stable")].reset_index(drop=True)
    out["kind"] = pd.Categorical.from_codes(out["kind"].to_numpy(), list(kinds))
    return out


class Assembler(StatefulProcessor):
    def __init__(self, interval: int, active_frames: int, channels_per_item: int, start: int, stop: int, endpoints: int, bits: int):
        self.interval, self.active, self.per_item, self.start, self.stop, self.endpoints, self.bits = interval, active_frames, channels_per_item, start, stop, endpoints, bits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.head = handle.getValueState("head", HEAD)
        self.items = handle.getMapState("items", "idx long, frequency int", "arrival_seq long, payload long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ts0, top, previous, wraps, stops = self.head.get() if self.head.exists() else (None, None, None, 0, 0)
        if stops >= self.endpoints:
            return
        df = compact(rows)
        # What comes after the last endpoint's stop is not looked at.
        stopped = stops + (df["kind"] == "stop").cumsum()
        ended = bool((stopped >= self.endpoints).any())
        df = df[stopped.shift(fill_value=stops) < self.endpoints]
        stopped = stopped[df.index]
        said, stopped = df["kind"] != "stop", stopped.to_numpy()
        df, stopped = df[said], stopped[said.to_numpy()]
        kind = df["kind"].cat.add_categories([r for r in REASONS if r not in df["kind"].cat.categories])
        code = {r: k for k, r in enumerate(kind.cat.categories)}
        names, kind = kind.cat.categories, kind.cat.codes.to_numpy(np.int16)
        own_code = lambda *reasons: [code[r] for r in reasons if r in code]
        timed = ~np.isin(kind, own_code(*UNTIMED)) & df["ts_raw"].notna().to_numpy()
        quiet = (stopped > 0) & (kind == code["incomplete"])

        idx, reason = np.full(len(df), NONE), kind.copy()
        raw = df["ts_raw"].to_numpy(dtype="int64", na_value=0)[timed]
        if len(raw):
            whole, half = 1 << self.bits, 1 << (self.bits - 1)
            jump = np.diff(raw, prepend=raw[0] if previous is None else previous)
            turns = wraps + np.cumsum((jump < -half).astype(np.int64) - (jump > half))
            ts = raw + whole * turns
            ts0 = int(ts[0]) if ts0 is None else ts0
            frame, rest = np.divmod(ts - ts0, self.interval)
            aligned = np.where(rest == 0, frame, NONE)
            newest = np.maximum.accumulate(np.append(NONE if top is None else top, aligned))
            late = frame < np.maximum(0, np.where(newest[:-1] == NONE, 0, newest[:-1]) - (self.active - 1))
            frequency = df["frequency"].to_numpy(float, na_value=np.nan)[timed]
            unwanted = ~((frequency % self.per_item == 0) & (frequency >= self.start) & (frequency < self.stop))
            own = kind[timed]
            reason[timed] = np.select([own == code["incomplete"], late, rest != 0, np.isin(own, own_code("bad-item")), unwanted], own_code("incomplete", "too-old", "bad-timestamp", "bad-heap", "bad-channel"), code["ok"])
            idx[timed] = frame
            previous, wraps = int(raw[-1]), int(turns[-1])
            # The frame numbers of late records lie below the newest, so they move nothing.
            top = None if newest[-1] == NONE else int(newest[-1])
        stops = int(stops + (len(said) - said.sum()))
        self.head.update((ts0, top, previous, wraps, stops))

        ok = reason == code["ok"]
        at = np.flatnonzero(ok)
        last = ~pd.DataFrame({"idx": idx[at], "frequency": df["frequency"].to_numpy(float, na_value=np.nan)[at]}).duplicated(keep="last").to_numpy()

        def told(places: np.ndarray) -> pd.DataFrame:
            own = df.iloc[places]
            out = pd.DataFrame({"session": key[0], "idx": pd.array(idx[places], "Int64"), "frequency": own["frequency"].astype("Int32").to_numpy(), "payload": own["payload"].astype("Int64").to_numpy(), "reason": names[reason[places]].astype(object), "arrival_seq": own["arrival_seq"].to_numpy()})
            out["idx"] = out["idx"].mask(out["idx"] == NONE)
            out.loc[out["reason"] != "ok", "payload"] = pd.NA
            return out[COLUMNS]

        below = None if ended or top is None else top - self.active + 1
        fresh, rejected = at[last], np.flatnonzero(~ok & ~quiet)
        gone = np.full(len(fresh), True) if ended else idx[fresh] < (NONE if below is None else below)
        for part in (rejected, fresh[gone]):
            for k in range(0, len(part), TOLD):
                yield told(part[k : k + TOLD])
        yield self._close(key[0], pd.MultiIndex.from_arrays([idx[fresh], df["frequency"].iloc[fresh]]), told(fresh[~gone]), below, ended)

    def _close(self, session: str, newer: pd.MultiIndex, stays: pd.DataFrame, below: int | None, ended: bool) -> pd.DataFrame:
        """Items of earlier triggers in frames that leave the window, unless this trigger has ``newer`` ones; what ``stays`` of this trigger is kept."""
        leaves = lambda i: ended or (below is not None and i < below)
        held = list(self.items.iterator())
        again = pd.MultiIndex.from_tuples([(k[0], k[1]) for k, _ in held]).isin(newer) if held and len(newer) else np.full(len(held), False)
        for (k, _), known in zip(held, again):
            if known or leaves(k[0]):
                self.items.removeKey(k)
        old = [(session, k[0], k[1], v[1], "ok", v[0]) for (k, v), known in zip(held, again) if not known and leaves(k[0])]
        for r in stays.to_dict("records"):
            self.items.updateValue((int(r["idx"]), int(r["frequency"])), (int(r["arrival_seq"]), int(r["payload"])))
        return pd.DataFrame(old, columns=COLUMNS).astype({"idx": "Int64", "frequency": "Int32", "payload": "Int64", "arrival_seq": "int64"})

    def close(self) -> None:
        pass


def assemble(heaps: DataFrame, interval: int, active_frames: int, channels_per_item: int, start: int, stop: int, endpoints: int = 1, bits: int = TIMESTAMP_BITS) -> DataFrame:
    """Rows of two kinds: a rejected record with its ``reason``, or an item (reason 'ok') of a frame that left the window.

    ``heaps``: session, arrival_seq, kind, ts_raw, frequency, payload. Each of a session's ``endpoints`` sends a record of
    kind 'stop'; the last one flushes the frames that are open, and what comes later is not looked at. Incomplete records
    after the first stop are expected, and not reported. Timestamps of ``bits`` bits are unwrapped.
    """
    use_rocksdb(heaps.sparkSession)
    made = Assembler(interval, active_frames, channels_per_item, start, stop, endpoints, bits)
    return heaps.groupBy("session").transformWithStateInPandas(made, OUTPUT, "Append", "None")


def averages(samples: DataFrame, seconds_per_dump: float, ratio: int, delay: str = "1 minute") -> DataFrame:
    """Streaming partial sums in event time: tumbling windows of ``ratio`` dumps. ``samples``: ts (timestamp), channel, bl, re, im, flags."""
    clear = F.col("flags") == 0
    take = lambda keep, c: F.sum(F.when(keep, F.col(c).cast("long")).otherwise(F.lit(0).cast("long")))
    length = f"{int(seconds_per_dump * ratio * 1000)} milliseconds"
    return (
        samples.withWatermark("ts", delay)
        .groupBy(F.window("ts", length).alias("window"), "channel", "bl")
        .agg(
            F.count_if(clear).alias("n_u"), take(clear, "re").alias("re_u"), take(clear, "im").alias("im_u"),
            F.count_if(~clear).alias("n_f"), take(~clear, "re").alias("re_f"), take(~clear, "im").alias("im_f"),
            F.bit_or("flags").alias("any_flags"),
        )
    )
