"""Averaging groups by count of dumps on a stream.

Event time cannot close a group: dumps have numbers, a group is a number of them, and the last one is partial. The state of a
key (such as a session and a baseline) holds the sums of its open group by channel. A dump of a later group closes it; groups that
no dump falls into are skipped; a row whose dump is null is the end of the stream and closes the open group as it is. Dumps of
closed groups come too late: their samples count in ``late`` of the next row that the key hands on, and nowhere else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.average import SUMS
from ..session import use_rocksdb

SUM_TYPES = ", ".join(f"{c} long" for c in SUMS) + ", any_flags int"
ADDED = [*SUMS, "any_flags"]


def sums_by_channel(df: pd.DataFrame) -> pd.DataFrame:
    """Partial sums by (grp, channel) of samples, as ``average.partials`` has them."""
    clear = (df["flags"] == 0).to_numpy()
    parts = {"grp": df["grp"], "channel": df["channel"], "any_flags": df["flags"]}
    for side, keep in (("u", clear), ("f", ~clear)):
        parts |= {f"n_{side}": keep.astype(np.int64), f"re_{side}": df["re"].to_numpy(np.int64) * keep, f"im_{side}": df["im"].to_numpy(np.int64) * keep}
    return _add(pd.DataFrame(parts))


def _add(parts: pd.DataFrame) -> pd.DataFrame:
    by = parts.groupby(["grp", "channel"], sort=False)
    out = by[list(SUMS)].sum()
    out["any_flags"] = by["any_flags"].agg(np.bitwise_or.reduce)
    return out.reset_index()


class CountWindows(StatefulProcessor):
    def __init__(self, keys: list[str], ratio: int):
        self.keys, self.ratio = keys, ratio

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "grp long, late long")
        self.sums = handle.getMapState("sums", "channel int", SUM_TYPES)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows))
        ended = bool(df["dump"].isna().any())
        # A null among integers has made doubles of them.
        df = df[df["dump"].notna()].astype({c: "int64" for c in ("dump", "channel", "re", "im", "flags")})
        at, late = self.open.get() if self.open.exists() else (None, 0)
        df = df.assign(grp=df["dump"] // self.ratio)
        if at is not None:
            late += int((df["grp"] < at).sum())
            df = df[df["grp"] >= at]
        sums = sums_by_channel(df) if len(df) else pd.DataFrame(columns=["grp", "channel", *ADDED])
        newest = max([*([at] if at is not None else []), *([int(sums["grp"].max())] if len(sums) else [])], default=None)
        if newest is None:
            return
        # The open group's own sums join in only where it changes or closes.
        if at is not None and (ended or newest > at or len(sums)):
            held = pd.DataFrame([(at, k[0], *v) for k, v in self.sums.iterator()], columns=["grp", "channel", *ADDED])
            sums = _add(pd.concat([held, sums[held.columns]]).astype("int64")) if len(held) else sums
        closed = sums if ended else sums[sums["grp"] < newest]
        if ended or newest != at:
            self.sums.clear()
        if ended:
            self.open.clear()
        else:
            for r in sums[sums["grp"] == newest].to_dict("records"):
                self.sums.updateValue((int(r["channel"]),), tuple(int(r[c]) for c in ADDED))
            self.open.update((newest, 0 if len(closed) else late))
        if len(closed):
            out = closed.rename(columns={"grp": "out_idx"})
            out = out.assign(**dict(zip(self.keys, key)), late=0)
            out.loc[out.index[0], "late"] = late
            yield out[[*self.keys, "out_idx", "channel", *ADDED, "late"]].astype({c: "int64" for c in ("out_idx", *SUMS, "late")} | {"channel": "int32", "any_flags": "int32"})

    def close(self) -> None:
        pass


def count_windows(samples: DataFrame, keys: list[str], ratio: int) -> DataFrame:
    """Partial sums of closed groups: the keys, out_idx, channel, the sums, late. ``samples``: the keys, dump, channel, re, im, flags, each key's dumps in order but for what is late.

    Rows of one key and trigger are in one task's memory, which the source's limits on a trigger bound.
    """
    use_rocksdb(samples.sparkSession)
    kinds = dict(samples.dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "out_idx long", "channel int", SUM_TYPES, "late long"])
    rows = samples.select(*keys, "dump", "channel", "re", "im", "flags")
    return rows.groupBy(*keys).transformWithStateInPandas(CountWindows(keys, ratio), schema, "Append", "None")
