"""Keyed state programs.  Rows arrive as Arrow batches per key.

Every input frame has the order columns first (``ts``, then ties ``o0..``); a
micro-batch has no row order of its own, so programs order a key's rows by them.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor


class FirstClaim(StatefulProcessor):
    """Keeps ``is_new`` "1" on a key's first claim and sets it to "0" on all others.

    Holds one candidate row at a time, however many rows the key has.  Rows already
    set to "0" by an earlier round pass.
    """

    def __init__(self, order):
        self._order = order

    def init(self, handle):
        self._seen = handle.getValueState("seen", "ts bigint")

    def handleInputRows(self, key, rows, timerValues):
        seen = self._seen.exists()
        best = None
        for frame in rows:
            claims = frame[frame["is_new"] == "1"]
            if not seen and len(claims):
                pool = claims if best is None else pd.concat([best, claims])
                ranked = pool.sort_values(self._order)
                best = ranked.head(1)
                frame = pd.concat([ranked.iloc[1:], frame[frame["is_new"] != "1"]])
            if len(frame):
                yield frame.assign(is_new="0")
        if best is not None:
            self._seen.update((int(best["ts"].iloc[0]),))
            yield best

    def close(self):
        pass


class DailyFirst(StatefulProcessor):
    """Passes a key's row when its ``day`` differs from the last day passed.

    In event order only the first row of a day can pass, so one row per day is held.
    """

    def __init__(self, order, ttl_ms=None):
        self._order = order
        self._ttl_ms = ttl_ms

    def init(self, handle):
        self._day = handle.getValueState("day", "day string", self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        firsts = None
        for frame in rows:
            pool = frame if firsts is None else pd.concat([firsts, frame])
            firsts = pool.sort_values(self._order).drop_duplicates("day")
        if firsts is None or firsts.empty:
            return
        last = self._day.get()
        self._day.update((firsts["day"].iloc[-1],))
        if last is not None and last[0] == firsts["day"].iloc[0]:
            firsts = firsts.iloc[1:]
        if len(firsts):
            yield firsts

    def close(self):
        pass


class Runs(StatefulProcessor):
    """Decides entry events of the visitors of one (bucket, time slice) once the limit after them has passed.

    An automaton of ``n`` states walks over what follows an entry: an entry in time takes it one
    state on, the last is a match; the limit or the end of the rows before that is a timeout, and any
    other event ends it without outcome.

    State holds the rows that can still matter, packed: undecided entries and what follows
    them.  A slice ends, so its state empties as the watermark moves on.
    """

    def __init__(self, ties, within_ms, n=2):
        self._ties = [name for name, _ in ties]
        self._within = within_ms
        self._n = n

    def init(self, handle):
        self._handle = handle
        self._rows = handle.getListState("rows", "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        earliest = None
        for frame in rows:
            if frame.empty:
                continue
            self._rows.appendValue((_pack(frame[["mid", "ts", *self._ties, "start", "body"]]),))
            low = int(frame["ts"].min())
            earliest = low if earliest is None else min(earliest, low)
        if earliest is not None:
            self._handle.registerTimer(earliest + self._within)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs()
        packed = [_unpack(row[0]) for row in self._rows.get()]
        if not packed:
            return
        rows = pd.concat(packed, ignore_index=True)
        rows["visitor"] = pd.factorize(rows["mid"], use_na_sentinel=False)[0]
        rows = rows.sort_values(["visitor", "ts", *self._ties], na_position="first", ignore_index=True)
        visitor, ts = rows["visitor"].to_numpy(), rows["ts"].to_numpy()
        undecided = rows["body"].notna().to_numpy()
        due = undecided & (ts + self._within <= watermark)
        outcome = self._outcomes(visitor, ts, rows["start"].to_numpy(dtype=bool))
        found = due & (outcome != "")
        if found.any():
            yield pd.DataFrame({"body": rows["body"].to_numpy()[found], "outcome": outcome[found]})
        open_from = np.full(visitor.max() + 1, watermark, np.int64)
        still = undecided & ~due
        np.minimum.at(open_from, visitor[still], ts[still])
        rows["body"] = rows["body"].astype(object).where(still, None)
        kept = rows[ts >= open_from[visitor]].drop(columns="visitor")
        if len(kept):
            self._rows.put([(_pack(kept),)])
            self._handle.registerTimer(max(int(kept["ts"].min()) + self._within, watermark + 1))
        else:
            self._rows.clear()

    def _outcomes(self, visitor, ts, start):
        """What became of each row by those after it; empty where another event ended it."""
        outcome = np.full(len(ts), "match", object)
        for step in range(self._n - 1, 0, -1):
            in_time, again = np.zeros(len(ts), bool), np.zeros(len(ts), bool)
            in_time[:-step] = (visitor[step:] == visitor[:-step]) & (ts[step:] - ts[:-step] < self._within)
            again[:-step] = start[step:]
            outcome = np.where(~in_time, "timeout", np.where(again, outcome, ""))
        return outcome

    def close(self):
        pass


def _pack(frame):
    batch = pa.RecordBatch.from_pandas(frame, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpack(packed):
    return pa.ipc.open_stream(packed).read_all().to_pandas()


# Python workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
