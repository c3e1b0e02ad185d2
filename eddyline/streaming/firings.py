"""Sliding counts on a stream that fire at the window's end, and again whenever late rows correct them.

A window fires when the watermark, which trails the largest event time by the bound of disorder, has
passed its end.  Until the allowed lateness is over as well, a micro-batch with further rows for it makes
it fire once more with the corrected count.  Rows that come when all their windows are closed are handed
on by the same query with the tag ``late``.

State is kept per key and stretch of time: the counts of the slide-long panes that its windows see, and
how often each window has fired.  A row goes to one stretch or two, however many windows it is in, and a
stretch's state is removed when its last window is closed.  Rows come in Arrow batches and are counted by
numpy; a stretch has one timer, for its next window.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eddyline.functions.times import bucket, micros, span, timed
from eddyline.schemas import fields
from eddyline.streaming import keys as state_keys
from eddyline.streaming.runs import use_state_store

WINDOW, LATE = "window", "late"
FIRED = fields("window_us long, firing int, cnt long, tag string, us long, tie long")
_PART = "_part"
STRETCH_PANES = 1024
#: In place of the number of firings: the window has closed without a row.
_NEVER = -1

# As in ``processors``: the worker on the driver does not see files added to the session.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Firings(StatefulProcessor):
    """The windows of one key and stretch; all times in microseconds."""

    def __init__(self, columns: Sequence[str], step: int, of: int, length: int, lateness: int):
        self.columns, self.step, self.of, self.lateness = list(columns), step, of, lateness
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Panes from the first window's first one on; firings of the stretch's windows.
        self.kept = handle.getValueState("kept", "panes array<long>, fired array<int>, timer long")

    def _ends(self, part: int) -> np.ndarray:
        return (part * self.length + 1 + np.arange(self.length)) * self.step

    def _counts(self, panes: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(panes)])
        return total[self.of :] - total[: -self.of]

    def _load(self) -> tuple[np.ndarray, np.ndarray, int]:
        if self.kept.exists():
            panes, fired, timer = self.kept.get()
            return np.array(panes, np.int64), np.array(fired, np.int32), timer
        return np.zeros(self.length + self.of - 1, np.int64), np.zeros(self.length, np.int32), -1

    def _store(self, part: int, panes: np.ndarray, fired: np.ndarray, timer: int, passed: int) -> None:
        """Keeps the state and sets the timer: for the next window to fire, or for the end of the stretch."""
        ends = self._ends(part)
        waiting = ends[(fired == 0) & (self._counts(panes) > 0) & (ends > passed)]
        at = int(waiting[0] if len(waiting) else ends[-1] + self.lateness)
        at = -(-at // 1000)
        if at != timer:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
        self.kept.update((panes.tolist(), fired.tolist(), at))

    def _rows(self, key: tuple, found: dict[str, Any], n: int) -> pd.DataFrame:
        own = dict(zip(self.columns, key[:-1]))
        return pd.DataFrame({c: found.get(c, [own.get(c)] * n) for c in self.columns})

    def _fire(self, key: tuple, which: np.ndarray, panes: np.ndarray, fired: np.ndarray) -> pd.DataFrame:
        fired[which] += 1
        n = int(which.sum())
        return self._rows(
            key,
            {
                "window_us": self._ends(key[-1])[which], "firing": fired[which],
                "cnt": self._counts(panes)[which], "tag": [WINDOW] * n,
            },
            n,
        )

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        part = key[-1]
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        panes, fired, timer = self._load()
        added = np.zeros_like(panes)
        for batch in rows:
            us, home = batch["us"].to_numpy(np.int64), batch["home"].to_numpy(bool)
            pane = us // self.step
            late = (pane + self.of) * self.step + self.lateness <= passed
            mine = late & home
            if mine.any():
                told = {"tag": [LATE] * int(mine.sum()), "us": us[mine], "tie": batch["tie"].to_numpy()[mine]}
                yield self._rows(key, told, int(mine.sum()))
            np.add.at(added, pane[~late] - (part * self.length - self.of + 1), 1)
        ends = self._ends(part)
        if not added.any() or ends[-1] + self.lateness <= passed:
            return
        # Closed windows no longer change: those that were to fire now do so without the new rows, the
        # others never will, though they share panes with windows that are still open.
        closed = (fired == 0) & (ends + self.lateness <= passed)
        due = closed & (self._counts(panes) > 0)
        if due.any():
            yield self._fire(key, due, panes, fired)
        fired[closed & ~due] = _NEVER
        panes += added
        # Passed windows that this batch changes; those before their end wait for the timer.
        which = (self._counts(added) > 0) & (ends <= passed) & (ends + self.lateness > passed)
        if which.any():
            yield self._fire(key, which, panes, fired)
        self._store(part, panes, fired, timer, passed)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        part = key[-1]
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        panes, fired, _ = self._load()
        ends = self._ends(part)
        which = (fired == 0) & (self._counts(panes) > 0) & (ends <= passed)
        if which.any():
            yield self._fire(key, which, panes, fired)
        if ends[-1] + self.lateness <= passed:
            self.kept.clear()
        else:
            self._store(part, panes, fired, -1, passed)


def window_firings(
    stream: DataFrame,
    ts: str,
    tie: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    bound: str,
    lateness: str,
    stretch: str | None = None,
) -> DataFrame:
    """``keys, window_end, firing, cnt, tag, late_ts, tie``: a row per firing and per late row.

    ``firing`` counts the firings of a window from 1.  Rows with the tag ``late`` have ``late_ts`` and
    ``tie`` of the row, the others the window's end and count.  A null event time is an error.  The size
    is a multiple of the slide.  Closed windows, which a row in time for later ones comes too late for,
    do not change.  ``stretch`` is the length of time whose windows are kept together (default: about
    ``STRETCH_PANES`` slides): shorter ones cut a busy key further.  Hand the result to ``sinks.TagTables`` for a table per tag.
    """
    width, step = span(size), span(slide)
    if width % step:
        raise ValueError("panes need a size that is a multiple of the slide")
    use_state_store(stream.sparkSession)
    of = width // step
    rows = timed(stream, ts).withWatermark(ts, bound).select(
        *state_keys.filled(stream, keys), micros(ts).alias("us"), F.col(tie).cast("long").alias("tie")
    )
    length = max(of, STRETCH_PANES if stretch is None else -(-span(stretch) // step))
    pane = bucket(F.col("us"), step)
    own = bucket(pane, length)
    # The last panes of a stretch are in windows of the next one too.
    parts = F.when(F.pmod(pane, F.lit(length)) + of <= length, F.array(own)).otherwise(F.array(own, own + 1))
    rows = rows.withColumn(_PART, F.explode(parts)).withColumn("home", F.col(_PART) == own)
    names = state_keys.names(keys)
    schema = T.StructType([rows.schema[name] for name in names] + FIRED.fields)
    found = rows.groupBy(*names, _PART).transformWithStateInPandas(
        statefulProcessor=Firings(schema.names, step, of, length, span(lateness)),
        outputStructType=schema,
        outputMode="append",
        timeMode="eventTime",
    )
    return found.select(
        *state_keys.restored(keys), F.timestamp_micros("window_us").alias("window_end"), "firing", "cnt", "tag",
        F.timestamp_micros("us").alias("late_ts"), "tie",
    )
