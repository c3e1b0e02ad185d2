"""Top-N of closing windows on a stream, without a table beside it: two chained stages of bounded lists.

The counts of a window and key come from chained window aggregates.  They are dealt by a hash of the key:
each share keeps the best N of every window, and hands them on when the watermark has passed the window's
end; then the best N of what the shares hand on are the window's.  So a share's state is N entries a window
however many keys it has, and the second stage sees N times the shares at most.  The windows of a stretch
of time share one state, so that a stream that catches up closes many of them in one call.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eddyline.functions.times import bucket, column_type, micros, span
from eddyline.operators import windows
from eddyline.schemas import fields
from eddyline.streaming.runs import use_state_store

SHARES = 32
#: Windows whose lists are kept together: one call for all of them that a micro-batch closes.
STRETCH_WINDOWS = 256
# Names of pandas columns; those that begin with an underscore would be lost on the way.
_AT, _END, _PART, _SHARE = "at", "end_us", "part", "share"
_ENTRY = [_END, "none", "key", "cnt"]

# As in ``processors``: the worker on the driver does not see files added to the session.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Leaders(StatefulProcessor):
    """The best ``n`` entries of each window of a stretch, or of one share of them.

    Handed on when the watermark has passed a window's end; a stretch has one timer, for its next one.
    """

    def __init__(self, n: int, key: str, ranked: bool):
        self.n, self.key, self.ranked = n, key, ranked

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState(
            "best", f"{_END} array<long>, none array<boolean>, key array<{self.key}>, cnt array<long>, timer long"
        )

    def _best(self, entries: pd.DataFrame) -> pd.DataFrame:
        """Largest counts first; equal ones in order of the key, no key before any."""
        ranked = entries.sort_values([_END, "cnt", "none", "key"], ascending=[True, False, False, True])
        return ranked.groupby(_END).head(self.n)

    def _load(self) -> tuple[list[pd.DataFrame], int]:
        if not self.kept.exists():
            return [], -1
        *columns, timer = self.kept.get()
        return [pd.DataFrame(dict(zip(_ENTRY, columns)))], timer

    def _store(self, best: pd.DataFrame, timer: int) -> None:
        at = -(-int(best[_END].min()) // 1000)
        if at != timer:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
        self.kept.update((*[best[c].tolist() for c in _ENTRY], at))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held, timer = self._load()
        for batch in rows:
            held = [self._best(pd.concat([*held, batch[_ENTRY]]))]
        self._store(held[0], timer)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        (held,), _ = self._load()
        over = held[_END] <= passed
        if over.all():
            self.kept.clear()
        else:
            self._store(held[~over], -1)
        # The last instant of the window, as ``window_time`` has it.
        out = held[over].assign(**{_AT: pd.to_datetime(held[_END][over] - 1, unit="us"), _PART: int(key[0])})
        if self.ranked:
            out["rk"] = out.groupby(_END).cumcount() + 1
        yield out[[_AT, _PART, *_ENTRY, *(["rk"] if self.ranked else [])]]


def closed_top_n(
    stream: DataFrame, ts: str, size: str, slide: str, key: str, n: int, shares: int = SHARES
) -> DataFrame:
    """``key, cnt, window_end, rk``: the ``n`` most frequent keys of every sliding window, for append mode.

    Rows as those of ``topn.top_n_per_window`` over the counts, of windows that the watermark on ``ts`` has
    passed.  Keys are numbers or strings; equal counts rank in key order, a null key first.  A null event
    time is an error.  ``shares`` is the number of lists that a window's keys are dealt to.
    """
    use_state_store(stream.sparkSession)
    of = column_type(stream, key)
    counts = windows.sliding_chained(
        stream, ts, size, slide, [key], {"_cnt": ("count", F.lit(1))}, time="_at"
    )
    entries = counts.select(
        F.col("_at").alias(_AT),
        bucket(micros("window_end"), STRETCH_WINDOWS * span(slide)).alias(_PART),
        micros("window_end").alias(_END),
        F.pmod(F.hash(key), F.lit(shares)).alias(_SHARE),
        F.col(key).isNull().alias("none"),
        # Whole numbers beside nulls would become fractions on their way through pandas.
        F.coalesce(key, F.lit(0).cast(of)).alias("key"),
        F.col("_cnt").alias("cnt"),
    )
    name = of.simpleString()
    passed_on = fields(f"{_AT} timestamp, {_PART} long, {_END} long, none boolean, key long, cnt long")
    passed_on["key"].dataType = of
    of_shares = entries.groupBy(_PART, _SHARE).transformWithStateInPandas(
        statefulProcessor=Leaders(n, name, ranked=False),
        outputStructType=passed_on,
        outputMode="append",
        timeMode="eventTime",
        eventTimeColumnName=_AT,
    )
    found = of_shares.groupBy(_PART).transformWithStateInPandas(
        statefulProcessor=Leaders(n, name, ranked=True),
        outputStructType=T.StructType([*passed_on.fields, *fields("rk long").fields]),
        outputMode="append",
        timeMode="eventTime",
    )
    return found.select(
        F.when(~F.col("none"), F.col("key")).alias(key), "cnt", F.timestamp_micros(_END).alias("window_end"), "rk"
    )
