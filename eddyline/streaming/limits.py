"""The first rows of each key and local day on a stream, by two chained stages of bounded lists.

The rows of a key and day are dealt by a hash to shares.  No share can have more than the first ``limit + 1``
of its rows among the first of all, so it holds that many and passes over the rest; it hands them on in
order as the watermark settles them.  What the shares hand on is numbered per key and day, which sees
``limit + 1`` rows a share at most, however often a key clicks.

Most keys have few rows a day, so that a state of their own would cost more than their rows.  Shares of keys
are dealt to parts, and a part's day has one state and one timer; its rows are worked off by columns.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eddyline.functions.times import LOCAL_DAY_OFFSET, local_day, micros, required, span, timed
from eddyline.schemas import fields
from eddyline.streaming import keys as state_keys
from eddyline.streaming.runs import use_state_store

PASS, WARNING, LATE = "pass", "warning", "late"
SHARES = 16
#: States of a day, for all its keys.
PARTS = 64
DAY = span("1 day")

# As in ``processors``: the worker on the driver does not see files added to the session.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _day_end(day: int) -> int:
    """First instant after the local day, in whole milliseconds."""
    return -(-((day + 1) * DAY - LOCAL_DAY_OFFSET) // 1000)


def _packed(rows: pd.DataFrame) -> bytes:
    """Columns of plain types as bytes, for state."""
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(kept: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(kept)).read_all().to_pandas()


class _Counts:
    """How many rows each key has had; ``keys`` are the columns that tell keys apart."""

    def __init__(self, keys: list[str], kept: bytes | None):
        self.keys = keys
        self.known = None if kept is None else _unpacked(kept)

    def before(self, rows: pd.DataFrame) -> np.ndarray:
        """Rows of the same key before each of ``rows``: those counted and those above it."""
        above = rows.groupby(self.keys, sort=False, dropna=False).cumcount().to_numpy()
        if self.known is None or not len(rows):
            return above
        counted = rows[self.keys].merge(self.known, "left", self.keys)["_n"].fillna(0)
        return above + counted.to_numpy(np.int64)

    def add(self, rows: pd.DataFrame) -> None:
        new = rows.groupby(self.keys, sort=False, dropna=False).size().rename("_n").reset_index()
        if self.known is not None:
            new = pd.concat([self.known, new]).groupby(self.keys, sort=False, dropna=False)["_n"].sum().reset_index()
        self.known = new

    def packed(self) -> bytes | None:
        return None if self.known is None else _packed(self.known)


#: The one key of a state without key columns among its rows.
_ONE = "_one"
#: Rows that are gathered before they are cut to the first ones.
_GATHERED = 50_000


class _Day(StatefulProcessor):
    """What both stages share.  The first ``keys`` of ``columns`` and the day come with the state's key.

    ``among`` names the columns that tell apart the keys that share a state.
    """

    def __init__(self, columns: Sequence[str], keys: int, most: int, among: Sequence[str] = ()):
        self.columns, self.keys, self.most = list(columns), keys, most
        self.among = list(among) or [_ONE]

    def _read(self, batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(**{_ONE: 0}) if self.among == [_ONE] else batch

    def _told(self, key: tuple, rows: pd.DataFrame, **more: Any) -> pd.DataFrame:
        own = {name: [key[k]] * len(rows) for k, name in enumerate(self.columns[: self.keys + 1])}
        found = {name: rows[name].to_numpy() for name in self.columns if name in rows}
        return pd.DataFrame({**own, **found, **more})[self.columns]


class FirstRows(_Day):
    """Shares of a day: the first ``most`` rows of each, handed on once the watermark has passed them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "us array<long>, tie array<long>, own binary, done binary, timer long")

    def _first(self, rows: pd.DataFrame, done: _Counts) -> pd.DataFrame:
        rows = rows.sort_values(["us", "tie"], ignore_index=True)
        return rows[done.before(rows) < self.most]

    def _store(self, key: tuple, waiting: pd.DataFrame, done: _Counts, timer: int) -> None:
        """Keeps the state until the day is over; the timer is for the next row, or for that."""
        at = _day_end(int(key[self.keys]))
        if len(waiting):
            at = min(at, -(-int(waiting["us"].iloc[0]) // 1000))
        if at != timer:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
        own = _packed(waiting[self.among]) if len(waiting) else None
        self.kept.update((waiting["us"].tolist(), waiting["tie"].tolist(), own, done.packed(), at))

    def _load(self) -> tuple[pd.DataFrame | None, _Counts, int]:
        kept = self.kept.get()
        if kept is None:
            return None, _Counts(self.among, None), -1
        us, tie, own, done, timer = kept
        waiting = None if own is None else _unpacked(own).assign(us=np.array(us, np.int64), tie=np.array(tie, np.int64))
        return waiting, _Counts(self.among, done), timer

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, done, timer = self._load()
        gathered, n, came = [] if waiting is None else [waiting], 0, False
        for batch in rows:
            batch = self._read(batch)[[*self.among, "us", "tie"]]
            late = batch["us"] <= passed
            if late.any():
                # What is handed on must not lie behind the watermark.
                yield self._told(key, batch[late], late=True, at=pd.to_datetime(passed + 1000, unit="us"))
            if late.all():
                continue
            came = True
            gathered.append(batch[~late])
            n += len(gathered[-1])
            if n > max(_GATHERED, len(gathered[0])):
                gathered, n = [self._first(pd.concat(gathered), done)], 0
        if came:
            self._store(key, self._first(pd.concat(gathered), done), done, timer)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, done, _ = self._load()
        over = _day_end(int(key[self.keys])) * 1000 <= passed
        if waiting is not None:
            due = waiting["us"] <= passed
            if due.any():
                rows = waiting[due]
                yield self._told(key, rows, late=False, at=pd.to_datetime(rows["us"].to_numpy(), unit="us"))
                if not over:
                    done.add(rows)
            waiting = waiting[~due]
        if over:
            self.kept.clear()
        else:
            self._store(key, pd.DataFrame({"us": [], "tie": []}) if waiting is None else waiting, done, -1)


class Numbered(_Day):
    """The rows of keys' day, which come settled, numbered up to the first one over the limit."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "seen binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        kept = self.kept.get()
        seen = _Counts(self.among, None if kept is None else kept[0])
        # Shares hand on limit + 1 rows a day each, late rows aside, which are passed through.
        settled = []
        for batch in rows:
            batch = self._read(batch)
            late = batch["late"].to_numpy(bool)
            if late.any():
                yield self._told(key, batch[late], tag=LATE)
            settled.append(batch[[*self.among, "us", "tie"]][~late])
        settled = pd.concat(settled).sort_values(["us", "tie"], ignore_index=True)
        before = seen.before(settled)
        first, before = settled[before < self.most], before[before < self.most]
        if len(first):
            yield self._told(key, first, tag=np.where(before < self.most - 1, PASS, WARNING).astype(object))
            if kept is None:
                self.handle.registerTimer(_day_end(int(key[self.keys])))
            seen.add(first)
            self.kept.update((seen.packed(),))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.kept.clear()
        yield from ()


def click_limit(
    stream: DataFrame, keys: Sequence[str], ts: str, tie: str, limit: int, shares: int = SHARES
) -> DataFrame:
    """``keys, ts, tie, tag`` of the first ``limit`` rows of each key's local day (``pass``) and the next one.

    That one has the tag ``warning``; further rows are dropped, as the filter is meant to do.  Rows in order of
    ``ts``, then ``tie``.  Rows that come behind the watermark on ``ts`` come out once with the tag
    ``late`` and do not count.  Null keys are a key of their own; a null time or tie is an error.
    """
    use_state_store(stream.sparkSession)
    names = state_keys.names(keys)
    at = micros(ts)
    # Without the time itself, so that Spark does not drop late rows before they can be told.
    rows = timed(stream, ts).select(
        *state_keys.filled(stream, keys),
        local_day(at).alias("day"),
        at.alias("us"),
        required(tie).cast("long").alias("tie"),
        F.pmod(F.xxhash64(ts, tie), F.lit(shares)).alias("share"),
    )
    own = [rows.schema[name] for name in names]
    # Equal keys have one hash: zero and minus zero too.
    plain = [F.col(f.name) + F.lit(0) if isinstance(f.dataType, T.FractionalType) else F.col(f.name) for f in own]
    rows = rows.withColumn("part", F.pmod(F.xxhash64(*plain, "share"), F.lit(PARTS))).drop("share")
    day = fields("day long").fields
    handed = T.StructType([*day, *own, *fields("at timestamp, us long, tie long, late boolean").fields])
    first = rows.groupBy("day", "part").transformWithStateInPandas(
        statefulProcessor=FirstRows(handed.names, 0, limit + 1, names),
        outputStructType=handed,
        outputMode="append",
        timeMode="eventTime",
        eventTimeColumnName="at",
    )
    told = T.StructType([*day, *own, *fields("us long, tie long, tag string").fields])
    whole = F.pmod(F.xxhash64(*plain), F.lit(PARTS))
    found = first.withColumn("part", whole).groupBy("day", "part").transformWithStateInPandas(
        statefulProcessor=Numbered(told.names, 0, limit + 1, names),
        outputStructType=told,
        outputMode="append",
        timeMode="eventTime",
    )
    return found.select(
        *state_keys.restored(keys),
        F.timestamp_micros("us").alias(ts), F.col("tie").alias(tie), "tag",
    )
