"""Per-key state machines on streams, in event-time order.

Each detector is a few lines of state logic; ``InOrder`` does the rest: it holds a key's rows
until the watermark has passed them, hands them on in time order, and calls the detector when a
deadline has passed.  What is held per key is what arrived within the watermark delay.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eddyline.functions.times import bucket, micros, span
from eddyline.operators.patterns import bucket_width
from eddyline.operators.timeline import BUCKET, HOME, overlapping
from eddyline.schemas import fields
from eddyline.streaming.runs import use_state_store

FOREVER = 1 << 62
#: The tag of rows that come behind the watermark; no detector sees them.
LATE = "late"
#: The rows of an entry, a column each.
SLOT_ROWS = T.StructType(
    [
        T.StructField(name, T.ArrayType(kind))
        for name, kind in (
            ("us", T.LongType()),
            ("side", T.IntegerType()),
            ("tie", T.LongType()),
            ("kind", T.IntegerType()),
        )
    ]
)
#: What is kept of a key beside the detector's state.
KEPT = """timer long, entries array<long>, firsts array<long>,
us array<long>, side array<int>, tie array<long>, kind array<int>"""
#: Buckets of streams with keys are so many times as long: every key's every bucket has a state and a timer.
SPARSE = 4
#: Rows that wait in one value.
MOST = 256
RESULT = fields("first_us long, last_us long, first_tie long, last_tie long, n long, tag string")

# Sent to the Python workers with their code: the worker that prepares a stateful stream on the
# driver does not see files added to the session.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

State = tuple | None
Output = tuple


class Detector:
    """State is a tuple of the columns in ``state``; outputs are tuples like ``RESULT``."""

    state = "a long, b long, n long"

    def event(self, state: State, us: int, tie: int, kind: int) -> tuple[State, list[Output]]:
        raise NotImplementedError

    def deadline(self, state: tuple) -> int:
        """Last instant at which an event can still change the outcome."""
        raise NotImplementedError

    def expired(self, state: tuple) -> tuple[State, list[Output]]:
        """The state and outputs once that instant has passed."""
        return None, []


class FailureWindow(Detector):
    """kind 1 is a failure, 0 a success.  State: window opened, last failure, failures."""

    def __init__(self, length: int, at_least: int = 2):
        self.length, self.at_least = length, at_least

    def event(self, state, us, tie, kind):
        if kind == 0:
            return None, []
        if state is None:
            return (us, us, 1), []
        return (state[0], us, state[2] + 1), []

    def deadline(self, state):
        return state[0] + self.length

    def expired(self, state):
        enough = state[2] >= self.at_least
        return None, [(state[0], state[1], None, None, state[2], "alert")] if enough else []


class OrderState(Detector):
    """kind 0 creates, 1 pays.  State: create time and tie."""

    def __init__(self, within: int):
        self.within = within

    def event(self, state, us, tie, kind):
        if kind == 0:
            return (us, tie, 0), []
        if state is None:
            return None, [(us, us, tie, tie, 1, "pay_without_create")]
        return None, [(state[0], us, state[1], tie, 2, "paid")]

    def deadline(self, state):
        return state[0] + self.within

    def expired(self, state):
        end = state[0] + self.within
        return None, [(state[0], end, state[1], state[1], 1, "create_without_pay")]


class FollowedBy(Detector):
    """kind 0 starts, 1 follows.  State: times and ties of the starts still open, oldest first.

    The first follower matches every open start; each start times out on its own.
    """

    state = "starts array<bigint>, ties array<bigint>, n long"

    def __init__(self, within: int):
        self.within = within

    def event(self, state, us, tie, kind):
        starts, ties = (list(state[0]), list(state[1])) if state else ([], [])
        if kind == 0:
            return ([*starts, us], [*ties, tie], len(starts) + 1), []
        return None, [(s, us, t, tie, 2, "matched") for s, t in zip(starts, ties)]

    def deadline(self, state):
        return state[0][0] + self.within - 1

    def expired(self, state):
        starts, ties = list(state[0]), list(state[1])
        out = [(starts[0], starts[0] + self.within, ties[0], None, 1, "timeout")]
        return ((starts[1:], ties[1:], len(starts) - 1) if starts[1:] else None), out


class StrictRun(Detector):
    """kind 1 matches, 0 does not.  State: times and ties of the matching rows just before.

    A row that ends a run of ``times`` matching rows, all in less than ``within``, is reported
    with the run's first row; without a bound the state of a key is never dropped.
    """

    state = "starts array<bigint>, ties array<bigint>, n long"

    def __init__(self, times: int, within: int | None = None):
        self.times, self.within = times, within

    def event(self, state, us, tie, kind):
        if kind == 0:
            return None, []
        starts, ties = (list(state[0]), list(state[1])) if state else ([], [])
        starts, ties = [*starts, us][-self.times :], [*ties, tie][-self.times :]
        out = []
        if len(starts) == self.times and (self.within is None or us - starts[0] < self.within):
            out = [(starts[0], us, ties[0], tie, self.times, "matched")]
        return (starts[1 - self.times :], ties[1 - self.times :], 0), out

    def deadline(self, state):
        return FOREVER if self.within is None else state[0][-1] + self.within


class Pairing(Detector):
    """kind is the side.  State: waiting row's time, tie and side."""

    def __init__(self, wait: int, tags: tuple[str, str, str]):
        self.wait, self.tags = wait, tags

    def _alone(self, state):
        return (state[0], state[0], state[1], state[1], state[2], self.tags[1 + state[2]])

    def event(self, state, us, tie, kind):
        if state is None:
            return (us, tie, kind), []
        if state[2] == kind:
            return (us, tie, kind), [self._alone(state)]
        return None, [(state[0], us, state[1], tie, state[2], self.tags[0])]

    def deadline(self, state):
        return state[0] + self.wait

    def expired(self, state):
        return None, [self._alone(state)]


class InOrder(StatefulProcessor):
    """Runs a detector over one key's rows in event-time order.

    Every call to the state costs as much as many rows, so a key has one value: the detector's state, its
    timer and up to ``most`` waiting rows.  Where more wait, they go in time order to entries of about so
    many rows, each of whole slots of event time.  A timer reads the entries that have begun and no others.
    A key has one timer at a time.
    """

    def __init__(self, detector: Detector, columns: Sequence[str], slot: int, most: int = 8):
        self.detector, self.columns, self.slot, self.most = detector, list(columns), slot, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", f"state struct<{self.detector.state}>, {KEPT}")
        self.waiting = handle.getMapState("waiting", fields("entry long"), SLOT_ROWS)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        result = Row(*self.columns)
        new: list[tuple] = []
        for r in rows:
            if r.us <= passed:
                # The order of the key's rows is settled up to the watermark.
                yield result(*key, r.us, r.us, r.tie, r.tie, None, LATE)
            else:
                new.append((r.us, r.side, r.tie, r.kind))
        if new:
            state, timer, entries, near = self._load()
            self._store(state, timer, entries, near + new)

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        state, _, entries, held = self._load()
        for entry in [e for e, first in entries.items() if first <= passed]:
            held += zip(*self.waiting.getValue((entry,)), strict=True)
            self.waiting.removeKey((entry,))
            del entries[entry]
        out: list[Output] = []
        rest = [r for r in held if r[0] > passed]
        for us, _, tie, kind in sorted(r for r in held if r[0] <= passed):
            state = self._expire(state, us, out)
            state, more = self.detector.event(state, us, tie, kind)
            out += more
        state = self._expire(state, passed, out)
        self._store(state, -1, entries, rest)
        result = Row(*self.columns)
        for row in out:
            yield result(*key, *row)

    def _load(self) -> tuple[State, int, dict[int, int], list[tuple]]:
        """The detector's state, the timer, the first instant of each entry, and the rows beside them."""
        kept = self.kept.get()
        if kept is None:
            return None, -1, {}, []
        state, timer, entries, firsts, *near = kept
        return state and tuple(state), timer, dict(zip(entries, firsts)), list(zip(*near, strict=True))

    def _store(self, state: State, timer: int, entries: dict[int, int], near: list[tuple]) -> None:
        """Keeps all that and sets the timer: for the next row or the deadline."""
        if len(near) > self.most:
            near = sorted(near, key=lambda r: r[0])
            start, entry = 0, max(entries, default=-1) + 1
            for k in range(1, len(near) + 1):
                full = k - start >= self.most
                if k == len(near) or full and near[k][0] // self.slot > near[k - 1][0] // self.slot:
                    self.waiting.updateValue((entry,), _by_column(near[start:k]))
                    entries[entry] = near[start][0]
                    start, entry = k, entry + 1
            near = []
        calls = [*entries.values(), *(r[0] for r in near)]
        if state is not None and self.detector.deadline(state) < FOREVER:
            calls.append(self.detector.deadline(state) + 1)
        at = -(-min(calls) // 1000) if calls else -1
        if at != timer:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            if at >= 0:
                self.handle.registerTimer(at)
        if state is None and not calls:
            self.kept.clear()
        else:
            told = (list(entries), list(entries.values()), *(_by_column(near) if near else ([], [], [], [])))
            self.kept.update((state, at, *told))

    def _expire(self, state: State, now: int, out: list[Output]) -> State:
        """Let a deadline before ``now`` take effect."""
        while state is not None and self.detector.deadline(state) < now:
            state, more = self.detector.expired(state)
            out += more
        return state


def _by_column(rows: list[tuple]) -> tuple[list, ...]:
    return tuple(map(list, zip(*rows, strict=True)))


def detect(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    kind: Column,
    detector: Detector,
    side: Column | None = None,
    bound: int | None = None,
    bucket_size: str | None = None,
    slot: str = "1 minute",
) -> DataFrame:
    """Run a detector per key; ``ts`` must carry a watermark.  Result: keys and ``RESULT``.

    Rows behind the watermark come out as they are, once, with the tag ``late``.

    Where many rows of a key wait for the watermark, they do so by whole slots of event time of length ``slot``.

    At equal times rows come in order of ``side`` (default: ``kind``), then ``tie``.

    ``bound`` is for detectors whose results depend on no more than that much time around their
    first row (``StrictRun`` and ``FollowedBy`` within a bound, ``OrderState``).  The state is
    then kept per key and time bucket, with rows near an edge copied over, so that a hot key, or
    a whole stream taken as one sequence, is spread over many tasks.  ``bucket_size`` is the length
    of a bucket (default: 8 bounds, with keys 32); a busy key needs shorter ones, at the price of more copies.
    """
    use_state_store(stream.sparkSession)
    kind = kind.cast("int")
    events = stream.select(
        *keys,
        micros(ts).alias("us"),
        (kind if side is None else side.cast("int")).alias("side"),
        F.col(tie).cast("long").alias("tie"),
        kind.alias("kind"),
    )
    parts = list(keys)
    if bound is not None:
        width = bucket_width(bound if not keys or bucket_size else SPARSE * bound, bucket_size)
        timed = events.withColumn("_at", F.timestamp_micros("us"))
        events = overlapping(timed, "_at", width, behind=bound, ahead=bound).drop(HOME, "_at")
        parts.append(BUCKET)
    schema = T.StructType([events.schema[name] for name in parts] + RESULT.fields)
    found = events.groupBy(*parts).transformWithState(
        statefulProcessor=InOrder(detector, schema.names, span(slot), MOST),
        outputStructType=schema,
        outputMode="append",
        timeMode="eventTime",
    )
    if bound is None:
        return found
    return found.where(F.col(BUCKET) == bucket(F.col("first_us"), width)).drop(BUCKET)


def with_times(found: DataFrame, first: str = "first_ts", last: str = "last_ts") -> DataFrame:
    return found.withColumns(
        {first: F.timestamp_micros("first_us"), last: F.timestamp_micros("last_us")}
    ).drop("first_us", "last_us")
