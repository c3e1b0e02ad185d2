"""What stateful processors ask of the state: few calls, however many rows and keys."""

from __future__ import annotations

from collections import Counter

import brute
import pandas as pd
import pytest
from pyspark.sql import Row
from test_streaming import FakeState, Watermark, detected, fed, kind_number, us  # noqa: F401

from eddyline.functions.times import span
from eddyline.streaming import limits, processors


class Counted(FakeState):
    """State of one key that counts every call, of timers too."""

    calls: Counter = Counter()

    def getValueState(self, name, schema):
        return Counted()

    def __getattribute__(self, name):
        found = super().__getattribute__(name)
        if callable(found) and name not in ("getValueState", "getMapState"):
            Counted.calls[name] += 1
        return found


@pytest.mark.parametrize("rows", [200, 20_000])
def test_calls_of_a_detector_do_not_grow_with_rows(rows):
    """A row a minute of one key in one micro-batch: a few calls, and a few for every 256 rows."""
    state, columns = Counted(), ["key", "first_us", "last_us", "first_tie", "last_tie", "n", "tag"]
    machine = processors.InOrder(processors.OrderState(span("5 minutes")), columns, span("1 minute"), processors.MOST)
    machine.init(state)
    Counted.calls.clear()
    minute = span("1 minute")
    events = [Row(us=(k + 1) * minute, side=k % 2, tie=k, kind=k % 2) for k in range(rows)]
    # Out of order within the micro-batch.
    assert list(machine.handleInputRows((1,), iter(events[::2] + events[1::2]), Watermark(0))) == []
    found = list(machine.handleExpiredTimer((1,), Watermark((rows + 1) * 60_000), None))
    assert [(r.first_tie, r.last_tie, r.tag) for r in found] == [(k, k + 1, "paid") for k in range(0, rows, 2)]
    assert sum(Counted.calls.values()) <= 10 + 4 * rows / processors.MOST


@pytest.mark.parametrize("most", [1, 3, 256])
def test_waiting_rows_beside_the_state_or_in_entries(spark, fed, monkeypatch, most):  # noqa: F811
    """Rows that come up to two minutes early or late, over many micro-batches."""
    monkeypatch.setattr(processors, "MOST", most)
    events = [(k % 3, k * 10, k, ["create", "pay", "create"][k * 7 % 3]) for k in range(120)]
    arrived = sorted(events, key=lambda e: e[1] + e[2] * 7919 % 120)
    stream = fed([arrived[k : k + 30] for k in range(0, 120, 30)], "2 minutes")
    rows = detected(stream, kind_number("create", "pay"), processors.Pairing(us(45), ("both", "left", "right")), spark)
    got = []
    for r in rows:
        ties = [None, None]
        for tie in {r.first_tie, r.last_tie}:
            ties[["create", "pay"].index(events[tie][3])] = tie
        got.append((r.key, *ties, {"left": "left_only", "right": "right_only", "both": "matched"}[r.tag]))
    want = brute.reconcile([(k, t, i, int(kind == "pay")) for k, t, i, kind in events], 45)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_keys_of_a_click_limit_share_a_state():
    """Thousands of keys with few rows a day: one value and one timer, and each key's own first rows."""
    Counted.calls.clear()
    state, names = Counted(), ["key0", "none0"]
    first = limits.FirstRows(["day", *names, "at", "us", "tie", "late"], 0, 3, names)
    first.handle = first.kept = state
    second = 1_000_000
    rows = pd.DataFrame(
        [(k % 3000 - 1, k % 3000 == 0, (k % 7 + 1) * second, k) for k in range(15_000)],
        columns=[*names, "us", "tie"],
    ).assign(day=0, part=1)
    batches = [rows[k : k + 4000] for k in range(0, 15_000, 4000)]
    assert list(first.handleInputRows((0, 1), iter(batches[:2]), Watermark(0))) == []
    handed = list(first.handleExpiredTimer((0, 1), Watermark(4000), None))
    assert list(first.handleInputRows((0, 1), iter(batches[2:]), Watermark(4000)))[0]["late"].all()
    handed += list(first.handleExpiredTimer((0, 1), Watermark(9000), None))
    assert sum(Counted.calls.values()) <= 25
    settled = pd.concat([rows[:8000], rows[8000:][rows["us"][8000:] > 4 * second]]).sort_values(["us", "tie"])
    want = settled.groupby(names).head(3)
    assert sorted(pd.concat(handed)["tie"]) == sorted(want["tie"])

    last, found = limits.Numbered(["day", *names, "us", "tie", "tag"], 0, 3, names), []
    last.handle = last.kept = Counted()
    for part in handed:
        found += list(last.handleInputRows((0, 2), iter([part]), Watermark(0)))
    tags = pd.concat(found).set_index("tie")["tag"]
    nth = want.groupby(names).cumcount()
    assert {t: tags[t] for t in want["tie"]} == {t: "warning" if n == 2 else "pass" for t, n in zip(want["tie"], nth)}
