"""Batch operators against plain loops, on random streams with ties, bursts and hot keys.

Buckets are a few events long here, so most neighbours lie in other buckets.
"""

from __future__ import annotations

import random

import brute
import pytest
from conftest import at, secs, stream_rows
from pyspark.sql import functions as F

from eddyline.operators import (
    blacklist, distinct, joins, late, logins, orders, patterns, timeline,
)
from eddyline.operators.patterns import Step

KINDS = ["create", "pay", "other"]


def random_events(seed: int, count: int = 300, span: int = 400):
    """(key, second, tie, kind); key 0 holds a good third of all rows; many equal times."""
    rng = random.Random(seed)
    keys = [0, 0, 0, 1, 2, 3, 4]
    events = []
    for tie in range(count):
        # Bursts of events a second apart between quiet stretches.
        t = rng.choice([rng.randrange(span), 100 + rng.randrange(30)])
        events.append((rng.choice(keys), t, tie, rng.choice(KINDS)))
    return events


def frame(spark, events):
    return stream_rows(
        spark, [(k, at(t), tie, kind) for k, t, tie, kind in events],
        "key long, ts timestamp_ntz, tie long, kind string",
    )


def is_kind(kind):
    return F.col("kind") == kind


@pytest.mark.parametrize("seed", range(4))
def test_failure_windows(spark, seed):
    events = random_events(seed, count=500)
    got = logins.failure_windows(frame(spark, events), ["key"], "ts", is_kind("create"), "3 seconds")
    want = brute.failure_windows([(k, t, kind == "create") for k, t, _, kind in events], 3)
    assert sorted((r.key, secs(r.first_ts), secs(r.last_ts), r.n_fail) for r in got.collect()) == want


def test_failure_windows_in_one_long_run(spark):
    """A failure every second for half an hour: hundreds of windows, each opened by the last."""
    events = [(7, t, t, "create") for t in range(1800)]
    got = logins.failure_windows(frame(spark, events), ["key"], "ts", is_kind("create"), "2 seconds")
    want = brute.failure_windows([(7, t, True) for t in range(1800)], 2)
    assert len(want) == 600
    assert sorted((r.key, secs(r.first_ts), secs(r.last_ts), r.n_fail) for r in got.collect()) == want


@pytest.mark.parametrize("seed", range(2))
def test_failure_pairs(spark, seed):
    events = random_events(seed)
    got = logins.failure_pairs(frame(spark, events), ["key"], "ts", "tie", is_kind("create"), "2 seconds")
    want = brute.failure_pairs([(k, t, i, kind == "create") for k, t, i, kind in events], 2)
    assert sorted((r.key, secs(r.first_ts), secs(r.last_ts)) for r in got.collect()) == want


STEPS = {
    "create": lambda v: v == "create",
    "pay": lambda v: v == "pay",
    "other": lambda v: v == "other",
}


@pytest.mark.parametrize("names", [["create", "create"], ["create", "pay", "other"]])
@pytest.mark.parametrize("within", [None, 5])
@pytest.mark.parametrize("keyed", [True, False])
def test_strict_sequence(spark, names, within, keyed):
    events = random_events(11)
    steps = [Step(f"s{i}", is_kind(n)) for i, n in enumerate(names)]
    got = patterns.strict_sequence(
        frame(spark, events), ["key"] if keyed else [], "ts", ["tie"], steps, ["key", "tie"],
        within and f"{within} seconds", bucket="10 seconds",
    )
    fed = [(k if keyed else 0, t, i, kind) for k, t, i, kind in events]
    want = brute.strict_sequence(fed, [STEPS[n] for n in names], within)
    ties = [f"s{i}" for i in range(len(names))]
    assert sorted(tuple(r[s].tie for s in ties) for r in got.collect()) == sorted(w[1:] for w in want)


@pytest.mark.parametrize("times", [2, 4])
def test_loop(spark, times):
    events = random_events(5)
    got = patterns.loop(
        frame(spark, events), ["key"], "ts", ["tie"], is_kind("create"), times, ["tie"]
    )
    want = brute.strict_sequence(events, [STEPS["create"]] * times)
    assert sorted(tuple(c.tie for c in r) for r in got.collect()) == [w[1:] for w in sorted(want, key=lambda w: w[1:])]


@pytest.mark.parametrize("slot", [None, "10 seconds", "1 second", "1 hour"])
@pytest.mark.parametrize("names", [["create", "pay"], ["create", "other", "pay"], ["pay", "pay", "create", "other"]])
def test_relaxed_sequence(spark, names, slot):
    events = random_events(21)
    steps = [Step(f"s{i}", is_kind(n)) for i, n in enumerate(names)]
    got = patterns.relaxed_sequence(
        frame(spark, events), ["key"], "ts", ["tie"], steps, ["key", "tie"], "15 seconds",
        bucket="10 seconds", slot=slot,
    )
    ties = [f"s{i}" for i in range(len(names))]
    rows = [(r.s0.key, *[r[s] and r[s].tie for s in ties], r.tag) for r in got.collect()]
    assert sorted(rows, key=str) == brute.relaxed_sequence(events, [STEPS[n] for n in names], 15)


@pytest.mark.parametrize("slot", [None, "4 seconds", "1 hour"])
@pytest.mark.parametrize("seed", range(3))
def test_order_states(spark, seed, slot):
    events = random_events(seed)
    got = orders.order_states(
        frame(spark, events), "key", "ts", "tie", is_kind("create"), is_kind("pay"), "15 seconds",
        slot=slot,
    )
    assert sorted((r.key, secs(r.ts), r.tie, r.tag) for r in got.collect()) == brute.order_states(events, 15)


@pytest.mark.parametrize("seed, slot", [(0, None), (1, None), (2, "7 seconds"), (3, "1 second"), (0, "1 hour")])
def test_reconcile(spark, seed, slot):
    """Repeated keys make chains of rows, each near the next, that run over many buckets."""
    events = [e for e in random_events(seed, count=400, span=900) if e[3] != "other"]
    events += [(9, 2 * t, 1000 + t, KINDS[t % 2]) for t in range(200)]
    df = frame(spark, events)
    side = lambda kind, name: df.where(is_kind(kind)).select(
        "key", F.col("ts").alias(f"{name}_ts"), F.col("tie").alias(f"{name}_id")
    )
    got = joins.reconcile(
        side("create", "left"), side("pay", "right"), ["key"], "left_ts", "right_ts",
        "5 seconds", "left_id", "right_id", ("matched", "left_only", "right_only"), slot=slot,
    ).cache()
    fed = [(k, t, i, KINDS.index(kind)) for k, t, i, kind in events]
    rows = [(r.key, r.left_id, r.right_id, r.tag) for r in got.collect()]
    assert sorted(rows, key=str) == brute.reconcile(fed, 5)
    # Every input row is in exactly one result row.
    ids = [i for r in rows for i in r[1:3] if i is not None]
    assert sorted(ids) == sorted(e[2] for e in events)


@pytest.mark.parametrize("ends", [(True, True), (False, False), (True, False)])
def test_interval_join(spark, ends):
    events = random_events(3)
    df = frame(spark, events)
    pick = lambda kind, name: df.where(is_kind(kind)).select(
        "key", F.col("ts").alias(f"{name}_ts"), F.col("tie").alias(f"{name}_id")
    )
    got = joins.interval_join(
        pick("create", "l"), pick("pay", "r"), ["key"], "l_ts", "r_ts", "3 seconds", "5 seconds", *ends
    )
    part = lambda kind: [e[:3] for e in events if e[3] == kind]
    want = brute.interval_pairs(part("create"), part("pay"), 3, 5, *ends)
    assert sorted((r.key, r.l_id, r.r_id) for r in got.collect()) == want


@pytest.mark.parametrize("how", ["left", "full"])
def test_outer_interval_join(spark, how):
    """Repeated keys, bounds met exactly, keys and partners over bucket edges, null keys."""
    events = [(None if k == 4 else k, t, i, kind) for k, t, i, kind in random_events(6)]
    df = frame(spark, events)
    pick = lambda kind, name: df.where(is_kind(kind)).select(
        "key", F.col("ts").alias(f"{name}_ts"), F.col("tie").alias(f"{name}_id")
    )
    got = joins.outer_interval_join(
        pick("create", "l"), pick("pay", "r"), ["key"], "l_ts", "r_ts", "1 second", "2 seconds", how
    )
    rows = [(r.key, r.l_id, r.r_id) for r in got.collect()]
    part = lambda kind: [e[:3] for e in events if e[3] == kind]
    assert sorted(rows, key=str) == brute.outer_pairs(part("create"), part("pay"), 1, 2, how)
    assert any(r[1] is None for r in rows) == (how == "full") and any(r[2] is None for r in rows)


@pytest.mark.parametrize("limit", [3, 40])
def test_click_filter(spark, limit):
    """Both ways of numbering: cut map-side, and counted hour by hour beyond Spark's cut."""
    rng = random.Random(limit)
    events = [(rng.choice([0, 0, 1, 2]), rng.randrange(2 * 86400), i) for i in range(600)]
    base = 1709251200  # 2024-03-01, a whole day
    df = stream_rows(spark, [(k, at(t), i) for k, t, i in events], "key long, ts timestamp_ntz, tie long")
    want = brute.click_filter([(k, base + t, i) for k, t, i in events], limit)
    for cut in ("1000", "2"):
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", cut)
        try:
            got = blacklist.click_filter(df, ["key"], "ts", "tie", limit)
            assert sorted((r.key, r.tie, r.tag) for r in got.collect()) == want
        finally:
            spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_running_distinct(spark):
    rng = random.Random(1)
    events = [(rng.randrange(20), rng.randrange(7200), i) for i in range(800)]
    df = stream_rows(spark, [(v, at(t), i) for v, t, i in events], "value long, ts timestamp_ntz, tie long")
    got = distinct.running_distinct(df, "ts", "tie", "1 hour", F.col("value"), ["tie"])
    assert sorted((r.tie, r.uv) for r in got.collect()) == brute.running_distinct(events, 3600)


@pytest.mark.parametrize("seed", range(2))
def test_late_replay(spark, seed):
    rng = random.Random(seed)
    events = []
    for i in range(400):
        t = rng.randrange(3000)
        events.append((rng.choice("aab"), t, t + rng.choice([0, 0, 5, 300, 900]), i))
    df = stream_rows(
        spark, [(k, at(t), at(a), i) for k, t, a, i in events],
        "key string, ts timestamp_ntz, arrival timestamp_ntz, tie long",
    )
    args = (df, "ts", "arrival", "tie", "1 minute", "10 seconds")
    final, first, late_ties = brute.late_replay(events, 60, 10, 20, 120)
    counts = late.late_sliding_counts(*args, ["key"], "20 seconds", "120 seconds")
    assert {(r.key, secs(r.window_end)): r.cnt for r in counts.collect()} == final
    rows = late.late_rows(*args, "20 seconds", "120 seconds")
    assert sorted(r.tie for r in rows.collect()) == late_ties
    fixes = late.late_corrections(*args, ["key"], "20 seconds", "120 seconds")
    want = {k: (first.get(k, 0), n) for k, n in final.items() if first.get(k, 0) != n}
    assert {(r.key, secs(r.window_end)): (r.first_cnt, r.final_cnt) for r in fixes.collect()} == want


def test_following_over_empty_slots(spark):
    """The next rows may be many slots away, and several slots may hold one row each."""
    events = [(1, t, i, "create") for i, t in enumerate([0, 1, 50, 51, 52, 400, 900])]
    got = timeline.following(
        frame(spark, events), ["key"], "ts", ["ts", "tie"], "tie", 3, 10_000_000
    )
    nexts = {r.tie: r["_next"] for r in got.collect()}
    assert nexts == {i: list(range(i + 1, min(i + 4, 7))) for i in range(7)}


def test_null_keys_and_times(spark):
    side = lambda rows, name: spark.createDataFrame(
        rows, f"key long, {name}_ts timestamp_ntz, {name}_id long"
    )
    # A pay 2 s before its receipt, over the edge of a bucket of 40 s, both without a key.
    edge = 40 * 1000
    left, right = side([(None, at(edge - 1), 1)], "pay"), side([(None, at(edge + 1), 2)], "receipt")
    for cut in ({"bucket_size": "40 seconds"}, {"bucket_size": "1 second"}, {"slot": "40 seconds"}, {"slot": "1 second"}):
        got = joins.reconcile(
            left, right, ["key"], "pay_ts", "receipt_ts", "5 seconds", "pay_id", "receipt_id", **cut
        )
        assert [(r.pay_id, r.receipt_id, r.tag) for r in got.collect()] == [(1, 2, "matched")]
    rows = spark.createDataFrame([(1, None, 1, "create")], "key long, ts timestamp_ntz, tie long, kind string")
    created = F.col("kind") == "create"
    with pytest.raises(Exception, match="must not be null"):
        orders.order_states(rows, "key", "ts", "tie", created, ~created, "1 hour").collect()


def test_slots_cut_a_busy_key_without_copies(spark):
    """One key only: the pieces grow with the slots asked for, and each row is in one of them."""
    rng = random.Random(8)
    events = [(1, t, i, rng.choice(["fail", "fail", "pass"])) for i, t in enumerate(sorted(rng.randrange(4000) for _ in range(500)))]
    df = frame(spark, events)
    failed = F.col("kind") == "fail"
    args = (df, ["key"], "ts", ["tie"], [Step("a", failed), Step("b", failed)], ["tie"], "30 seconds")
    want = sorted((r.a.tie, r.b.tie) for r in patterns.strict_sequence(*args).collect())
    assert want
    for slot in ("2000 seconds", "100 seconds", "7 seconds"):
        got = patterns.strict_sequence(*args, slot=slot)
        assert sorted((r.a.tie, r.b.tie) for r in got.collect()) == want
    for seconds in (2000, 100):
        slotted = df.withColumn("s", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / seconds))
        spread = slotted.repartition(64, "key", "s").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in spread) == len(events)
        assert len(spread) >= min(25, 4000 // seconds)


def test_slots_of_ordered_work_hold_each_row_once(spark):
    """No form in slots copies a row, and what is put in key order is a row per slot."""
    events = [(1, t, t, KINDS[t % 2]) for t in range(600)]
    df = frame(spark, events)
    for seconds in (300, 20, 2):
        found = timeline.neighbours(df, ["key"], "ts", ["ts", "tie"], seconds * 1_000_000)
        rows = found.select("tie", "_prev.tie", "_next.tie", timeline.BUCKET).collect()
        assert sorted((r[0], r[1], r[2]) for r in rows) == [
            (t, t - 1 if t else None, t + 1 if t < 599 else None) for t in range(600)
        ]
        assert len({r[3] for r in rows}) == 600 // seconds
