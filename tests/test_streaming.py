"""Streams fed file by file, one micro-batch each."""

from __future__ import annotations

import datetime as dt
import os
import random
import time
from collections import Counter, defaultdict

import brute
import pandas as pd
import pytest
from conftest import at, secs, stream_rows
from pyspark.sql import Row
from pyspark.sql import functions as F

from eddyline.functions.times import span
from eddyline.operators import distinct, joins, salting, windows
from eddyline.sources import market
from eddyline.streaming import filters, firings, leaders, limits, processors, queries, runs, sinks

DDL = "key long, ts timestamp_ntz, tie long, kind string"
FLUSH = (-1, 10_000_000, -1, "flush")


@pytest.fixture
def fed(spark, tmp_path):
    """A stream over batches of rows; ``flush`` appends a far-future row in a last batch."""

    def feed(batches, delay="1 millisecond", flush=True):
        folder = tmp_path / "in"
        batches = list(batches) + ([[FLUSH]] if flush else [])
        for i, rows in enumerate(batches):
            part = stream_rows(spark, [(k, at(t), tie, kind) for k, t, tie, kind in rows], DDL)
            part.coalesce(1).write.parquet(str(folder / f"b={i:03d}"))
            for file in (folder / f"b={i:03d}").glob("*.parquet"):
                # The file source takes files by age.
                os.utime(file, (1_000_000 + i, 1_000_000 + i))
        stream = (
            spark.readStream.schema(DDL)
            .option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .parquet(str(folder))
        )
        stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        return stream.withWatermark("ts", delay) if delay else stream

    return feed


def shuffled_batches(seed, count=240, span_s=300, batches=4, disorder=0):
    """Events in time order up to ``disorder`` seconds, cut into batches."""
    rng = random.Random(seed)
    kinds = ["create", "pay", "other"]
    times = sorted(rng.randrange(span_s) for _ in range(count))
    events = [(rng.choice([0, 0, 0, 1, 2, 3]), t, i, rng.choice(kinds)) for i, t in enumerate(times)]
    arrived = sorted(events, key=lambda e: e[1] + rng.uniform(0, disorder))
    size = -(-count // batches)
    return events, [arrived[i : i + size] for i in range(0, count, size)]


def detected(stream, kind, detector, spark, side=None, bound=None, keys=("key",)):
    found = processors.detect(stream, keys, "ts", "tie", kind, detector, side, bound)
    if not keys:
        return runs.collected(found, "detected").collect()
    return runs.collected(found, "detected").where("key >= 0").collect()


def us(seconds):
    return span("1 second") * seconds


def start(row_us):
    return secs(dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=row_us))


def kind_number(*names):
    number = F.lit(None).cast("int")
    for i, name in enumerate(names):
        number = F.when(F.col("kind") == name, i).otherwise(number)
    return number


@pytest.mark.parametrize("disorder", [0, 5])
def test_order_state(spark, fed, disorder):
    events, batches = shuffled_batches(1, disorder=disorder)
    stream = fed(batches, f"{disorder} seconds" if disorder else "1 millisecond")
    stream = stream.where("kind IN ('create', 'pay', 'flush')")
    # With disorder the state is also split by time buckets.
    bound = us(15) if disorder else None
    rows = detected(
        stream, kind_number("create", "pay"), processors.OrderState(us(15)), spark, bound=bound
    )
    got = sorted((r.key, start(r.last_us), r.last_tie, r.tag) for r in rows)
    assert got == brute.order_states(events, 15)


@pytest.mark.parametrize("times, within, keyed", [(2, 3, True), (2, 3, False), (3, None, True)])
def test_strict_run(spark, fed, times, within, keyed):
    events, batches = shuffled_batches(8)
    run = processors.StrictRun(times, within and us(within))
    rows = detected(
        fed(batches), (F.col("kind") == "create").cast("int"), run, spark, F.lit(0),
        within and us(within), ["key"] if keyed else [],
    )
    fed_events = [(k if keyed else 0, t, i, kind) for k, t, i, kind in events]
    want = brute.strict_sequence(fed_events, [lambda v: v == "create"] * times, within)
    assert sorted((r.first_tie, r.last_tie) for r in rows) == sorted((w[1], w[-1]) for w in want)


def test_followed_by(spark, fed):
    events, batches = shuffled_batches(2)
    stream = fed(batches).where("kind IN ('create', 'pay', 'flush')")
    rows = detected(
        stream, kind_number("create", "pay"), processors.FollowedBy(us(15)), spark, bound=us(15)
    )
    got = sorted(((r.key, r.first_tie, r.last_tie, r.tag) for r in rows), key=str)
    tests = [lambda v: v == "create", lambda v: v == "pay"]
    # At equal times the state machine takes creates before payments.
    ordered = [(k, t, (kind == "pay", i), kind) for k, t, i, kind in events]
    want = brute.relaxed_sequence(ordered, tests, 15)
    plain = [(k, a[1], b and b[1], tag) for k, a, b, tag in want]
    assert got == sorted(plain, key=str)


def test_reconcile(spark, fed):
    events, batches = shuffled_batches(3, span_s=500)
    stream = fed(batches).where("kind IN ('create', 'pay', 'flush')")
    tags = ("matched", "left_only", "right_only")
    rows = detected(stream, kind_number("create", "pay"), processors.Pairing(us(5), tags), spark)
    sides = {i: (0 if kind == "create" else 1) for _, _, i, kind in events}
    got = []
    for r in rows:
        ties = [None, None]
        for tie in {r.first_tie, r.last_tie}:
            ties[sides[tie]] = tie
        got.append((r.key, *ties, r.tag))
    fed_events = [(k, t, i, sides[i]) for k, t, i, kind in events if kind != "other"]
    assert sorted(got, key=str) == brute.reconcile(fed_events, 5)


def test_failure_window(spark, fed):
    events, batches = shuffled_batches(4, count=300)
    failed = (F.col("kind") == "create").cast("int")
    rows = detected(
        fed(batches), failed, processors.FailureWindow(us(3)), spark, side=1 - failed
    )
    got = sorted((r.key, start(r.first_us), start(r.last_us), r.n) for r in rows)
    assert got == brute.failure_windows([(k, t, kind == "create") for k, t, _, kind in events], 3)


@pytest.mark.parametrize("shares", [1, 4])
def test_click_limit(spark, fed, shares):
    rng = random.Random(5)
    clicks = sorted((rng.randrange(2 * 86400), rng.choice([1, 1, 2])) for _ in range(200))
    events = [(k, t, i, "click") for i, (t, k) in enumerate(clicks)]
    events += [(None, 2 * 86400 + i // 2, 200 + i, "click") for i in range(30)]
    # Up to ten minutes out of order within what the watermark allows, and one row behind it.
    arrived = sorted(events, key=lambda e: e[1] + rng.uniform(0, 600))
    batches = [arrived[:90], arrived[90:150], [*arrived[150:], (7, 10, 999, "click")]]
    found = limits.click_limit(fed(batches, "10 minutes"), ["key"], "ts", "tie", 20, shares)
    rows = [(r.key, r.tie, r.tag) for r in runs.collected(found, "limited").collect() if r.key != -1]
    base = 1709251200
    want = brute.click_filter([(-5 if k is None else k, base + t, i) for k, t, i, _ in events], 20)
    want = [(None if k == -5 else k, i, tag) for k, i, tag in want] + [(7, 999, limits.LATE)]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_state_of_a_click_limit_is_bounded():
    """A bot's clicks: a share holds and hands on limit + 1 rows of a day, and forgets the day behind it."""
    state = FakeState()
    stage = limits.FirstRows(["key0", "day", "at", "us", "tie", "late"], 1, 4)
    stage.handle = stage.kept = state
    handed, second = [], 1_000_000
    for batch in range(6):
        rows = pd.DataFrame({"us": [batch * 100 * second + (k % 50 + 1) * second for k in range(500)], "tie": range(500)})
        key = (1, 0, 0)
        assert list(stage.handleInputRows(key, iter([rows[:200], rows[200:]]), Watermark(batch * 100 * 1000))) == []
        assert len(state.value[0]) == max(0, 4 - len(handed))
        state.timers.clear()
        handed += [r for out in stage.handleExpiredTimer(key, Watermark((batch + 1) * 100 * 1000), None) for r in out["tie"]]
    assert handed == [0, 50, 100, 150]
    (late,) = stage.handleInputRows((1, 0, 0), iter([rows[:3]]), Watermark(10**9))
    assert late["late"].all() and len(late) == 3
    list(stage.handleExpiredTimer((1, 0, 0), Watermark(limits._day_end(0)), None))
    assert not state.exists()


def test_windows_agree_with_batch(spark, fed):
    events, batches = shuffled_batches(6, disorder=5)
    stream = fed(batches, "5 seconds")
    sliding = windows.sliding_counts(stream, "ts", "60 seconds", "10 seconds", ["key"], how=windows.sliding_chained)
    got = runs.collected(sliding, "sliding").where("key >= 0").collect()
    want = Counter()
    for key, t, _, _ in events:
        for i in range(6):
            want[(key, t // 10 * 10 + 10 * (i + 1))] += 1
    assert {(r.key, secs(r.window_end)): r.cnt for r in got} == want

    salted = salting.salted_counts(stream, "ts", "60 seconds", salting.salt(["tie"]))
    hours = Counter(t // 60 * 60 + 60 for _, t, _, _ in events)
    rows = runs.collected(salted, "salted").collect()
    assert {secs(r.window_end): r.pv for r in rows} == hours

    users = defaultdict(set)
    for key, t, _, _ in events:
        users[t // 60 * 60 + 60].add(key)
    unique = runs.collected(queries.distinct_per_window(stream, "ts", "60 seconds", "key"), "uv")
    assert {secs(r.window_end): r.uv for r in unique.collect()} == {w: len(u) for w, u in users.items()}


def test_interval_join_of_two_streams(spark, fed):
    events, batches = shuffled_batches(7)
    stream = fed(batches)
    pick = lambda kind, name: stream.where(F.col("kind") == kind).select(
        "key", F.col("ts").alias(f"{name}_ts"), F.col("tie").alias(f"{name}_id")
    )
    pairs = joins.interval_join(
        pick("create", "l"), pick("pay", "r"), ["key"], "l_ts", "r_ts", "3 seconds", "5 seconds"
    )
    got = runs.collected(pairs, "pairs").collect()
    part = lambda kind: [e[:3] for e in events if e[3] == kind]
    assert sorted((r.key, r.l_id, r.r_id) for r in got) == brute.interval_pairs(part("create"), part("pay"), 3, 5)


def test_outer_interval_join_of_two_streams(spark, fed):
    """A lone row comes out once, when no partner can follow, though partners come batches later."""
    events, batches = shuffled_batches(12)
    stream = fed(batches)
    pick = lambda kind, name: stream.where((F.col("kind") == kind) | (F.col("kind") == "flush")).select(
        "key", F.col("ts").alias(f"{name}_ts"), F.col("tie").alias(f"{name}_id")
    )
    both = joins.outer_interval_join(
        pick("create", "l"), pick("pay", "r"), ["key"], "l_ts", "r_ts", "1 second", "2 seconds"
    )
    got = runs.collected(both, "outer").where("key >= 0").collect()
    part = lambda kind: [e[:3] for e in events if e[3] == kind]
    want = brute.outer_pairs(part("create"), part("pay"), 1, 2, "full")
    assert sorted(((r.key, r.l_id, r.r_id) for r in got), key=str) == want


def test_leaders_of_closing_windows(spark, fed):
    """Ties, a null key, disorder over batches, and fewer keys than places."""
    rng = random.Random(11)
    events = [(t, rng.choice([None, *range(12)]), i) for i, t in enumerate(sorted(rng.randrange(300) for _ in range(400)))]
    events += [(330, 5, 400), (340, 3, 401)]
    events = [(k, t, i, "v") for t, k, i in events]
    arrived = sorted(events, key=lambda e: e[1] + rng.uniform(0, 5))
    batches = [arrived[i : i + 101] for i in range(0, len(arrived), 101)]
    stream = fed(batches, "5 seconds")
    counts = Counter((t // 30 * 30 + 30 * (j + 1), k) for k, t, _, _ in events for j in range(2))
    want = []
    for end in sorted({end for end, _ in counts}):
        ranked = sorted((-n, k is not None, k or 0) for (e, k), n in counts.items() if e == end)
        want += [(end, rk, k if known else None, -n) for rk, (n, known, k) in enumerate(ranked[:4], 1)]
    for shares in (1, 3):
        found = leaders.closed_top_n(stream, "ts", "1 minute", "30 seconds", "key", 4, shares)
        rows = runs.collected(found, "leaders").where("key >= 0 OR key IS NULL").collect()
        assert sorted((secs(r.window_end), r.rk, r.key, r.cnt) for r in rows) == want
    named = stream.withColumn("key", F.concat(F.lit("k"), F.col("key").cast("string")))
    rows = runs.collected(leaders.closed_top_n(named, "ts", "1 minute", "30 seconds", "key", 1), "named")
    assert {r.key for r in rows.collect() if r.key} <= {f"k{k}" for k in range(-1, 12)}


def test_state_of_leaders_is_bounded():
    """However many keys a window has, its list is n entries; a stretch has one timer."""
    state = FakeState()
    stage = leaders.Leaders(3, "bigint", ranked=True)
    stage.handle = stage.kept = state
    ends = {60_000_000: 0, 120_000_000: 1}
    for end, more in reversed(ends.items()):
        rows = pd.DataFrame({"end_us": end, "none": False, "key": range(1000), "cnt": [(k * 7) % 1000 + more for k in range(1000)]})
        assert list(stage.handleInputRows((0, 0), iter([rows[:500], rows[500:]]), None)) == []
    assert [len(column) for column in state.value[:-1]] == [6] * 4
    assert state.timers == {60_000}
    for end, more in ends.items():
        state.timers.clear()
        (out,) = stage.handleExpiredTimer((0,), Watermark(end // 1000), None)
        assert out["cnt"].tolist() == [999 + more, 998 + more, 997 + more] and out["rk"].tolist() == [1, 2, 3]
    assert not state.exists() and not state.timers


def test_top_n_is_corrected_and_changes_add_up(spark, fed, tmp_path):
    # The second batch lifts key 2 over key 1 in the first minute; the third opens a new window.
    batches = [
        [(1, 1, 0, "v"), (1, 2, 1, "v"), (2, 3, 2, "v"), (3, 4, 3, "v")],
        [(2, 5, 4, "v"), (2, 6, 5, "v")],
        [(3, 70, 6, "v")],
    ]
    stream = fed(batches, "30 seconds", flush=False)
    counts = windows.sliding_counts(stream, "ts", "1 minute", "1 minute", ["key"], how=windows.sliding_rows)
    table = sinks.TopNTable(spark, str(tmp_path / "top"), "key", 2)
    runs.each_batch(counts, table, str(tmp_path / "checkpoint"), "update")
    current = sorted((secs(r.window_end), r.rk, r.key, r.cnt) for r in table.current().collect())
    assert current == [(60, 1, 2, 3), (60, 2, 1, 2), (120, 1, 3, 1)]
    changes = table.changes().collect()
    by_batch = defaultdict(list)
    for r in changes:
        by_batch[r.batch_id].append((r.op, secs(r.window_end), r.rk, r.key, r.cnt))
    assert sorted(by_batch[0]) == [("+", 60, 1, 1, 2), ("+", 60, 2, 2, 1)]
    assert sorted(by_batch[1]) == [
        ("+", 60, 1, 2, 3), ("+", 60, 2, 1, 2), ("-", 60, 1, 1, 2), ("-", 60, 2, 2, 1),
    ]
    net = Counter()
    for r in changes:
        net[(secs(r.window_end), r.rk, r.key, r.cnt)] += 1 if r.op == "+" else -1
    assert sorted(k for k, n in net.items() if n) == current


def test_closed_top_n(spark, fed, tmp_path):
    batches = [[(1, 1, 0, "v"), (1, 2, 1, "v"), (2, 3, 2, "v"), (3, 4, 3, "v")], [(2, 65, 4, "v")]]
    counts = windows.sliding_counts(fed(batches), "ts", "1 minute", "30 seconds", ["key"], how=windows.sliding_chained)
    table = sinks.ClosedTopN(str(tmp_path / "rows"), "key", 1)
    runs.each_batch(counts, table, str(tmp_path / "checkpoint"), "append")
    rows = spark.read.parquet(str(tmp_path / "rows")).where("key >= 0").collect()
    assert sorted((secs(r.window_end), r.key, r.cnt) for r in rows) == [
        (30, 1, 2), (60, 1, 2), (90, 2, 1), (120, 2, 1),
    ]


def test_late_rows_and_corrections(spark, fed, tmp_path):
    """Windows of 10 min / 5 s, 1 s of disorder, 60 s of lateness."""
    batches = [
        [(1, 1000, 0, "GET")],
        [(1, 999, 1, "GET"), (1, 945, 2, "GET")],  # late for some windows, not for all
        [(1, 1700, 3, "GET")],
        [(1, 1035, 4, "GET"), (1, 1045, 5, "GET")],  # last windows end 1635 and 1645; bound 1639
    ]
    router = sinks.LateRouter(
        spark, str(tmp_path / "late"), "ts", "10 minutes", "5 seconds", "1 second", "60 seconds"
    )
    stream = fed(batches, delay=None, flush=False)
    runs.each_batch(stream, router, str(tmp_path / "checkpoint"), "append")
    assert [r.tie for r in router.rows("late").collect()] == [4]
    assert sorted(r.tie for r in router.rows("on_time").collect()) == [0, 1, 2, 3, 5]


def test_tag_tables(spark, fed, tmp_path):
    stream = fed([[(1, 1, 0, "paid"), (2, 2, 1, "timeout")], [(3, 3, 2, "paid")]], flush=False)
    tables = sinks.TagTables(str(tmp_path / "tags"), "kind")
    runs.each_batch(stream, tables, str(tmp_path / "checkpoint"), "append")
    assert sorted(r.key for r in tables.read(spark, "paid").collect()) == [1, 3]
    assert [r.key for r in tables.read(spark, "timeout").collect()] == [2]


def test_late_rows_correct_a_closed_window(spark, fed, tmp_path):
    """Bound 1 s, lateness 60 s: a row 80 s behind still counts, one 170 s behind does not."""
    batches = [
        [(1, 10, 0, "GET"), (2, 11, 1, "GET")],
        [(1, 100, 2, "GET")],
        [(2, 20, 3, "GET")],
        [(1, 200, 4, "GET")],
        [(1, 205, 6, "GET")],  # rows are held against the watermark of the batch before
        [(1, 30, 5, "GET")],
    ]
    stream = fed(batches, delay=None, flush=False)
    counts = queries.late_sliding_counts(
        stream, "ts", "1 minute", "1 minute", ["key"], "1 second", "60 seconds"
    )
    table = sinks.TopNTable(spark, str(tmp_path / "top"), "key", 1)
    runs.each_batch(counts, table, str(tmp_path / "checkpoint"), "update")
    current = sorted((secs(r.window_end), r.key, r.cnt) for r in table.current().collect())
    assert current == [(60, 2, 2), (120, 1, 1), (240, 1, 2)]
    first_window = [r for r in table.changes().collect() if secs(r.window_end) == 60]
    assert sorted((r.batch_id, r.op, r.key, r.cnt) for r in first_window)[0][1:] == ("+", 1, 1)
    assert ("+", 2, 2) in [(r.op, r.key, r.cnt) for r in first_window]
    assert ("-", 1, 1) in [(r.op, r.key, r.cnt) for r in first_window]


def test_bitmap_pieces_are_brought_up_to_date(spark, fed, tmp_path):
    batches = [[(5, 1, 0, "v"), (6, 2, 1, "v"), (5, 3, 2, "v")], [(6, 4, 3, "v"), (7, 70, 4, "v"), (8, 5, 5, "v")]]
    stream = fed(batches, "1 minute", flush=False)
    pieces = queries.bitmap_pieces(stream, "ts", "1 minute", F.col("key"))
    table = sinks.WindowValues(spark, str(tmp_path / "pieces"), "piece", "bits")
    runs.each_batch(pieces, table, str(tmp_path / "checkpoint"), "update")
    first = distinct.bitmap_counts(table.latest(upto=0)).collect()
    assert [(secs(r.window_end), r.uv) for r in first] == [(60, 2)]
    counts = distinct.bitmap_counts(table.latest()).collect()
    assert sorted((secs(r.window_end), r.uv) for r in counts) == [(60, 3), (120, 1)]


def test_generated_stream_and_console(spark, tmp_path):
    made = market.market_stream(spark, rows_per_second=50)
    query = made.writeStream.format("memory").queryName("made").outputMode("append").start()
    try:
        deadline = time.time() + 60
        while spark.table("made").count() < 20 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    rows = spark.table("made").collect()
    assert len(rows) >= 20 and {r.behavior for r in rows} <= set(market.BEHAVIORS)

    folder = str(tmp_path / "lines")
    spark.createDataFrame([("hello",)], "word string").write.parquet(folder)
    words = spark.readStream.schema("word string").parquet(folder)
    query = sinks.console(words, "late").trigger(availableNow=True).start()
    query.awaitTermination()
    # The JVM prints by itself; what can be seen from here is that the row went to the console.
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1


@pytest.mark.parametrize("bound", [None, 20_000_000])
def test_late_rows_of_a_detector_are_tagged(spark, fed, bound):
    batches = [[(1, 10, 0, "create")], [(1, 100, 1, "create")], [(1, 5, 2, "pay"), (1, 101, 3, "pay")]]
    found = processors.detect(
        fed(batches, "1 second", flush=False), ["key"], "ts", "tie", F.col("kind") == "pay",
        processors.OrderState(20_000_000), bound=bound,
    )
    rows = runs.collected(found, "late-tags").collect()
    assert [(r.first_tie, r.last_tie) for r in rows if r.tag == processors.LATE] == [(2, 2)]


def test_null_keys_of_a_detector(spark, fed):
    """A null key is a key of its own; the keys come in turn, so that mixed-up state would show."""
    keys = [None, 1, 2, 3]
    events = [(keys[i % 4], i // 8, i, ["create", "pay"][i // 4 % 2]) for i in range(64)]
    stream = fed([events[:30], events[30:]]).where("kind <> 'flush' OR key = -1")
    found = processors.detect(
        stream, ["key"], "ts", "tie", kind_number("create", "pay"), processors.OrderState(us(15)), bound=us(15)
    )
    rows = runs.collected(found, "null-keys").where("key >= 0 OR key IS NULL").collect()
    want = sorted(((keys[i % 4], i - 4, i, "paid") for i in range(64) if i // 4 % 2), key=str)
    assert sorted(((r.key, r.first_tie, r.last_tie, r.tag) for r in rows), key=str) == want


class FakeState:
    """Value, map and timer state of one key, with the rows read counted."""

    def __init__(self):
        self.value, self.slots, self.timers, self.read = None, {}, set(), 0

    def getValueState(self, name, schema):
        return FakeState()

    def getMapState(self, name, key, value):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def containsKey(self, slot):
        return slot in self.slots

    def getValue(self, slot):
        self.read += len(self.slots[slot][0])
        return self.slots[slot]

    def updateValue(self, slot, rows):
        self.slots[slot] = rows

    def removeKey(self, slot):
        del self.slots[slot]

    def keys(self):
        return iter(list(self.slots))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_timer_reads_due_rows_only():
    """One busy key over many batches: what a timer reads does not grow with what waits."""
    state, columns = FakeState(), ["key", "first_us", "last_us", "first_tie", "last_tie", "n", "tag"]
    machine = processors.InOrder(processors.OrderState(5_000_000), columns, 1_000_000)
    machine.init(state)
    rows = [Row(us=k * 250_000 + 1, side=k % 2, tie=k, kind=k % 2) for k in range(4000)]
    assert list(machine.handleInputRows((1,), iter(rows), Watermark(0))) == []
    assert len(state.timers) == 1
    found, mark = [], 0
    while state.timers and mark < 10**9:
        (mark,) = state.timers
        mark += 500
        state.timers.clear()
        state.read = 0
        found += machine.handleExpiredTimer((1,), Watermark(mark), None)
        assert state.read <= 8 and len(state.timers) <= 1
    assert [(r.first_tie, r.last_tie, r.tag) for r in found] == [(k, k + 1, "paid") for k in range(0, 4000, 2)]


def test_a_batch_writes_its_own_rows_and_reads_few_runs(spark, tmp_path):
    """Old values are written anew when runs are merged only, some log(batches) times."""
    table = sinks.WindowValues(spark, str(tmp_path / "t"), "key", keep="40 days")
    rng, want, wrote = random.Random(3), {}, Counter()
    write = table._write
    table._write = lambda rows, first, last: (wrote.update([last - first + 1]), write(rows, first, last))
    for batch_id in range(20):
        day = 86400 * (batch_id // 5 if batch_id < 18 else 50)
        rows = [(k, at(3600 + day), batch_id * 10 + k) for k in rng.sample(range(6), batch_id % 4)]
        before = dict(want)
        want |= {(r[0], r[1]): r[2] for r in rows}
        batch = spark.createDataFrame(rows, "key int, window_end timestamp_ntz, cnt int")
        for _ in range(2 if batch_id in (7, 11, 15) else 1):  # as when it is run again after a failure
            days = table.put(batch, batch_id)
        assert days == sorted({f"day={r[1]:%Y-%m-%d}" for r in rows})
        if batch_id in (6, 7, 8, 15, 16):
            # The state before and after the batch, of the windows that it touched.
            for upto, state in ((batch_id - 1, before), (batch_id, want)):
                got = {(r.key, r.window_end): r.cnt for r in table.latest(upto, batch_id, days).collect()}
                assert got == {k: v for k, v in state.items() if k[1] in {r[1] for r in rows}}
    assert wrote == {1: 23, sinks.FAN: 4}
    # A run of each full length, and the short ones behind it.
    assert table._cover() == [(19, 19), (18, 18), (17, 17), (16, 16), (8, 15), (0, 7)]
    newest = max(end for _, end in want)
    kept = {k: v for k, v in want.items() if (newest - k[1]).days <= 40}
    again = sinks.WindowValues(spark, str(tmp_path / "t"), "key")
    assert {(r.key, r.window_end): r.cnt for r in again.latest().collect()} == kept
    assert sinks.WindowValues(spark, str(tmp_path / "none"), "key").latest().isEmpty()


def slow_firings(batches, size, slide, bound, lateness):
    """Counts by window; a batch sees the watermark of those before it, then the timers of its own."""
    counts, fired, out, top = Counter(), Counter(), [], None
    for rows in batches:
        passed = float("-inf") if top is None else top - bound
        changed = set()
        for key, t, tie, _ in rows:
            ends = [t // slide * slide + slide * (k + 1) for k in range(size // slide)]
            open_ends = [e for e in ends if e + lateness > passed]
            if not open_ends:
                out.append((key, None, None, None, "late", tie))
            for e in open_ends:
                counts[key, e] += 1
                changed.add((key, e))
        for w in sorted(changed, key=str):
            if w[1] <= passed:
                fired[w] += 1
                out.append((*w, fired[w], counts[w], "window", None))
        top = max([t for _, t, _, _ in rows] + ([] if top is None else [top]))
        for w in sorted(counts, key=str):
            if w[1] <= top - bound and not fired[w]:
                fired[w] = 1
                out.append((*w, 1, counts[w], "window", None))
    return sorted(out, key=str)


@pytest.mark.parametrize("stretch", [None, "1 minute", "95 seconds"])
def test_windows_fire_at_their_end_and_on_corrections(spark, fed, tmp_path, stretch):
    rng = random.Random(8)
    rows = [(rng.choice([0, 0, 1, None]), rng.randrange(900), k, "x") for k in range(160)]
    # Mostly in order, some behind by much, so that there are corrections and late rows.
    arrived = sorted(rows, key=lambda r: r[1] + (rng.randrange(300) if rng.random() < 0.3 else 0))
    batches = [arrived[k : k + 32] for k in range(0, 160, 32)]
    folder = tmp_path / "parts"
    found = None
    for part in batches:
        # One run for each batch: behind its rows, the watermark moves on and timers fire.
        stream_rows(spark, [(k, at(t), tie, kind) for k, t, tie, kind in part], DDL).write.mode("append").parquet(
            str(folder)
        )
        stream = spark.readStream.schema(DDL.replace("timestamp_ntz", "timestamp")).parquet(str(folder))
        found = firings.window_firings(
            stream, "ts", "tie", "1 minute", "10 seconds", ["key"], "5 seconds", "30 seconds", stretch
        )
        found = runs.to_table(found, str(tmp_path / "out"), str(tmp_path / "check"), "firings")
    got = [
        (r.key, None if r.window_end is None else int(secs(r.window_end)), r.firing, r.cnt, r.tag, r.tie)
        for r in found.collect()
    ]
    want = slow_firings(batches, 60, 10, 5, 30)
    assert (sorted(set(got) - set(want), key=str), sorted(set(want) - set(got), key=str)) == ([], [])
    assert sorted(got, key=str) == want
    assert max(r[2] or 0 for r in want) > 1 and any(r[4] == "late" for r in want)


def test_filtered_rows_still_move_the_watermark(spark, fed, tmp_path):
    rows = [(0, 10, 0, "a"), (0, 70, 1, "a"), (0, 500, 2, "b")]
    stream = fed([rows], flush=False)
    for k, asked in enumerate([filters.keep(stream, "ts", "kind = 'a'"), stream.where("kind = 'a'")]):
        counts = windows.tumbling(asked, "ts", "1 minute")
        table = runs.to_table(counts, str(tmp_path / f"out{k}"), str(tmp_path / f"check{k}"))
        ends = sorted(secs(r.window_end) for r in table.collect())
        # Spark moves the plain filter below the watermark; then the second window stays open.
        assert ends == ([60, 120] if k == 0 else [60])
    table = spark.createDataFrame([(at(1), "a"), (at(2), "b")], "ts timestamp_ntz, kind string")
    assert filters.keep(table, "ts", "kind = 'a'").count() == 1


def test_a_null_event_time_of_a_stream_is_an_error(spark, tmp_path):
    stream_rows(spark, [(1, None, 1, "x")], DDL).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(DDL.replace("timestamp_ntz", "timestamp")).parquet(str(tmp_path / "in"))
    counts = windows.tumbling(stream.withWatermark("ts", "1 second"), "ts", "1 minute")
    with pytest.raises(Exception, match="must not be null"):
        runs.to_table(counts, str(tmp_path / "out"), str(tmp_path / "check"))
