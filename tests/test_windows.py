from __future__ import annotations

import random

import pytest
from collections import Counter, defaultdict

from conftest import at, secs, stream_rows
from pyspark.sql import functions as F

from eddyline.operators import distinct, joins, salting, tags, topn, windows


def dense(spark, seed=0, count=3000):
    """Many rows per key and pane, one key with most of them, repeated visitors and duplicates."""
    rng = random.Random(seed)
    rows = [
        (rng.choice("aaaab"), rng.randrange(1200), rng.choice([10, 11, 99999, 543462, 123456]))
        for _ in range(count)
    ]
    df = stream_rows(
        spark, [(k, at(t), u) for k, t, u in rows], "key string, ts timestamp_ntz, user long"
    )
    return rows, df


def test_panes_equal_direct_windows(spark):
    rows, df = dense(spark)
    want = Counter()
    for key, t, _ in rows:
        for i in range(120):
            want[(key, t // 5 * 5 + 5 * (i + 1))] += 1
    for how in (windows.sliding, windows.sliding_rows):
        got = windows.sliding_counts(df, "ts", "10 minutes", "5 seconds", ["key"], how=how)
        assert {(r.key, secs(r.window_end)): r.cnt for r in got.collect()} == want


def test_salted_equals_plain(spark):
    _, df = dense(spark)
    plain = windows.tumbling(df, "ts", "5 minutes", ["key"], [F.count(F.lit(1)).alias("pv")])
    salted = salting.salted_counts(df, "ts", "5 minutes", salting.salt(["user", "ts"]), ["key"])
    columns = ["key", "window_end", "pv"]
    assert plain.select(columns).exceptAll(salted.select(columns)).count() == 0
    assert plain.count() == salted.count()


def test_bitmap_merges_and_equals_exact(spark):
    rows, df = dense(spark)
    want = defaultdict(set)
    for _, t, user in rows:
        want[t // 300 * 300 + 300].add(user)
    early, late = df.where("user < 1000"), df.where("user >= 1000")
    state = distinct.merge_bitmaps(
        *[distinct.bitmap_state(part, "ts", "5 minutes", F.col("user")) for part in (early, late)]
    )
    got = {secs(r.window_end): r.uv for r in distinct.bitmap_counts(state).collect()}
    assert got == {w: len(users) for w, users in want.items()}


def test_top_n_ties_in_key_order_and_report(spark):
    counts = stream_rows(
        spark,
        [(3, at(0), 5), (1, at(0), 5), (2, at(0), 9), (4, at(0), 1), (1, at(60), 2)],
        "item long, window_end timestamp_ntz, cnt long",
    )
    ranked = topn.top_n_per_window(counts, 3, "item")
    rows = sorted((secs(r.window_end), r.rk, r.item) for r in ranked.collect())
    assert rows == [(0, 1, 2), (0, 2, 1), (0, 3, 3), (60, 1, 1)]
    text = topn.report(ranked, "item", topn.REPORT_LABELS["item"]).orderBy("window_end").first()
    assert text.report.split("\n")[1:4] == [
        "窗口结束时间：2024-03-01 00:00:00", "TOP 1 ItemId=2 商品热度=9", "TOP 2 ItemId=1 商品热度=5",
    ]


def test_top_n_changes(spark):
    ddl = "item long, cnt long, window_end timestamp_ntz, rk long"
    before = stream_rows(spark, [(1, 5, at(0), 1), (2, 4, at(0), 2)], ddl)
    after = stream_rows(spark, [(1, 5, at(0), 1), (3, 4, at(0), 2)], ddl)
    got = topn.top_n_changes(before, after).collect()
    assert sorted((r.op, r.item) for r in got) == [("+", 3), ("-", 2)]


def test_split_and_written_tags(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "x long, tag string")
    parts = tags.split_tags(df, ["a", "b"])
    assert sorted(r.x for r in parts["a"].collect()) == [1, 3]
    tags.write_by_tag(df, str(tmp_path / "out"))
    assert [r.x for r in spark.read.parquet(str(tmp_path / "out" / "tag=b")).collect()] == [2]


def test_aggregates_over_panes(spark):
    rng = random.Random(11)
    rows = [(rng.choice("ab"), at(rng.randrange(-500, 500)), rng.choice([None, 1, 2, 5])) for _ in range(300)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, v int")
    v = F.col("v")
    aggs = {k: (k, v) for k in ("count", "sum", "min", "max", "avg")}
    args = (df, "ts", "2 minutes", "10 seconds", ["key"], aggs)
    got = {(r.key, r.window_end): tuple(r)[2:] for r in windows.sliding(*args).collect()}
    assert got == {(r.key, r.window_end): tuple(r)[2:] for r in windows.sliding_rows(*args).collect()}
    want = {}
    for key, ts, value in rows:
        start = int((ts - at(0)).total_seconds() // 10 * 10)
        for end in range(start + 10, start + 130, 10):
            want.setdefault((key, at(end)), []).append(value)
    assert got.keys() == want.keys()
    for k, values in want.items():
        real = [x for x in values if x is not None]
        mean = sum(real) / len(real) if real else None
        assert got[k] == (len(real), sum(real) if real else None, min(real, default=None), max(real, default=None), mean)


def test_sums_of_fractions_lose_nothing(spark):
    # Very large and very small values: a sum that is carried on by subtraction would lose the small ones.
    rows = [(None, at(0), 1e17), (None, at(30), 0.25), (None, at(700), 0.5), ("a", at(3), 1e-9), ("a", at(599), -1e9)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, v double")
    args = (df, "ts", "10 minutes", "10 seconds", ["key"], {"s": ("sum", F.col("v"))})
    got = {(r.key, r.window_end): r.s for r in windows.sliding(*args).collect()}
    assert got == {(r.key, r.window_end): r.s for r in windows.sliding_rows(*args).collect()}
    assert got[None, at(620)] == 0.25 and got[None, at(720)] == 0.5


def test_windows_as_long_as_their_slide(spark):
    rows, df = dense(spark, 5, 200)
    args = ("ts", "1 minute", "1 minute", ["key"])
    got = sorted(tuple(r) for r in windows.sliding_counts(df, *args).collect())
    assert got == sorted(tuple(r) for r in windows.sliding_counts(df, *args, how=windows.sliding_rows).collect())


def test_own_aggregate_in_parts(spark):
    """The longest text, of equal ones the last: the part is its length and itself."""
    own = windows.Mergeable(
        lambda v: F.max(F.when(v.isNotNull(), F.struct(F.length(v).alias("n"), v.alias("v")))),
        F.max, F.greatest, lambda part: part["v"],
    )
    rng = random.Random(6)
    rows = [(rng.choice("ab"), at(rng.randrange(600)), rng.choice([None, "x", "yy", "zz", "zzzz"])) for _ in range(60)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, v string")
    args = (df, "ts", "2 minutes", "20 seconds", ["key"], {"told": (own, F.col("v"))})
    got = {(r.key, secs(r.window_end)): r.told for r in windows.sliding(*args).collect()}
    assert got == {(r.key, secs(r.window_end)): r.told for r in windows.sliding_rows(*args).collect()}
    want = defaultdict(list)
    for key, ts, v in rows:
        start = int(secs(ts)) // 20 * 20
        for end in range(start + 20, start + 140, 20):
            want[key, end].append(v or "")
    assert got == {k: max(vs, key=lambda v: (len(v), v)) or None for k, vs in want.items()}


def test_sketches_over_windows_and_stored(spark):
    rows = [(at(7 * k), k * k % 4001) for k in range(4000)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, user long")
    sketch = {"uv": (windows.distinct_sketch(14), F.col("user"))}
    got = {secs(r.window_end): r.uv for r in windows.sliding(df, "ts", "1 hour", "5 minutes", [], sketch).collect()}
    want = defaultdict(set)
    for ts, user in rows:
        for k in range(12):
            want[secs(ts) // 300 * 300 + 300 * (k + 1)].add(user)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - len(v)) <= 0.03 * len(v) + 1 for k, v in want.items())
    pieces = distinct.sketch_pieces(df, "ts", "10 minutes", "user")
    (whole,) = distinct.united(pieces, []).collect()
    exact = len({u for _, u in rows})
    assert abs(whole.uv - exact) <= 0.03 * exact


@pytest.mark.parametrize("where", range(7))
def test_a_null_event_time_is_an_error(spark, where):
    df = spark.createDataFrame([(at(1), 1), (None, 2)], "ts timestamp_ntz, k int")
    counts = {"n": ("count", F.lit(1))}
    asked = [
        lambda: windows.tumbling(df, "ts", "1 minute"),
        lambda: windows.sliding(df, "ts", "1 minute", "10 seconds", [], counts),
        lambda: windows.sliding_rows(df, "ts", "1 minute", "10 seconds", ["k"], counts),
        lambda: salting.salted_counts(df, "ts", "1 minute", salting.salt(["k"])),
        lambda: joins.interval_join(
            df.withColumnRenamed("ts", "a"), df.withColumnRenamed("ts", "b"), ["k"], "a", "b", "1 hour", "1 hour"
        ),
        lambda: distinct.bitmap_state(df, "ts", "1 minute", F.col("k")),
        lambda: distinct.running_distinct(df, "ts", "k", "1 minute", F.col("k"), ["k"]),
    ]
    with pytest.raises(Exception, match="must not be null"):
        asked[where]().collect()


def test_panes_want_a_multiple(spark):
    df = spark.createDataFrame([(at(1),)], "ts timestamp_ntz")
    with pytest.raises(ValueError):
        windows.sliding_counts(df, "ts", "1 minute", "7 seconds", [])
    got = windows.sliding_counts(df, "ts", "1 minute", "7 seconds", [], how=windows.sliding_rows)
    assert got.count() in (8, 9)
