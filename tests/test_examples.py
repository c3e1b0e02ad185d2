"""Small worked examples with known answers, at the bounds that matter."""

from __future__ import annotations

from conftest import at, secs, stream_rows
from pyspark.sql import functions as F

from eddyline.operators import blacklist, joins, logins, orders, patterns, windows
from eddyline.operators.patterns import Step

QUARTER = 15 * 60


def login_frame(spark, rows):
    return stream_rows(
        spark, [(u, e, at(t), i) for i, (u, e, t) in enumerate(rows)],
        "user long, event string, ts timestamp_ntz, tie long",
    )


FAIL = lambda: F.col("event") == "fail"


def test_three_failures_in_three_seconds(spark):
    """842, 843, 844: one window of three failures, two pairs; other users do not break them."""
    df = login_frame(
        spark,
        [(5402, "success", 815), (1035, "fail", 842), (1035, "fail", 843), (1035, "fail", 844),
         (7328, "success", 848), (1035, "success", 860), (4261, "fail", 870)],
    )
    opened = logins.failure_windows(df, ["user"], "ts", FAIL(), "2 seconds").collect()
    assert [(r.user, secs(r.first_ts), secs(r.last_ts), r.n_fail) for r in opened] == [(1035, 842, 844, 3)]
    pairs = logins.failure_pairs(df, ["user"], "ts", "tie", FAIL(), "2 seconds").collect()
    assert sorted((secs(r.first_ts), secs(r.last_ts)) for r in pairs) == [(842, 843), (843, 844)]
    text = logins.alert_text(F.lit(1035), F.lit(842), F.lit(844), F.lit(3))
    assert spark.range(1).select(text).first()[0] == "1035在842到844之间登录失败3次！"


def test_login_bounds(spark):
    """Exactly two seconds: inside a timer window, but no pair.  A success at the end cancels."""
    df = login_frame(
        spark,
        [(1, "fail", 0), (1, "fail", 2),
         (2, "fail", 0), (2, "fail", 1), (2, "success", 2),
         (3, "fail", 0), (3, "fail", 1), (3, "success", 3),
         (4, "fail", 0), (4, "success", 1), (4, "fail", 1.5), (4, "fail", 2.5), (4, "fail", 4)],
    )
    opened = logins.failure_windows(df, ["user"], "ts", FAIL(), "2 seconds").collect()
    assert sorted((r.user, secs(r.first_ts), secs(r.last_ts), r.n_fail) for r in opened) == [
        (1, 0, 2, 2), (3, 0, 1, 2), (4, 1.5, 2.5, 2),
    ]
    pairs = logins.failure_pairs(df, ["user"], "ts", "tie", FAIL(), "2 seconds").collect()
    assert sorted((r.user, secs(r.first_ts)) for r in pairs) == [(2, 0), (3, 0), (4, 1.5), (4, 2.5)]


def test_unkeyed_sequence_pairs_two_users(spark):
    df = login_frame(spark, [(1, "fail", 0), (2, "fail", 1), (1, "success", 5)])
    steps = [Step("first", FAIL()), Step("second", FAIL())]
    args = ("ts", ["tie"], steps, ["user"], "2 seconds")
    assert patterns.strict_sequence(df, ["user"], *args).count() == 0
    rows = patterns.strict_sequence(df, [], *args).collect()
    assert [(r.first.user, r.second.user) for r in rows] == [(1, 2)]


def order_frame(spark, rows):
    return stream_rows(
        spark, [(o, e, at(t), i) for i, (o, e, t) in enumerate(rows)],
        "order long, event string, ts timestamp_ntz, tie long",
    )


def test_orders_at_the_quarter_hour(spark):
    df = order_frame(
        spark,
        [(34729, "create", 0), (34729, "pay", 2),
         (34756, "create", 10), (34756, "pay", 10 + 1038),
         (34767, "create", 20), (34767, "pay", 20 + 1072),
         (34768, "pay", 30),
         (1, "create", 0), (1, "pay", QUARTER),            # exactly on time
         (2, "create", 0), (2, "create", 600), (2, "pay", 1200),  # the newer create counts
         (3, "pay", 50), (3, "create", 50),                # equal times: create first
         (4, "create", 0)],
    )
    create, pay = F.col("event") == "create", F.col("event") == "pay"
    states = orders.order_states(df, "order", "ts", "tie", create, pay, "15 minutes").collect()
    assert sorted((r.order, r.tag) for r in states) == [
        (1, "paid"), (2, "paid"), (3, "paid"), (4, "create_without_pay"), (34729, "paid"),
        (34756, "create_without_pay"), (34756, "pay_without_create"),
        (34767, "create_without_pay"), (34767, "pay_without_create"),
        (34768, "pay_without_create"),
    ]
    found = patterns.relaxed_sequence(
        df.withColumn("second", pay.cast("int")), ["order"], "ts", ["second", "tie"],
        [Step("create", create), Step("pay", pay)], ["order", "tie"], "15 minutes",
    ).collect()
    # The pattern's bound is exclusive, and every create is judged by itself.
    assert sorted((r.create.order, r.create.tie, r.tag) for r in found) == [
        (1, 7, "timeout"), (2, 9, "timeout"), (2, 10, "matched"), (3, 13, "matched"),
        (4, 14, "timeout"), (34729, 0, "matched"), (34756, 2, "timeout"), (34767, 4, "timeout"),
    ]


def test_payments_and_receipts_at_the_bounds(spark):
    gaps = {"a": 3, "b": -3, "c": 5, "d": -5, "e": 5.001, "f": -4, "g": 0}
    pays = [(tx, at(100), i) for i, tx in enumerate([*gaps, "alone"])]
    receipts = [(tx, at(100 + gap), i) for i, (tx, gap) in enumerate(gaps.items())] + [("lost", at(1), 99)]
    left = stream_rows(spark, pays, "tx string, pay_ts timestamp_ntz, pay_id long")
    right = stream_rows(spark, receipts, "tx string, receipt_ts timestamp_ntz, receipt_id long")
    pairs = joins.interval_join(
        left, right, ["tx"], "pay_ts", "receipt_ts", "3 seconds", "5 seconds"
    )
    assert sorted(r.tx for r in pairs.collect()) == ["a", "b", "c", "g"]
    open_ends = joins.interval_join(
        left, right, ["tx"], "pay_ts", "receipt_ts", "3 seconds", "5 seconds", False, False
    )
    assert sorted(r.tx for r in open_ends.collect()) == ["a", "g"]
    tags = joins.reconcile(
        left, right, ["tx"], "pay_ts", "receipt_ts", "5 seconds", "pay_id", "receipt_id"
    ).collect()
    assert sorted((r.tx, r.tag) for r in tags) == [
        ("a", "matched"), ("alone", "pay_no_receipt"), ("b", "matched"), ("c", "matched"),
        ("d", "matched"), ("e", "pay_no_receipt"), ("e", "receipt_no_pay"), ("f", "matched"),
        ("g", "matched"), ("lost", "receipt_no_pay"),
    ]


def test_the_hundred_and_first_click(spark):
    """121 clicks of one user on one ad in one local day, 19 after the next midnight."""
    clicks = [(937166, 1715, "beijing", at(60 * i), i) for i in range(121)]
    clicks += [(937166, 1715, "beijing", at(16 * 3600 + i), 200 + i) for i in range(19)]
    clicks += [(8, 1715, "hebei", at(5), 999)]
    df = stream_rows(
        spark, clicks, "user long, ad long, province string, ts timestamp_ntz, tie long"
    )
    tagged = blacklist.click_filter(df, ["user", "ad"], "ts", "tie")
    passed = blacklist.passed(tagged)
    assert {r.province: r["count"] for r in passed.groupBy("province").count().collect()} == {
        "beijing": 119, "hebei": 1,
    }
    warned = blacklist.warnings(tagged, ["user", "ad", "tie"]).collect()
    assert [(r.user, r.ad, r.tie, r.warning_msg) for r in warned] == [(937166, 1715, 100, "warning")]
    counts = windows.sliding_counts(passed, "ts", "1 hour", "5 seconds", ["province"])
    assert counts.agg(F.sum("cnt")).first()[0] == 120 * 720
