"""The streaming forms, each worked off over the ``events`` table as a stream.

Same mappings as the batch queries.  Windows and deadlines that the watermark has not passed at
the end of the input are not reported, as on any stream; the SQL they are checked against says so.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.functions.times import span
from eddyline.operators import distinct, joins, salting, windows
from eddyline.plans.event_queries import TOP, Query, behavior_lines, in_files, log_lines, outer_tags
from eddyline.session import new_folder
from eddyline.sources import files
from eddyline.sources.files import event_stream, event_table
from eddyline.streaming import firings, leaders, limits, processors, queries, runs, sinks
from eddyline.streaming.filters import keep


def _events(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return event_stream(spark, folder)


def _of_type(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return keep(_events(spark, folder), "ts", F.col("event_type") == kind)


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as the event table has them."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _item_counts(spark: SparkSession, folder: str, how: Callable[..., DataFrame]) -> DataFrame:
    items = _of_type(spark, folder, "view").select(
        "ts", F.get_json_object("props", "$.k").cast("long").alias("item_id")
    )
    return windows.sliding_counts(items, "ts", "1 hour", "5 minutes", ["item_id"], how=how)


def hot_items_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Top-N under corrections: counts in update mode, replaced by key, ranked again."""
    path = new_folder(spark, "hot-items")
    table = sinks.TopNTable(spark, path, "item_id", TOP)
    # Update mode shows a window as it fills, which a second chained window could not.
    counts = _item_counts(spark, folder, windows.sliding_rows)
    runs.each_batch(counts, table, f"{path}/checkpoint", "update", "hot_items_stream")
    return _plain_times(table.current())


def hot_items_closed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Top-N of every window once it is complete."""
    path = new_folder(spark, "hot-items-closed")
    table = sinks.ClosedTopN(f"{path}/rows", "item_id", TOP)
    runs.each_batch(
        _item_counts(spark, folder, windows.sliding_chained),
        table, f"{path}/checkpoint", "append", "hot_items_closed",
    )
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return _plain_times(rows.drop("batch_id"))


def hot_items_leaders_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same lists from two chained stages of bounded state, without a handler of micro-batches."""
    items = _of_type(spark, folder, "view").select(
        "ts", F.get_json_object("props", "$.k").cast("long").alias("item_id")
    )
    found = leaders.closed_top_n(items, "ts", "1 hour", "5 minutes", "item_id", TOP)
    return _plain_times(runs.collected(found, "hot-item-leaders"))


def hot_items_sql_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The windowed counts as SQL over a streaming view, ranked as windows close."""
    path = new_folder(spark, "hot-items-sql")
    items = _events(spark, folder).withColumn(
        "item_id", F.get_json_object("props", "$.k").cast("long")
    )
    # A view of its own name, so that two runs at a time do not share one.
    view = f"behavior_stream_{uuid.uuid4().hex}"
    items.createOrReplaceTempView(view)
    counts = queries.sql_window_counts(
        spark, view, "item_id", "ts", "event_type = 'view'"
    )
    table = sinks.ClosedTopN(f"{path}/rows", "item_id", TOP)
    runs.each_batch(counts, table, f"{path}/checkpoint", "append", "hot_items_sql")
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return _plain_times(rows.drop("batch_id"))


def hot_items_changes_stream(spark: SparkSession, folder: str) -> DataFrame:
    """What the change rows of the Top-N add up to: additions less removals."""
    path = new_folder(spark, "hot-item-changes")
    table = sinks.TopNTable(spark, path, "item_id", TOP)
    counts = _item_counts(spark, folder, windows.sliding_rows)
    runs.each_batch(counts, table, f"{path}/checkpoint", "update", "hot_items_changes")
    net = F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("net")
    rows = table.changes().groupBy("item_id", "cnt", "window_end", "rk").agg(net)
    return _plain_times(rows.where("net <> 0"))


def access_log_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Log files as a stream, out of order by up to a minute; GET requests per url and hour."""
    events = event_table(spark, folder)
    mixed = events.orderBy(F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") * 7919 % 60)
    path = in_files(log_lines(mixed), "access-log")
    requests = keep(files.access_log(spark, path, streaming=True), "ts", "method = 'GET'")
    counts = windows.tumbling(requests, "ts", "1 hour", ["url"])
    return _plain_times(runs.collected(counts, "access-log-counts"))


def behavior_csv_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Behavior files as a stream with a bound of two seconds; rows per behavior and hour."""
    path = in_files(behavior_lines(event_table(spark, folder)), "behavior")
    rows = files.event_csv(spark, path, "user_behavior", streaming=True, delay="2 seconds")
    counts = windows.tumbling(rows, "ts", "1 hour", ["behavior"])
    return _plain_times(runs.collected(counts, "behavior-counts"))


# Requests arrive up to 25 minutes after their time, but every fiftieth of those more than a day
# before the last twelve days after it.
_PARTS = 6


def _late_requests(spark: SparkSession, folder: str) -> tuple[DataFrame, list[DataFrame]]:
    """Requests with their arrival, and the same in parts of equal length of arrival."""
    k = F.get_json_object("props", "$.k")
    clicks = event_table(spark, folder).where("event_type = 'click'").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("/item/"), k).alias("url")
    )
    end = clicks.agg(F.max("ts")).first()[0]
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit(end) - F.make_dt_interval(F.lit(1)))
    behind = F.when(late, 12 * 86400).otherwise(F.col("event_id") * 7919 % 1500)
    rows = clicks.withColumn("arrival", F.unix_seconds("ts") + behind)
    first, last = rows.agg(F.min("arrival"), F.max("arrival")).first()
    if first is None:
        return rows, []
    step = max(1, -(-(last - first + 1) // _PARTS))
    part = F.col("arrival").between
    return rows, [
        rows.where(part(first + k * step, first + (k + 1) * step - 1)).drop("arrival")
        for k in range(_PARTS)
    ]


def _as_they_arrive(spark: SparkSession, folder: str, name: str, run) -> None:
    """Writes part after part and lets the same query work off each: ``run(stream)``."""
    path = new_folder(spark, name)
    rows, parts = _late_requests(spark, folder)
    for part in parts:
        part.write.mode("append").parquet(path)
        run(spark.readStream.schema(part.schema).parquet(path))


_LATE = {"bound": "5 minutes", "lateness": "30 minutes"}


def hot_urls_late_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Top-N of what arrives within the lateness, corrected as it does; 10 min / 1 min."""
    path = new_folder(spark, "hot-urls-late")
    table = sinks.TopNTable(
        spark, f"{path}/top", "url", TOP, sliding=("10 minutes", "1 minute", *_LATE.values())
    )

    def run(stream: DataFrame) -> None:
        counts = queries.late_sliding_counts(
            stream, "ts", "10 minutes", "1 minute", ["url"], **_LATE, panes=True
        )
        runs.each_batch(counts, table, f"{path}/checkpoint", "update", "hot_urls_late")

    _as_they_arrive(spark, folder, "late-requests", run)
    return _plain_times(table.current())


def late_rows_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The requests that come after all their windows have closed."""
    path = new_folder(spark, "late-rows")
    router = sinks.LateRouter(spark, path, "ts", "10 minutes", "1 minute", **_LATE)
    _as_they_arrive(
        spark, folder, "late-requests",
        lambda stream: runs.each_batch(stream, router, f"{path}/checkpoint", "append", "late_rows"),
    )
    return _plain_times(router.rows("late").select("event_id", "ts", "url"))


def hot_urls_firings_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every firing of every window, at its end and on corrections, and the late rows; 10 min / 1 min."""
    path = new_folder(spark, "url-firings")

    def run(stream: DataFrame) -> None:
        found = firings.window_firings(
            stream, "ts", "event_id", "10 minutes", "1 minute", ["url"], **_LATE
        )
        runs.to_table(found, f"{path}/rows", f"{path}/checkpoint", "url-firings")

    _as_they_arrive(spark, folder, "late-requests", run)
    rows = spark.read.parquet(f"{path}/rows").withColumnRenamed("tie", "event_id")
    return _plain_times(rows)


def uv_bitmap_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Unique visitors from bitmap pieces that every micro-batch brings up to date."""
    path = new_folder(spark, "uv-bitmap")
    pieces = queries.bitmap_pieces(_events(spark, folder), "ts", "1 hour", F.col("user_id"))
    table = sinks.WindowValues(spark, f"{path}/pieces", "piece", "bits")
    runs.each_batch(pieces, table, f"{path}/checkpoint", "update", "uv_bitmap")
    return _plain_times(distinct.bitmap_counts(table.latest()))


def pv_hourly_stream(spark: SparkSession, folder: str) -> DataFrame:
    counts = salting.salted_counts(
        _of_type(spark, folder, "view"), "ts", "1 hour", salting.salt(["event_id"])
    )
    return _plain_times(runs.collected(counts, "pv-hourly"))


def uv_hourly_stream(spark: SparkSession, folder: str) -> DataFrame:
    counts = queries.distinct_per_window(_events(spark, folder), "ts", "1 hour", "user_id")
    return _plain_times(runs.collected(counts, "uv-hourly"))


def pay_receipt_interval_stream(spark: SparkSession, folder: str) -> DataFrame:
    side = lambda kind, name: _of_type(spark, folder, kind).select(
        "user_id", F.col("ts").alias(f"{name}_ts"), F.col("event_id").alias(f"{name}_id")
    )
    pairs = joins.interval_join(
        side("click", "pay"), side("purchase", "receipt"),
        ["user_id"], "pay_ts", "receipt_ts", "3 hours", "5 hours",
    )
    return _plain_times(runs.collected(pairs, "pay-receipt"))


def pay_receipt_outer_stream(spark: SparkSession, folder: str) -> DataFrame:
    side = lambda kind, name: _of_type(spark, folder, kind).select(
        "user_id", F.col("ts").alias(f"{name}_ts"), F.col("event_id").alias(f"{name}_id")
    )
    both = joins.outer_interval_join(
        side("click", "pay"), side("purchase", "receipt"),
        ["user_id"], "pay_ts", "receipt_ts", "3 hours", "5 hours",
    )
    return _plain_times(runs.collected(outer_tags(both), "pay-receipt-outer"))


def _detected(
    stream: DataFrame, keys, kind, detector, name: str, side=None, bound: str | None = None
) -> DataFrame:
    found = processors.detect(
        stream, keys, "ts", "event_id", kind, detector, side, bound and span(bound)
    )
    rows = runs.collected(found, name).where(F.coalesce("tag", F.lit("")) != processors.LATE)
    return _plain_times(processors.with_times(rows))


def login_fail_window_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    failed = (F.col("event_type") == "error").cast("int")
    found = _detected(
        events, ["user_id"], failed, processors.FailureWindow(span("6 hours")),
        "login-fail", side=1 - failed,
    )
    return found.select("user_id", "first_ts", "last_ts", F.col("n").alias("n_fail"))


def _failure_runs(spark: SparkSession, folder: str, keys, within: str | None, name: str):
    failed = (F.col("event_type") == "error").cast("int")
    run = processors.StrictRun(2, within and span(within))
    # In order of event_id at equal times, whatever the event.
    found = _detected(_events(spark, folder), keys, failed, run, name, F.lit(0), within)
    return found.select(
        *keys, F.col("first_tie").alias("first_id"), F.col("last_tie").alias("last_id")
    )


def login_fail_strict_seq_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _failure_runs(spark, folder, ["user_id"], "6 hours", "fail-sequence")


def login_fail_strict_seq_global_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _failure_runs(spark, folder, [], "10 minutes", "fail-sequence-global")


def fail_runs_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _failure_runs(spark, folder, ["user_id"], None, "fail-runs")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return keep(_events(spark, folder), "ts", F.col("event_type").isin("click", "purchase"))


def _paying():
    return (F.col("event_type") == "purchase").cast("int")


def order_timeout_state_stream(spark: SparkSession, folder: str) -> DataFrame:
    found = _detected(
        _orders(spark, folder), ["user_id"], _paying(),
        processors.OrderState(span("12 hours")), "order-state", bound="12 hours",
    )
    return found.select(
        "user_id", F.col("last_ts").alias("ts"), F.col("last_tie").alias("event_id"), "tag"
    )


def order_timeout_pattern_stream(spark: SparkSession, folder: str) -> DataFrame:
    found = _detected(
        _orders(spark, folder), ["user_id"], _paying(),
        processors.FollowedBy(span("12 hours")), "order-pattern", bound="12 hours",
    )
    return found.select(
        "user_id", F.col("first_tie").alias("create_id"), F.col("last_tie").alias("pay_id"), "tag"
    )


def pay_receipt_reconcile_stream(spark: SparkSession, folder: str) -> DataFrame:
    tags = ("matched", "pay_no_receipt", "receipt_no_pay")
    found = _detected(
        _orders(spark, folder), ["user_id"], _paying(),
        processors.Pairing(span("5 hours"), tags), "reconcile",
    )
    return found.select(
        "user_id", F.col("first_tie").alias("first_id"), F.col("last_tie").alias("last_id"), "tag"
    )


def click_filter_stream(spark: SparkSession, folder: str) -> DataFrame:
    clicks = _events(spark, folder).withColumn(
        "ad_id", F.get_json_object("props", "$.k").cast("long") % 2
    )
    found = limits.click_limit(clicks, ["user_id", "ad_id"], "ts", "event_id", 2)
    rows = runs.collected(found, "click-filter").where(F.col("tag") != limits.LATE)
    return _plain_times(rows)


STREAM: dict[str, Query] = {
    f.__name__: f
    for f in (
        hot_items_stream, hot_items_closed_stream, hot_items_leaders_stream, hot_items_sql_stream,
        hot_items_changes_stream,
        access_log_stream, behavior_csv_stream, hot_urls_late_stream, late_rows_stream, hot_urls_firings_stream,
        pv_hourly_stream,
        uv_hourly_stream, uv_bitmap_stream,
        pay_receipt_interval_stream, pay_receipt_outer_stream, login_fail_window_stream, login_fail_strict_seq_stream,
        login_fail_strict_seq_global_stream, fail_runs_stream, order_timeout_state_stream,
        order_timeout_pattern_stream, pay_receipt_reconcile_stream, click_filter_stream,
    )
}
