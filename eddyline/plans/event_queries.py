"""Every question asked of the ``events`` table.

The table stands in for the different streams: the mapping of columns and the parameters are
those named next to each query.  ``k`` is the number inside ``props``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.functions.hashing import bitmap_offset
from eddyline.operators import (
    blacklist, distinct, joins, late, logins, orders, patterns, salting, topn, windows,
)
from eddyline.operators.orders import with_transaction
from eddyline.operators.patterns import Step
from eddyline.session import new_folder
from eddyline.sources import files, market

Query = Callable[[SparkSession, str], DataFrame]

TOP = 5


def _events(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return files.event_table(spark, folder)


def _with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))


def _views(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).where("event_type = 'view'")


# --- hot items: views are page views, k is the item; 1 h / 5 min


def _hot_item_counts(spark: SparkSession, folder: str) -> DataFrame:
    items = _with_k(_views(spark, folder)).withColumnRenamed("k", "item_id")
    return windows.sliding_counts(items, "ts", "1 hour", "5 minutes", ["item_id"])


def hot_items_topn(spark: SparkSession, folder: str) -> DataFrame:
    return topn.top_n_per_window(_hot_item_counts(spark, folder), TOP, "item_id")


def hot_items_sql(spark: SparkSession, folder: str) -> DataFrame:
    view = f"behavior_events_{uuid.uuid4().hex}"
    _with_k(_events(spark, folder)).createOrReplaceTempView(view)
    return spark.sql(
        topn.hot_items_sql_text(view, "k", "event_type", "ts", "1 hour", "5 minutes"),
        args={"wanted": "view", "n": TOP},
    )


def hot_items_report(spark: SparkSession, folder: str) -> DataFrame:
    return topn.report(hot_items_topn(spark, folder), "item_id", topn.REPORT_LABELS["item"])


# --- page views and unique visitors, per hour


def pv_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return windows.tumbling(
        _views(spark, folder), "ts", "1 hour", aggs=[F.count(F.lit(1)).alias("pv")]
    )


def pv_hourly_salted(spark: SparkSession, folder: str) -> DataFrame:
    return salting.salted_counts(
        _views(spark, folder), "ts", "1 hour", salting.salt(["event_id"])
    )


def uv_hourly_exact(spark: SparkSession, folder: str) -> DataFrame:
    return distinct.distinct_per_window(_events(spark, folder), "ts", "1 hour", "user_id")


def uv_hourly_records(spark: SparkSession, folder: str) -> DataFrame:
    events = _with_k(_events(spark, folder))
    return distinct.distinct_per_window(
        events, "ts", "1 hour", "user_id", "k", "event_type", "ts"
    )


def uv_hourly_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    return distinct.bitmap_counts(
        distinct.bitmap_state(_events(spark, folder), "ts", "1 hour", F.col("user_id"))
    )


def uv_hourly_hll(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the sketch is within 5 % of the exact count, for every hour."""
    events = _events(spark, folder)
    about = distinct.sketch_per_window(events, "ts", "1 hour", "user_id", name="about")
    exact = distinct.distinct_per_window(events, "ts", "1 hour", "user_id", name="exact")
    close = F.abs(F.col("about") - F.col("exact")) <= 0.05 * F.col("exact")
    return about.join(exact, "window_end").select("window_end", close.alias("close"))


def uv_sliding_hll(spark: SparkSession, folder: str) -> DataFrame:
    """Whether sketches united over panes are within 5 % of the exact count; 1 h / 5 min."""
    events = _events(spark, folder)
    sketch = {"about": (windows.distinct_sketch(14), F.col("user_id"))}
    about = windows.sliding(events, "ts", "1 hour", "5 minutes", [], sketch)
    exact = events.groupBy(F.window("ts", "1 hour", "5 minutes")["end"].alias("window_end")).agg(
        F.count_distinct("user_id").alias("exact")
    )
    close = F.abs(F.col("about") - F.col("exact")) <= 0.05 * F.col("exact")
    return about.join(exact, "window_end").select("window_end", "exact", close.alias("close"))


def uv_daily_hll(spark: SparkSession, folder: str) -> DataFrame:
    """Whether hourly sketches, stored and united by day, are within 5 % of the exact count."""
    events = _events(spark, folder)
    path = new_folder(spark, "uv-sketches")
    distinct.sketch_pieces(events, "ts", "1 hour", "user_id").write.parquet(path)
    day = lambda at: F.date_format(at, "yyyy-MM-dd").alias("day")
    # A window ends at the next day's first instant at most.
    start = F.col("window_end") - F.expr("INTERVAL 1 HOUR")
    about = distinct.united(spark.read.parquet(path), [day(start)], name="about")
    exact = events.groupBy(day("ts")).agg(F.count_distinct("user_id").alias("exact"))
    close = F.abs(F.col("about") - F.col("exact")) <= 0.05 * F.col("exact")
    return about.join(exact, "day").select("day", "exact", close.alias("close"))


def uv_running(spark: SparkSession, folder: str) -> DataFrame:
    return distinct.running_distinct(
        _events(spark, folder), "ts", "event_id", "1 hour",
        bitmap_offset(F.col("user_id")), ["event_id"],
    )


# --- hot urls: clicks are GET requests, '/item/k' is the url; 10 min / 1 min


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    clicks = _with_k(_events(spark, folder).where("event_type = 'click'"))
    return clicks.withColumn("url", F.concat(F.lit("/item/"), F.col("k").cast("string")))


def hot_urls_topn(spark: SparkSession, folder: str) -> DataFrame:
    counts = windows.sliding_counts(
        _requests(spark, folder), "ts", "10 minutes", "1 minute", ["url"]
    )
    return topn.top_n_per_window(counts, TOP, "url")


def hot_urls_topn_5s(spark: SparkSession, folder: str) -> DataFrame:
    """The same every 5 seconds."""
    counts = windows.sliding_counts(
        _requests(spark, folder), "ts", "10 minutes", "5 seconds", ["url"]
    )
    return topn.top_n_per_window(counts, TOP, "url")


def hot_urls_report(spark: SparkSession, folder: str) -> DataFrame:
    return topn.report(hot_urls_topn(spark, folder), "url", topn.REPORT_LABELS["url"])


# Late arrival: ts + (event_id * 7919 % 7200) s; watermark bound 5 min, lateness 30 min.
_LATE = {"bound": "5 minutes", "lateness": "30 minutes"}


def _arriving(spark: SparkSession, folder: str) -> DataFrame:
    delay = F.make_dt_interval(secs=(F.col("event_id") * 7919 % 7200).cast("decimal(18,6)"))
    return _requests(spark, folder).withColumn("arrival", F.col("ts") + delay)


def hot_urls_late(spark: SparkSession, folder: str) -> DataFrame:
    counts = late.late_sliding_counts(
        _arriving(spark, folder), "ts", "arrival", "event_id",
        "10 minutes", "1 minute", ["url"], **_LATE,
    )
    return topn.top_n_per_window(counts, TOP, "url")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = late.late_rows(
        _arriving(spark, folder).select("event_id", "ts", "arrival", "url"),
        "ts", "arrival", "event_id", "10 minutes", "1 minute", **_LATE,
    )
    return rows.select("event_id", "ts", "url")


def late_corrections(spark: SparkSession, folder: str) -> DataFrame:
    return late.late_corrections(
        _arriving(spark, folder), "ts", "arrival", "event_id",
        "10 minutes", "1 minute", ["url"], **_LATE,
    )


def log_lines(events: DataFrame) -> DataFrame:
    """Events as lines of an access log."""
    line = F.concat_ws(
        " ",
        F.lit("10.0.0.1"), F.col("user_id").cast("string"), F.lit("-"),
        F.date_format("ts", files.ACCESS_LOG_TIME), F.lit("+0000"),
        F.when(F.col("event_type") == "click", "GET").otherwise("POST"),
        F.concat(F.lit("/item/"), F.get_json_object("props", "$.k")),
    )
    return events.select(line.alias("value"))


def csv_lines(events: DataFrame, *columns) -> DataFrame:
    """Columns as comma-separated lines, without a header or quotes."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return events.select(F.concat_ws(",", *texts).alias("value"))


def in_files(lines: DataFrame, name: str) -> str:
    """The folder that the lines were written to as text files."""
    path = new_folder(lines.sparkSession, name)
    lines.write.text(path)
    return path


def _plain_end(counts: DataFrame) -> DataFrame:
    return counts.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def access_log_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Log files written from events and read back; GET requests per url and hour."""
    path = in_files(log_lines(_events(spark, folder)), "access-log")
    requests = files.access_log(spark, path).where("method = 'GET'")
    return _plain_end(windows.tumbling(requests, "ts", "1 hour", ["url"]))


def seconds_of(name: str = "ts"):
    return F.unix_seconds(F.col(name).cast("timestamp"))


def behavior_lines(events: DataFrame) -> DataFrame:
    """Events as lines of the behavior file; the category is the item's last digit."""
    return csv_lines(
        _with_k(events), F.col("user_id"), F.col("k"), F.col("k") % 10, F.col("event_type"),
        seconds_of(),
    )


def behavior_csv_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Behavior files written from events and read back; rows per behavior and hour."""
    path = in_files(behavior_lines(_events(spark, folder)), "behavior")
    rows = files.event_csv(spark, path, "user_behavior")
    return _plain_end(windows.tumbling(rows, "ts", "1 hour", ["behavior"]))


def _order_lines(events: DataFrame) -> DataFrame:
    """Clicks create an order, purchases pay it; every seventh payment lacks its transaction."""
    paid = (F.col("event_type") == "purchase") & (F.col("event_id") % 7 != 0)
    tx = F.when(paid, F.concat(F.lit("tx"), F.col("event_id")))
    kind = F.when(F.col("event_type") == "click", "create").otherwise("pay")
    orders = events.where(F.col("event_type").isin("click", "purchase"))
    return csv_lines(orders, F.col("user_id"), kind, tx, seconds_of())


def _receipt_lines(events: DataFrame) -> DataFrame:
    """Two of three payments have a receipt, 5 seconds before to 5 seconds after them."""
    paid = _with_k(events).where("event_type = 'purchase' AND event_id % 3 <> 0")
    late = F.col("event_id") % 11 - 5
    channel = F.concat(F.lit("c"), F.col("k") % 4)
    return csv_lines(paid, F.concat(F.lit("tx"), F.col("event_id")), channel, seconds_of() + late)


def pay_receipt_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Order and receipt files written from events, read back and joined by transaction."""
    events = _events(spark, folder)
    orders = files.event_csv(spark, in_files(_order_lines(events), "orders"), "orders")
    receipts = files.event_csv(spark, in_files(_receipt_lines(events), "receipts"), "receipts")
    pays = with_transaction(orders).select("txId", F.col("ts").alias("pay_ts"), "orderId")
    bills = receipts.select("txId", F.col("ts").alias("receipt_ts"), "payChannel")
    pairs = joins.interval_join(pays, bills, ["txId"], "pay_ts", "receipt_ts", "3 seconds", "5 seconds")
    return pairs.select(
        "txId", "orderId", "payChannel",
        seconds_of("pay_ts").alias("pay_s"), seconds_of("receipt_ts").alias("receipt_s"),
    )


# --- marketing: channel 'c(k%4)' and event type, and ad clicks by province 'p(k%10)'; 1 h / 5 min


def channel_behavior_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = _with_k(_events(spark, folder)).select(
        "ts",
        F.concat(F.lit("c"), (F.col("k") % 4).cast("string")).alias("channel"),
        F.col("event_type").alias("behavior"),
    )
    return windows.sliding_counts(events, "ts", "1 hour", "5 minutes", ["channel", "behavior"])


def channel_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Number, sum, least, largest and mean k per channel; 1 h / 5 min."""
    events = _with_k(_events(spark, folder)).withColumn(
        "channel", F.concat(F.lit("c"), (F.col("k") % 4).cast("string"))
    )
    k = F.col("k")
    return windows.sliding(
        events, "ts", "1 hour", "5 minutes", ["channel"],
        {
            "n": ("count", k), "sum_k": ("sum", k), "min_k": ("min", k), "max_k": ("max", k),
            "mean_k": ("avg", k),
        },
    )


def province_peak_5s(spark: SparkSession, folder: str) -> DataFrame:
    """The largest count of a window of 1 h / 5 s that ends on a day, per province."""
    events = _with_k(_events(spark, folder)).withColumn(
        "province", F.concat(F.lit("p"), (F.col("k") % 10).cast("string"))
    )
    counts = windows.sliding_counts(events, "ts", "1 hour", "5 seconds", ["province"])
    day = F.date_format("window_end", "yyyy-MM-dd").alias("day")
    return counts.groupBy("province", day).agg(F.max("cnt").alias("peak"))


def market_source_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Generated marketing events, one per event row, counted per channel and behavior."""
    made = market.market_events(_events(spark, folder), "event_id", "ts")
    return windows.sliding_counts(made, "ts", "1 hour", "5 minutes", ["channel", "behavior"])


# Two clicks per (user, ad = k % 2, local day) pass.
_CLICK_LIMIT = 2


def _filtered_clicks(spark: SparkSession, folder: str) -> DataFrame:
    clicks = _with_k(_events(spark, folder)).select(
        "event_id", "ts", "user_id", (F.col("k") % 2).alias("ad_id"),
        F.concat(F.lit("p"), (F.col("k") % 10).cast("string")).alias("province"),
    )
    return blacklist.click_filter(clicks, ["user_id", "ad_id"], "ts", "event_id", _CLICK_LIMIT)


def ad_clicks_by_province(spark: SparkSession, folder: str) -> DataFrame:
    clicks = blacklist.passed(_filtered_clicks(spark, folder))
    return windows.sliding_counts(clicks, "ts", "1 hour", "5 minutes", ["province"])


def click_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    return blacklist.warnings(
        _filtered_clicks(spark, folder), ["user_id", "ad_id", "ts", "event_id"]
    )


# --- logins: an error is a failure, anything else a success; 6 h in place of 2 s


def _failed():
    return F.col("event_type") == "error"


def login_fail_window(spark: SparkSession, folder: str) -> DataFrame:
    return logins.failure_windows(_events(spark, folder), ["user_id"], "ts", _failed(), "6 hours")


def login_fail_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return logins.failure_pairs(
        _events(spark, folder), ["user_id"], "ts", "event_id", _failed(), "6 hours"
    )


def login_fail_alerts(spark: SparkSession, folder: str) -> DataFrame:
    pairs = login_fail_pairs(spark, folder)
    seconds = lambda name: F.unix_seconds(F.col(name).cast("timestamp"))
    return pairs.select(
        "user_id",
        "last_ts",
        logins.alert_text(
            F.col("user_id"), seconds("first_ts"), seconds("last_ts"), F.lit(2)
        ).alias("message"),
    )


def _failure_sequence(
    spark: SparkSession, folder: str, keys: list[str], within: str, slot: str | None = None
) -> DataFrame:
    found = patterns.strict_sequence(
        _events(spark, folder), keys, "ts", ["event_id"],
        [Step("start", _failed()), Step("next", _failed())],
        ["event_id", "user_id", "ts"], within, slot=slot,
    )
    return found.select(
        F.col("start.user_id").alias("user_id"),
        F.col("start.event_id").alias("first_id"),
        F.col("next.event_id").alias("last_id"),
    )


def login_fail_strict_seq(spark: SparkSession, folder: str) -> DataFrame:
    return _failure_sequence(spark, folder, ["user_id"], "6 hours")


def login_fail_strict_seq_slots(spark: SparkSession, folder: str) -> DataFrame:
    """The same for busy keys: pieces as long as a slot, without copies of rows."""
    return _failure_sequence(spark, folder, ["user_id"], "6 hours", "1 day")


def login_fail_strict_seq_global(spark: SparkSession, folder: str) -> DataFrame:
    return _failure_sequence(spark, folder, [], "10 minutes", "1 hour")


def fail_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = patterns.loop(
        _events(spark, folder), ["user_id"], "ts", ["event_id"], _failed(), 2,
        ["event_id", "user_id"],
    )
    return found.select(
        F.col("s1.user_id").alias("user_id"),
        F.col("s1.event_id").alias("first_id"),
        F.col("s2.event_id").alias("last_id"),
    )


# --- orders: click creates, purchase pays, the user is the order; 12 h in place of 15 min


def _created():
    return F.col("event_type") == "click"


def _paid():
    return F.col("event_type") == "purchase"


def _timeout_pattern(spark: SparkSession, folder: str, slot: str | None) -> DataFrame:
    found = patterns.relaxed_sequence(
        _events(spark, folder), ["user_id"], "ts", ["event_id"],
        [Step("create", _created()), Step("pay", _paid())],
        ["event_id", "user_id"], "12 hours", slot=slot,
    )
    return found.select(
        F.col("create.user_id").alias("user_id"),
        F.col("create.event_id").alias("create_id"),
        F.col("pay.event_id").alias("pay_id"),
        "tag",
    )


def order_timeout_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return _timeout_pattern(spark, folder, None)


def order_timeout_pattern_slots(spark: SparkSession, folder: str) -> DataFrame:
    """The same for busy keys: pieces as long as a slot, without copies of rows."""
    return _timeout_pattern(spark, folder, "1 day")


def _timeout_state(spark: SparkSession, folder: str, slot: str | None) -> DataFrame:
    return orders.order_states(
        _events(spark, folder), "user_id", "ts", "event_id", _created(), _paid(), "12 hours", slot=slot
    )


def order_timeout_state(spark: SparkSession, folder: str) -> DataFrame:
    return _timeout_state(spark, folder, None)


def order_timeout_state_slots(spark: SparkSession, folder: str) -> DataFrame:
    """The same for busy keys."""
    return _timeout_state(spark, folder, "1 day")


# --- payments and receipts: clicks and purchases of a user


def _side(spark: SparkSession, folder: str, kind: str, name: str) -> DataFrame:
    return (
        _events(spark, folder)
        .where(F.col("event_type") == kind)
        .select("user_id", F.col("ts").alias(f"{name}_ts"), F.col("event_id").alias(f"{name}_id"))
    )


def pay_receipt_interval(spark: SparkSession, folder: str) -> DataFrame:
    return joins.interval_join(
        _side(spark, folder, "click", "pay"), _side(spark, folder, "purchase", "receipt"),
        ["user_id"], "pay_ts", "receipt_ts", "3 hours", "5 hours",
    )


def outer_tags(both: DataFrame) -> DataFrame:
    tag = F.when(F.col("receipt_ts").isNull(), "pay_no_receipt").when(F.col("pay_ts").isNull(), "receipt_no_pay")
    return both.withColumn("tag", tag.otherwise("matched"))


def pay_receipt_outer(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair in reach, and the pays and receipts that have no partner."""
    both = joins.outer_interval_join(
        _side(spark, folder, "click", "pay"), _side(spark, folder, "purchase", "receipt"),
        ["user_id"], "pay_ts", "receipt_ts", "3 hours", "5 hours",
    )
    return outer_tags(both)


def pay_receipt_reconcile_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every click and every purchase, keyed by user: keys repeat on both sides."""
    return joins.reconcile(
        _side(spark, folder, "click", "pay"), _side(spark, folder, "purchase", "receipt"),
        ["user_id"], "pay_ts", "receipt_ts", "5 hours", "pay_id", "receipt_id", slot="1 day",
    )


def pay_receipt_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per user and day: its first click and its first purchase."""

    def first(kind: str, name: str) -> DataFrame:
        rows = _side(spark, folder, kind, name).withColumn(
            "day", F.unix_date(F.to_date(f"{name}_ts")).cast("long")
        )
        return rows.groupBy("user_id", "day").agg(
            F.min(F.struct(f"{name}_ts", f"{name}_id")).alias("f")
        ).select("user_id", "day", "f.*")

    return joins.reconcile(
        first("click", "pay"), first("purchase", "receipt"),
        ["user_id", "day"], "pay_ts", "receipt_ts", "5 hours", "pay_id", "receipt_id",
    )


BATCH: dict[str, Query] = {
    f.__name__: f
    for f in (
        hot_items_topn, hot_items_sql, hot_items_report,
        pv_hourly, pv_hourly_salted,
        uv_hourly_exact, uv_hourly_records, uv_hourly_bitmap, uv_hourly_hll, uv_sliding_hll, uv_daily_hll, uv_running,
        hot_urls_topn, hot_urls_topn_5s, hot_urls_report, hot_urls_late, late_rows,
        late_corrections, access_log_counts, behavior_csv_counts, pay_receipt_csv,
        channel_behavior_counts, channel_stats, province_peak_5s, market_source_counts, ad_clicks_by_province, click_blacklist,
        login_fail_window, login_fail_pairs, login_fail_alerts,
        login_fail_strict_seq, login_fail_strict_seq_slots, login_fail_strict_seq_global, fail_runs,
        order_timeout_pattern, order_timeout_pattern_slots, order_timeout_state, order_timeout_state_slots,
        pay_receipt_interval, pay_receipt_outer, pay_receipt_reconcile, pay_receipt_reconcile_all,
    )
}
