"""Repeated login failures: two failures close together, and failures in a timer window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import column_type, from_micros, micros, span
from eddyline.operators.patterns import bucket_width
from eddyline.operators.timeline import BUCKET, HOME, home_rows, overlapping
from eddyline.session import shared_folder


def failure_pairs(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    failed: Column,
    within: str,
    bucket: str | None = None,
) -> DataFrame:
    """Two failures of a key with no other event between, less than ``within`` apart."""
    bound = span(within)
    base = df.select(*keys, ts, tie, F.coalesce(failed, F.lit(False)).alias("_failed"))
    spread = overlapping(base, ts, bucket_width(bound, bucket), behind=bound)
    line = Window.partitionBy(*keys, BUCKET).orderBy(ts, tie)
    before = F.lag(F.struct(ts, "_failed")).over(line)
    pairs = home_rows(spread.withColumn("_before", before)).where(
        F.col("_failed")
        & F.col("_before")["_failed"]
        & (micros(ts) - micros(F.col("_before")[ts]) < bound)
    )
    return pairs.select(*keys, F.col("_before")[ts].alias("first_ts"), F.col(ts).alias("last_ts"))


def failure_windows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    failed: Column,
    length: str,
    at_least: int = 2,
    bucket: str | None = None,
) -> DataFrame:
    """Failures counted in windows that the first failure opens: (keys, first_ts, last_ts, n_fail).

    A failure with no open window opens ``[t, t + length]``, both ends included.  A success
    inside cancels it; at its end ``at_least`` failures give a row.  At equal times failures come
    before successes.

    Events are first counted per (key, instant), combined map-side, which bounds a hot key by
    the resolution of its clock.  A window's content then depends on one ``length`` of look-ahead
    only.  Which failures open windows is a chain: a run's first failure does, then the first
    one after each closed window.  The chain is followed by doubling: in round k every opener
    known so far reaches the one 2^k windows on, so a run of n windows needs log2(n) joins on
    (key, time), however long it is, and no run is gathered.
    """
    spark = df.sparkSession
    bound = span(length)
    kind = column_type(df, ts)
    failed = F.coalesce(failed, F.lit(False))
    instants = (
        df.select(*keys, micros(ts).alias("_us"), failed.alias("_failed"))
        .groupBy(*keys, "_us")
        .agg(
            F.count_if("_failed").alias("_fails"),
            F.count_if(~F.col("_failed")).alias("_passes"),
        )
    )
    spread = overlapping(
        instants.withColumn("_at", F.timestamp_micros("_us")),
        "_at", bucket_width(bound, bucket), behind=bound, ahead=2 * bound,
    ).drop("_at")
    parts = [*keys, BUCKET]
    line = Window.partitionBy(*parts).orderBy("_us")
    failing = F.col("_fails") > 0
    events = spread.withColumns(
        {
            "_before": F.lag(F.struct("_us", "_passes")).over(line),
            "_fails_upto": F.sum("_fails").over(line),
            "_passes_upto": F.sum("_passes").over(line),
        }
    ).withColumn(
        # A run starts where no failure of the last ``length`` could have left a window open.
        "_starts",
        failing
        & (
            F.col("_before").isNull()
            | (F.col("_before")["_passes"] > 0)
            | (F.col("_us") - F.col("_before")["_us"] > bound)
        ),
    )
    # Every failure gets a second row at the end of the window it would open.  What a window
    # holds is the difference of two running counts, so a crowded window costs no more than an
    # empty one.
    opening = F.col(HOME) & failing
    end = F.when(opening, F.col("_us") + bound)
    marked = events.withColumn("_at", F.explode(F.array_compact(F.array("_us", end)))).withColumn(
        "_ends", F.col("_at") > F.col("_us")
    )
    event = lambda column: F.when(~F.col("_ends"), column)
    upto = (
        Window.partitionBy(*parts)
        .orderBy("_at", "_ends")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    after = (
        Window.partitionBy(*parts)
        .orderBy(F.desc("_at"), F.desc("_ends"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    failures = (
        marked.withColumns(
            {
                "_n": F.sum(event(F.col("_fails"))).over(upto) - F.col("_fails_upto") + F.col("_fails"),
                "_passed": F.sum(event(F.col("_passes"))).over(upto)
                - F.col("_passes_upto") + F.col("_passes") > 0,
                "_last": F.max(event(F.when(failing, F.col("_us")))).over(upto),
                "_then": F.last(
                    event(F.when(failing, F.struct("_us", "_starts"))), ignorenulls=True
                ).over(after),
            }
        )
        .where(F.col(HOME) & F.col("_ends"))
        .select(
            *keys, "_us", "_starts", "_n", "_last", "_passed",
            F.when(~F.col("_passed") & ~F.col("_then")["_starts"], F.col("_then")["_us"]).alias("_to"),
        )
    )
    # Read once more in every round below, so kept in the shared folder.
    shared_folder(spark)
    failures = failures.checkpoint()
    openers = failures.where("_starts").select(*keys, "_us")
    jumps = failures.where("_to IS NOT NULL").select(*keys, "_us", "_to")
    while not jumps.isEmpty():
        reached = openers.join(jumps, [*keys, "_us"]).select(*keys, F.col("_to").alias("_us"))
        onward = jumps.select(*keys, F.col("_us").alias("_to"), F.col("_to").alias("_far"))
        openers = openers.unionByName(reached.checkpoint())
        jumps = (
            jumps.join(onward, [*keys, "_to"])
            .select(*keys, "_us", F.col("_far").alias("_to"))
            .checkpoint()
        )
    alerts = failures.where(~F.col("_passed") & (F.col("_n") >= at_least)).join(
        openers, [*keys, "_us"], "left_semi"
    )
    return alerts.select(
        *keys,
        from_micros(F.col("_us"), kind).alias("first_ts"),
        from_micros(F.col("_last"), kind).alias("last_ts"),
        F.col("_n").alias("n_fail"),
    )


def alert_text(user: Column, first: Column, last: Column, count: Column) -> Column:
    """The alert as one line of text."""
    # The wording of the alert.
    return F.concat(
        user.cast("string"), F.lit("在"), first.cast("string"), F.lit("到"), last.cast("string"),
        F.lit("之间登录失败"), count.cast("string"), F.lit("次！"),
    )
