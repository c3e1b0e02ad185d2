"""Streaming forms of windowed questions that need more than the batch operator on a stream.

``windows.tumbling``, ``windows.sliding_counts``, ``salting.salted_counts`` and
``joins.interval_join`` take streams as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.functions.hashing import bitmap_offset
from eddyline.functions.times import interval, micros, span, timed
from eddyline.operators.windows import sliding_counts, sliding_rows
from eddyline.streaming.filters import met_sql


def distinct_per_window(
    stream: DataFrame, ts: str, size: str, column: str, name: str = "uv"
) -> DataFrame:
    """Exact distinct values per tumbling window of a watermarked stream.

    The state keeps each (window, value) once, spread over all tasks by both.
    """
    seen = timed(stream, ts).select(F.window(ts, size).alias("w"), column).dropDuplicates(["w", column])
    counts = seen.groupBy("w").agg(F.count(F.lit(1)).alias(name))
    return counts.select(F.col("w.end").alias("window_end"), name)


def bitmap_pieces(stream: DataFrame, ts: str, size: str, value: Column) -> DataFrame:
    """Bitmap pieces per tumbling window, for update mode: changed pieces come out as they fill.

    Kept with ``sinks.WindowValues`` by piece, this gives a unique-visitor count that is brought
    up to date with every micro-batch.
    """
    at = timed(stream, ts).select(ts, bitmap_offset(value).alias("_at"))
    pieces = at.groupBy(F.window(ts, size).alias("w"), F.bitmap_bucket_number("_at").alias("piece"))
    bits = pieces.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bits"))
    return bits.select("piece", F.col("w.end").alias("window_end"), "bits")


def sql_window_counts(
    spark: SparkSession, view: str, item: str, ts: str, condition: str
) -> DataFrame:
    """Counts per sliding window as SQL text over a streaming view with a watermark on ``ts``.

    Rows that do not meet the condition still move the watermark: it is tied to the event time, so that
    it is applied behind the watermark.  Ranking is left to the sink: rank functions are not available
    on streams.
    """
    return spark.sql(f"""
        SELECT {item}, w.end AS window_end, count({item}) AS cnt
        FROM (SELECT {item}, window({ts}, '1 hour', '5 minutes') AS w FROM {view} WHERE {met_sql(ts, condition)})
        GROUP BY {item}, w
    """)


def late_sliding_counts(
    stream: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    bound: str,
    lateness: str,
    panes: bool = False,
) -> DataFrame:
    """Sliding counts that late rows still correct, for update mode and ``sinks.TopNTable``.

    A window takes rows until the progress of time is ``bound`` plus ``lateness`` past its end;
    every micro-batch hands on the counts it changed, early and corrected ones alike.  Spark holds
    rows against the progress before the last micro-batch, so never drops one too early.
    ``sinks.LateRouter`` with the same figures keeps the rows that come later still.

    ``panes`` hands on counts of slide-long panes instead, for a ``TopNTable`` with the same figures in
    ``sliding``: a row is counted, kept and written once and not once per window.  ``window_end`` is that of
    the pane's last window, until which it takes rows, and ``seen_us`` its largest event time.
    """
    delay, step = span(bound) + span(lateness), span(slide)
    if not panes:
        # A window's count is complete in each micro-batch only if its rows are counted for it.
        return sliding_counts(
            stream.withWatermark(ts, f"{delay} microseconds"), ts, size, slide, keys, how=sliding_rows
        )
    if span(size) % step:
        raise ValueError("panes need a size that is a multiple of the slide")
    if stream.schema[ts].metadata.get("spark.watermarkDelayMs", 0) * 1000 > delay:
        raise ValueError(f"the watermark on {ts} trails by more than the bound and the lateness")
    # The time goes on to the pane's last window, and the watermark with it: as if it were not moved.
    ahead = span(size) - step
    moved = timed(stream, ts).withColumn("_last", F.col(ts) + interval(ahead))
    counts = moved.withWatermark("_last", f"{delay + ahead} microseconds").groupBy(
        F.window("_last", slide).alias("w"), *keys
    ).agg(F.count(F.lit(1)).alias("cnt"), F.max(micros(ts)).alias("seen_us"))
    return counts.select(*keys, F.col("w.end").alias("window_end"), "cnt", "seen_us")
