"""Unique visitors per window: exact, by bitmap, by sketch, and as a running count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.hashing import bitmap_offset
from eddyline.functions.times import bucket, micros, span, timed
from eddyline.operators.timeline import running
from eddyline.operators.windows import tumbling


def distinct_per_window(
    df: DataFrame, ts: str, size: str, *columns: str, name: str = "uv"
) -> DataFrame:
    """Exact number of distinct values (or value tuples) per tumbling window.

    Spark removes duplicates map-side, then by (window, value), then counts: no task ever holds
    a window's whole set.
    """
    return tumbling(df, ts, size, aggs=[F.count_distinct(*columns).alias(name)])


def sketch_per_window(
    df: DataFrame, ts: str, size: str, column: str, rsd: float = 0.01, name: str = "uv"
) -> DataFrame:
    """Approximate number of distinct values per window; state of a fixed size per window."""
    return tumbling(df, ts, size, aggs=[F.approx_count_distinct(column, rsd).alias(name)])


def sketch_pieces(
    df: DataFrame, ts: str, size: str, column: str, bits: int = 14, name: str = "sketch"
) -> DataFrame:
    """A sketch per tumbling window, to be stored: ``2 ** bits`` registers, however many values."""
    return tumbling(df, ts, size, aggs=[F.hll_sketch_agg(column, bits).alias(name)])


def united(
    pieces: DataFrame, by: Sequence[Column | str], sketch: str = "sketch", name: str = "uv"
) -> DataFrame:
    """About how many distinct values the pieces of each group have together.

    Pieces of several runs, days or sources; the values themselves are not looked at again.
    """
    return pieces.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(name))


def bitmap_state(df: DataFrame, ts: str, size: str, value: Column) -> DataFrame:
    """Mergeable bitmap pieces per window: (window_end, piece, bits).

    One piece covers 32,768 hash positions (4 KiB), so a window is spread over up to 16,384 rows
    and its pieces are built by as many tasks.  Positions are made unique first: a repeated
    visitor then costs its few bytes in the shuffle, and only the second, much smaller, stage
    handles bitmaps.  Pieces of several runs merge with ``merge_bitmaps``.
    """
    rows = timed(df, ts)
    seen = rows.select(F.window(ts, size).alias("w"), bitmap_offset(value).alias("_at")).distinct()
    return seen.groupBy(
        F.col("w.end").alias("window_end"), F.bitmap_bucket_number("_at").alias("piece")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bits"))


def merge_bitmaps(*states: DataFrame) -> DataFrame:
    """One state out of several, as when a day's new rows are added to a stored table."""
    both = states[0]
    for other in states[1:]:
        both = both.unionByName(other)
    return both.groupBy("window_end", "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(state: DataFrame, name: str = "uv") -> DataFrame:
    """Number of set bits per window."""
    return state.groupBy("window_end").agg(F.sum(F.bitmap_count("bits")).alias(name))


def running_distinct(
    df: DataFrame,
    ts: str,
    tie: str,
    size: str,
    value: Column,
    keep: Sequence[str],
    slot: str = "1 minute",
    name: str = "uv",
) -> DataFrame:
    """After every row, the number of distinct values its window has seen so far.

    A value's first row per window is a plain minimum, combined map-side, so a visitor with very
    many rows is not gathered anywhere.  First rows are then merged into the event order as +1
    steps and summed up slot by slot within the window.
    """
    rows = timed(df, ts).select(
        *keep,
        F.col(ts).alias("_ts"),
        F.col(tie).alias("_tie"),
        F.window(ts, size)["end"].alias("window_end"),
        value.alias("_value"),
    )
    steps = (
        rows.groupBy("window_end", "_value")
        .agg(F.min(F.struct("_ts", "_tie")).alias("_first"))
        .select("window_end", "_first.*", F.lit(1).alias("_step"))
    )
    merged = steps.unionByName(
        rows.drop("_value").withColumn("_step", F.lit(0)), allowMissingColumns=True
    ).withColumn("_slot", bucket(micros("_ts"), span(slot)))
    counted = running(
        merged,
        ["window_end"],
        "_slot",
        [F.col("_ts"), F.col("_tie"), F.desc("_step")],
        {name: F.col("_step")},
        F.sum,
    )
    return counted.where("_step = 0").select(*keep, "window_end", name)
