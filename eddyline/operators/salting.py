"""Two-stage aggregation over salted keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.times import timed


def salt(columns: Sequence[str], buckets: int = 8) -> Column:
    """A salt from 1 to ``buckets`` that is the same when a task is run again.

    A random salt could place a row differently after an executor is lost.
    """
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)) + 1


def salted_counts(
    df: DataFrame,
    ts: str,
    size: str,
    salted_by: Column,
    keys: Sequence[str] = (),
    name: str = "pv",
) -> DataFrame:
    """Count per window (and keys) in two stages: per salt, then over the salts.

    A plain count is combined map-side and needs no salt; this is the explicit form, and the
    pattern for aggregates that cannot be combined.  On streams the second stage chains on the
    first stage's event time.
    """
    parts = (
        timed(df, ts).withColumn("_salt", salted_by)
        .groupBy(F.window(ts, size).alias("w1"), *keys, "_salt")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    whole = parts.groupBy(F.window(F.window_time("w1"), size).alias("w"), *keys).agg(
        F.sum("_n").alias(name)
    )
    return whole.select(*keys, F.col("w.end").alias("window_end"), name)
