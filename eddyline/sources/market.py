"""Generated marketing events: an endless stream, and a repeatable batch form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.sources.files import ASCENDING

# The behaviors and channels of the marketing events, and rows per second.
BEHAVIORS = ("CLICK", "DOWNLOAD", "INSTALL", "UNINSTALL")
CHANNELS = ("app store", "wechat", "weibo", "tieba")
ROWS_PER_SECOND = 10


# Factors that mix a row number and a seed into 32 bits.
MIX, SEED_MIX = 2_654_435_761, 40_503


def _mixed(number: Column, seed: int) -> Column:
    low = number.cast("long").bitwiseAND(F.lit((1 << 31) - 1).cast("long"))
    return F.pmod(low * F.lit(MIX) + F.lit(seed * SEED_MIX), F.lit(1 << 32))


def _pick(values: tuple[str, ...], number: Column, seed: int) -> Column:
    at = F.shiftright(_mixed(number, seed), 16) % len(values) + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def _columns(number: Column, ts: Column, seed: int) -> list[Column]:
    return [
        _mixed(number, seed + 2).alias("userId"),
        _pick(BEHAVIORS, number, seed).alias("behavior"),
        _pick(CHANNELS, number, seed + 1).alias("channel"),
        ts.alias("ts"),
    ]


def market_stream(
    spark: SparkSession, rows_per_second: int = ROWS_PER_SECOND, seed: int = 0
) -> DataFrame:
    """Random marketing events as they come, with event time now."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select(*_columns(F.col("value"), F.col("timestamp"), seed)).withWatermark(
        "ts", ASCENDING
    )


def market_events(df: DataFrame, number: str, ts: str, seed: int = 0) -> DataFrame:
    """The same events derived from the rows of a table: one per row, at the row's time."""
    return df.select(*_columns(F.col(number), F.col(ts), seed))
