"""Event time as whole microseconds, and back.

Window bounds, buckets and time limits are computed on integers, so TIMESTAMP and
TIMESTAMP_NTZ columns behave alike.  The session time zone must be UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": SECOND,
    "minute": 60 * SECOND,
    "hour": 3_600 * SECOND,
    "day": 86_400 * SECOND,
}
# Fixed value: the business day starts at local midnight, eight hours ahead of UTC.
LOCAL_DAY_OFFSET = 8 * 3_600 * SECOND


def span(text: str) -> int:
    """``"15 minutes"`` as microseconds."""
    number, unit = text.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp column."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def required(column: Column | str, name: str | None = None) -> Column:
    """The column, or an error where it is null."""
    name = name or (column if isinstance(column, str) else "a time or key")
    return F.coalesce(column, F.raise_error(F.lit(f"{name} must not be null")))


def timed(df: DataFrame, ts: str) -> DataFrame:
    """The frame, with an error where the event time ``ts`` is null; a stream's watermark on it stays.

    Windows and time joins would drop such a row without a word.
    """
    checked = df.withColumn(ts, required(ts, f"event time {ts}").cast(column_type(df, ts)))
    return checked.withMetadata(ts, df.schema[ts].metadata)


def from_micros(us: Column, like: T.DataType) -> Column:
    """Microseconds back to the timestamp type of the column they came from."""
    return F.timestamp_micros(us).cast(like)


def interval(us: int) -> Column:
    """A length of time as a literal to add to a timestamp column."""
    return F.make_dt_interval(secs=F.lit(us).cast("decimal(20,0)") / SECOND)


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def bucket(us: Column, width: int) -> Column:
    """Number of the ``width``-long time bucket, rounding down before the epoch too.

    Whole-number division throughout: a floating one would round instants just under a bucket's
    end up into the next one.
    """
    return F.call_function("div", us - F.pmod(us, F.lit(width)), F.lit(width))


def local_day(us: Column) -> Column:
    """Number of the local day an instant falls into."""
    return bucket(us + LOCAL_DAY_OFFSET, span("1 day"))


def stamp_text(ts: Column) -> Column:
    """A timestamp as text, the way reports print it."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
