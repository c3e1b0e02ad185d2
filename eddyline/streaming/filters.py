"""Filters on streams whose watermark is to follow every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.times import micros

# Fixed value: the earliest instant of a timestamp, in microseconds.
_EARLIEST = -(1 << 63)


def met(ts: str, condition: Column | str) -> Column:
    """The condition, tied to the event time.

    Spark moves a filter that does not mention the event time below the watermark, which then follows
    only the rows that pass.  Tied to the event time, it is applied behind the watermark.
    """
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return F.when(micros(ts) >= F.lit(_EARLIEST), condition)


def met_sql(ts: str, condition: str) -> str:
    """The same as SQL text."""
    return f"CASE WHEN unix_micros(CAST({ts} AS TIMESTAMP)) >= {_EARLIEST}L THEN ({condition}) END"


def keep(stream: DataFrame, ts: str, condition: Column | str) -> DataFrame:
    """Rows that meet a condition; those that do not still move the watermark on ``ts``.

    On tables a plain filter, which reaches the scan.
    """
    return stream.where(met(ts, condition) if stream.isStreaming else condition)
