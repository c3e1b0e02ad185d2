"""Schemas of the event streams.  Files give the fields by position, without a header."""

from __future__ import annotations

from pyspark.sql import types as T


def fields(text: str) -> T.StructType:
    """A schema from ``"name type, ..."``; needs no session, unlike Spark's own DDL reader."""
    kinds = {
        "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
        "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
    }
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


USER_BEHAVIOR = fields(
    "userId long, itemId long, categoryId int, behavior string, timestamp long"
)
AD_CLICK = fields("userId long, adId long, province string, city string, timestamp long")
LOGIN = fields("userId long, ip string, eventType string, timestamp long")
ORDER = fields("orderId long, eventType string, txId string, eventTime long")
RECEIPT = fields("txId string, payChannel string, timestamp long")

# Event tables in parquet.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
