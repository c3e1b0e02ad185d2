"""Order payment in time: the state machine form (the pattern form is a relaxed sequence)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import column_type, from_micros, micros, span
from eddyline.operators.patterns import bucket_width
from eddyline.operators.timeline import BUCKET, HOME, neighbours, overlapping

TAGS = ("paid", "create_without_pay", "pay_without_create")


def with_transaction(orders: DataFrame, transaction: str = "txId") -> DataFrame:
    """Order events that name a transaction: payments.  Others would all meet under one empty key."""
    return orders.where((F.col(transaction).isNotNull()) & (F.col(transaction) != ""))


def order_states(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    created: Column,
    paid: Column,
    within: str,
    bucket: str | None = None,
    slot: str | None = None,
) -> DataFrame:
    """Every payment and every create that ran out of time, tagged: (key, ts, tie, tag).

    A create arms the order for ``within`` (end included) and a newer create arms it anew; a
    payment uses it up.  So only the event just before and just after decides, and it matters
    only within the time bound: one shuffle on (order, time bucket).  At equal times a create
    comes before a payment.  A timeout carries its create's time plus ``within``.

    ``slot`` asks for slots of that length in place of buckets: no row is copied, and a busy key falls
    into as many pieces as it has slots, however long the bound is.
    """
    bound = span(within)
    kind = column_type(df, ts)
    events = (
        df.where(created | paid)
        .withColumn("_paid", F.coalesce(paid, F.lit(False)))
        .select(key, ts, tie, "_paid")
    )
    line = [ts, "_paid", tie]
    if slot is None:
        spread = overlapping(events, ts, bucket_width(bound, bucket), behind=bound, ahead=bound)
        order = Window.partitionBy(key, BUCKET).orderBy(*line)
        me = F.struct(*line)
        near = spread.withColumns({"_prev": F.lag(me).over(order), "_next": F.lead(me).over(order)}).where(HOME)
    else:
        near = neighbours(events, [key], ts, line, span(slot))
    armed = F.coalesce(
        ~F.col("_prev")["_paid"] & (micros(ts) - micros(F.col("_prev")[ts]) <= bound),
        F.lit(False),
    )
    followed = F.coalesce(micros(F.col("_next")[ts]) - micros(ts) <= bound, F.lit(False))
    tagged = near.withColumn(
        "tag",
        F.when(F.col("_paid") & armed, TAGS[0])
        .when(F.col("_paid"), TAGS[2])
        .when(~followed, TAGS[1]),
    ).where("tag IS NOT NULL")
    at = F.when(F.col("_paid"), F.col(ts)).otherwise(from_micros(micros(ts) + bound, kind))
    return tagged.select(key, at.alias(ts), tie, "tag")
