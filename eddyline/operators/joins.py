"""Joins of two event streams by key and time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import bucket, interval, micros, span, timed
from eddyline.operators.patterns import bucket_width
from eddyline.operators.timeline import BUCKET, HOME, join_summary, neighbours, overlapping


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    before: str,
    after: str,
    lower_inclusive: bool = True,
    upper_inclusive: bool = True,
) -> DataFrame:
    """All pairs of equal keys with ``right_ts`` from ``left_ts - before`` to ``left_ts + after``.

    Column names other than ``keys`` must differ.  Time buckets as long as the interval join the
    equality keys, and a right row goes to the (at most two) buckets its partners can be in.  A
    hot key is thereby cut into buckets, and only rows near each other in time are ever compared.
    Works on two streams when both times carry a watermark.  A null time is an error.
    """
    left, right = timed(left, left_ts), timed(right, right_ts)
    low, high = span(before), span(after)
    width = max(low + high, 1)
    lefts = left.withColumn(BUCKET, bucket(micros(left_ts), width))
    us = micros(right_ts)
    rights = right.withColumn(
        BUCKET, F.explode(F.sequence(bucket(us - high, width), bucket(us + low, width)))
    )
    # Written on the columns themselves, so that a stream can tell when to forget a row.
    earliest = F.col(left_ts) - interval(low)
    latest = F.col(left_ts) + interval(high)
    over_low = F.col(right_ts) >= earliest if lower_inclusive else F.col(right_ts) > earliest
    under_high = F.col(right_ts) <= latest if upper_inclusive else F.col(right_ts) < latest
    joined = lefts.join(rights, [*keys, BUCKET], "inner")
    return joined.where(over_low & under_high).drop(BUCKET)


def outer_interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    before: str,
    after: str,
    how: str = "full",
) -> DataFrame:
    """``interval_join`` with the rows that have no partner: ``left``, or ``full`` for those of both sides.

    A row without a partner comes once, with nulls in place of the other side.  A null key has no
    partner.  The side that may stay alone is never copied to buckets, only the other one is, so nobody
    is taken for alone in a bucket while the partner is in the next; for ``full`` the rows of the right
    side that stay alone are a join of their own.  On two streams, both with watermarks, a lone row comes
    out when the watermark says that no partner can follow, and is then forgotten.
    """
    if how not in ("left", "full"):
        raise ValueError("how is left or full")
    left, right = timed(left, left_ts), timed(right, right_ts)
    low, high = span(before), span(after)
    found = _beside(left, right, keys, left_ts, right_ts, low, high, "left")
    if how == "left":
        return found
    if not right.isStreaming:
        alone = _beside(right, left, keys, right_ts, left_ts, high, low, "left_anti")
    else:  # the times of a row are never null, those of a partner that is not there are
        alone = _beside(right, left, keys, right_ts, left_ts, high, low, "left").where(F.col(left_ts).isNull())
    return found.unionByName(alone, allowMissingColumns=True)


def _beside(
    rows: DataFrame, others: DataFrame, keys: Sequence[str], ts: str, other_ts: str, low: int, high: int, how: str
) -> DataFrame:
    """Rows with the others from ``ts - low`` to ``ts + high``; the others go to buckets of time."""
    width = max(low + high, 1)
    us = micros(other_ts)
    near = F.explode(F.sequence(bucket(us - high, width), bucket(us + low, width)))
    named = {k: f"_other_{k}" for k in keys}
    there = others.withColumnsRenamed(named).withColumn("_other_bucket", near)
    here = rows.withColumn(BUCKET, bucket(micros(ts), width))
    # In the join itself, and on the columns themselves, so that a stream can tell when to forget a row.
    meets = (
        (F.col(BUCKET) == F.col("_other_bucket"))
        & (F.col(other_ts) >= F.col(ts) - F.lit(dt.timedelta(microseconds=low)))
        & (F.col(other_ts) <= F.col(ts) + F.lit(dt.timedelta(microseconds=high)))
    )
    for key, other in named.items():
        meets &= F.col(key) == F.col(other)
    return here.join(there, meets, how).drop(BUCKET, "_other_bucket", *named.values())


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    left_ts: str,
    right_ts: str,
    wait: str,
    left_tie: str,
    right_tie: str,
    tags: tuple[str, str, str] = ("matched", "pay_no_receipt", "receipt_no_pay"),
    bucket_size: str | None = None,
    slot: str | None = None,
) -> DataFrame:
    """One-to-one matching of two streams: every row waits ``wait`` for a partner of the other.

    A row pairs with the row just before it in key order when that is of the other side, still
    waiting, and at most ``wait`` old; a newer row of the same side takes over the wait.  With
    unique keys this is the full outer match within ``wait``.  Rows: the keys, both times and
    ties, and ``tag``; every input row is in exactly one result row.

    Rows that could pair form chains, and pairs are the 1st and 2nd, 3rd and 4th ... of a chain.
    Chains are found inside time buckets; one summary row per (key, bucket) carries the position
    over bucket edges, so no key is gathered.  ``slot`` asks for slots of that length in place of
    buckets with copies of the rows near their edges; neighbours are then carried over too.
    """
    bound = span(wait)
    side = lambda df, ts, tie, n: df.select(
        *key, F.col(ts).alias("_ts"), F.col(tie).alias("_tie"), F.lit(n).alias("_side")
    )
    both = side(left, left_ts, left_tie, 0).unionByName(side(right, right_ts, right_tie, 1))
    order = ["_ts", "_side", "_tie"]
    me = F.struct(*order)
    parts = [*key, BUCKET]
    line = Window.partitionBy(*parts).orderBy(*order)
    near = lambda a, b: (a["_side"] != b["_side"]) & (micros(b["_ts"]) - micros(a["_ts"]) <= bound)
    if slot is None:
        spread = overlapping(both, "_ts", bucket_width(bound, bucket_size), behind=bound, ahead=bound)
        beside = spread.withColumns({"_prev": F.lag(me).over(line), "_next": F.lead(me).over(line)})
    else:
        beside = neighbours(both, key, "_ts", order, span(slot)).withColumn(HOME, F.lit(True))
    linked = beside.withColumns(
        {
            "_joins_prev": F.coalesce(near(F.col("_prev"), me), F.lit(False)),
            "_joins_next": F.coalesce(near(me, F.col("_next")), F.lit(False)),
        }
    )
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        linked.where(HOME)
        .withColumn("_row", F.row_number().over(line))
        .withColumn("_start", F.max(F.when(~F.col("_joins_prev"), F.col("_row"))).over(upto))
    )
    # What a bucket hands on: its length and, if a chain starts in it, where the last one does.
    along = Window.partitionBy(*key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("_rows"), F.max("_start").alias("_last_start"))
        .withColumn("_base", F.coalesce(F.sum("_rows").over(along), F.lit(0)))
        .withColumn("_open_start", F.max(F.col("_base") + F.col("_last_start")).over(along))
        .select(*parts, (F.col("_base") - F.col("_open_start")).alias("_carry"))
    )
    position = F.when(
        F.col("_start").isNotNull(), F.col("_row") - F.col("_start")
    ).otherwise(F.col("_row") + F.col("_carry"))
    first_of_pair = F.pmod(position, F.lit(2)) == 0
    done = join_summary(placed, carried, parts, "left").where(
        ~first_of_pair | ~F.col("_joins_next")
    ).withColumn("_pair", ~first_of_pair)
    pick = lambda n, f: F.when(F.col("_side") == n, F.col(f"_{f}")).when(
        F.col("_pair"), F.col("_prev")[f"_{f}"]
    )
    return done.select(
        *key,
        pick(0, "ts").alias(left_ts),
        pick(0, "tie").alias(left_tie),
        pick(1, "ts").alias(right_ts),
        pick(1, "tie").alias(right_tie),
        F.when(F.col("_pair"), tags[0])
        .when(F.col("_side") == 0, tags[1])
        .otherwise(tags[2])
        .alias("tag"),
    )
