"""Ordered work on keyed streams without ever putting a whole key into one task.

A keyed stream may hold a third of all rows under one key, so ``partitionBy(key)`` alone is not
an option.  Two tools split a key by time and stay exact:

* ``overlapping``: for anything that only looks a bounded time ahead or behind.  Rows close to a
  bucket's edge are copied into the neighbour bucket; results are kept from home rows only.
  One shuffle, no second pass.
* ``running``, ``following`` and ``neighbours``: for running values and unbounded neighbours.  Each
  (key, slot) is worked on by itself, and one small summary row per (key, slot) carries over what
  earlier or later slots contribute.  No row is copied.

A null key is a key of its own.  A null event time is an error: the row has no place in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import bucket, micros, required

BUCKET = "_bucket"
HOME = "_home"


def overlapping(
    df: DataFrame, ts: str, width: int, behind: int = 0, ahead: int = 0
) -> DataFrame:
    """Add ``_bucket``, with copies so that each bucket sees ``behind`` before and ``ahead`` after it.

    A bucket then holds every row from its start minus ``behind`` to its end plus ``ahead``, so
    the true neighbour of a home row is present whenever it lies within these bounds.
    """
    us = required(micros(ts), "event time")
    first, last = bucket(us - ahead, width), bucket(us + behind, width)
    return df.withColumn(BUCKET, F.explode(F.sequence(first, last))).withColumn(
        HOME, F.col(BUCKET) == bucket(us, width)
    )


def home_rows(df: DataFrame) -> DataFrame:
    return df.where(HOME).drop(BUCKET, HOME)


def join_summary(df: DataFrame, summary: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Joins a summary per ``keys``; null keys meet their like, as they do in a window."""
    renamed = summary.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(renamed, same, how).drop(*[f"_of_{k}" for k in keys])


def running(
    df: DataFrame,
    keys: Sequence[str],
    slot: str,
    order: Sequence[Column],
    values: dict[str, Column],
    how: Callable[[Column], Column],
    inclusive: bool = True,
) -> DataFrame:
    """Running sum or maximum of ``values`` per key, computed slot by slot.

    ``slot`` is a column that grows with ``order``.  The slot totals are combined before the
    shuffle and number one row per (key, slot); only those are put in key order.
    ``inclusive=False`` leaves the row itself out.
    """
    inner = (
        Window.partitionBy(*keys, slot)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    outer = (
        Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    )
    is_sum = how is F.sum
    local = df.withColumns({name: how(value).over(inner) for name, value in values.items()})
    totals = df.groupBy(*keys, slot).agg(
        *[how(value).alias(f"_slot_{name}") for name, value in values.items()]
    )
    carried = totals.select(
        *keys,
        slot,
        *[how(F.col(f"_slot_{name}")).over(outer).alias(f"_before_{name}") for name in values],
    )
    joined = join_summary(local, carried, [*keys, slot], "left")

    def combine(name: str) -> Column:
        here, before = F.col(name), F.col(f"_before_{name}")
        if is_sum:
            return F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
        return F.greatest(here, before)

    return joined.withColumns({name: combine(name) for name in values}).drop(
        *[f"_before_{name}" for name in values]
    )


def in_slots(df: DataFrame, keys: Sequence[str], ts: str, width: int) -> DataFrame:
    """Add ``_bucket`` without copies, dealt once by (key, slot) for all that follows."""
    return df.withColumn(BUCKET, bucket(required(micros(ts), "event time"), width)).repartition(*keys, BUCKET)


def neighbours(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], width: int
) -> DataFrame:
    """The frame with the rows just before and after each of the same key: structs ``_prev``, ``_next``.

    They hold the columns ``order``, and are null at a key's ends.  The neighbour may be however far away:
    of each slot, only its first and last place are put in key order.  Keeps ``_bucket``.
    """
    me = F.struct(*order)
    slotted = in_slots(df, keys, ts, width)
    inner = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    local = slotted.withColumns({"_prev": F.lag(me).over(inner), "_next": F.lead(me).over(inner)})
    ends = slotted.groupBy(*keys, BUCKET).agg(F.min(me).alias("_head"), F.max(me).alias("_tail"))
    along = Window.partitionBy(*keys).orderBy(BUCKET)
    carried = ends.select(
        *keys, BUCKET, F.lag("_tail").over(along).alias("_before"), F.lead("_head").over(along).alias("_after")
    )
    return join_summary(local, carried, [*keys, BUCKET], "left").withColumns(
        {"_prev": F.coalesce("_prev", "_before"), "_next": F.coalesce("_next", "_after")}
    ).drop("_before", "_after")


def following(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    row: str,
    count: int,
    width: int,
    name: str = "_next",
) -> DataFrame:
    """The keys, order and column ``row``, with an array of the next ``count`` of the same key.

    They may be however far away.  Each slot's first ``count`` rows are all that an earlier slot can
    need, so only those are put in key order; the rest is cut off before their shuffle.
    """
    slotted = df.select(*dict.fromkeys([*keys, *order, row])).withColumn(
        BUCKET, bucket(required(micros(ts), "event time"), width)
    )
    inner = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    local = slotted.withColumns(
        {
            name: F.array_compact(
                F.array(*[F.lead(row, i).over(inner) for i in range(1, count + 1)])
            ),
            "_pos": F.row_number().over(inner),
        }
    )
    along = Window.partitionBy(*keys).orderBy(*order)
    heads = local.where(F.col("_pos") <= count).select(*keys, *order, BUCKET, "_pos", row)
    carried = (
        heads.withColumns(
            {
                "_earlier": F.lag(BUCKET).over(along),
                "_after": F.array_compact(
                    F.array(row, *[F.lead(row, i).over(along) for i in range(1, count)])
                ),
            }
        )
        .where((F.col("_pos") == 1) & F.col("_earlier").isNotNull())
        .select(*keys, F.col("_earlier").alias(BUCKET), "_after")
    )
    joined = join_summary(local, carried, [*keys, BUCKET], "left")
    all_next = F.when(F.col("_after").isNull(), F.col(name)).otherwise(
        F.slice(F.concat(name, "_after"), 1, count)
    )
    return joined.withColumn(name, all_next).drop("_after", "_pos", BUCKET)
