"""Event sequences: strict, looping and relaxed, with a time bound and timeouts.

A pattern is a list of ``Step``s.  Results have one struct column per step, named after it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import micros, span
from eddyline.operators.timeline import (
    BUCKET, HOME, following, home_rows, in_slots, join_summary, overlapping,
)


@dataclass(frozen=True)
class Step:
    name: str
    condition: Column


def bucket_width(bound: int, asked: str | None = None) -> int:
    """Bucket length for a time bound, unless one is asked for.

    Eight bounds split a hot key well and copy an eighth of the rows; where one key is so busy
    that this is too much for a task, a shorter bucket copies more and splits further.
    """
    return span(asked) if asked else 8 * bound


def strict_sequence(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str],
    steps: Sequence[Step],
    columns: Sequence[str],
    within: str | None = None,
    bucket: str | None = None,
    slot: str | None = None,
) -> DataFrame:
    """Rows whose directly following rows fulfil the further steps.

    ``keys`` empty means the whole stream is one sequence.  ``within`` is exclusive: the last
    row comes less than that after the first.  With a bound, neighbours come from overlapping
    buckets in one shuffle; without one, from any distance by ``following``, in slots of a day.

    ``slot`` asks for the second way with slots of that length, bound or not: no row is copied, and
    a busy key falls into as many pieces as it has slots, however long the bound is.
    """
    order = [ts, *tie]
    fits = [F.coalesce(s.condition, F.lit(False)) for s in steps]
    row = F.struct(*columns, F.col(ts).alias("_ts"), F.array(*fits).alias("_fits"))
    further = len(steps) - 1
    needed = list(dict.fromkeys([*keys, *order, "_me"]))
    base = df.withColumn("_me", row).select(*needed)
    if within is not None and slot is None:
        bound = span(within)
        width = bucket_width(bound, bucket)
        spread = overlapping(base, ts, width, ahead=bound)
        line = Window.partitionBy(*keys, BUCKET).orderBy(*order)
        nexts = F.array(*[F.lead("_me", i).over(line) for i in range(1, further + 1)])
        found = home_rows(spread.withColumn("_next", nexts))
    else:
        found = following(
            base, keys, ts, order, "_me", further, span(slot or "1 day")
        ).where(F.size("_next") == further)
    all_steps = [F.col("_me"), *[F.col("_next")[i] for i in range(further)]]
    matches = F.lit(True)
    for i, step_row in enumerate(all_steps):
        matches = matches & F.coalesce(step_row["_fits"][i], F.lit(False))
    if within is not None:
        matches = matches & (micros(all_steps[-1]["_ts"]) - micros(ts) < span(within))
    return found.where(matches).select(
        *[
            F.struct(*[r[c].alias(c) for c in columns]).alias(s.name)
            for s, r in zip(steps, all_steps)
        ]
    )


def loop(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str],
    condition: Column,
    times: int,
    columns: Sequence[str],
    within: str | None = None,
    bucket: str | None = None,
    slot: str | None = None,
) -> DataFrame:
    """``times`` rows in a row that fulfil one condition."""
    steps = [Step(f"s{i + 1}", condition) for i in range(times)]
    return strict_sequence(df, keys, ts, tie, steps, columns, within, bucket, slot)


def relaxed_sequence(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: Sequence[str],
    steps: Sequence[Step],
    columns: Sequence[str],
    within: str,
    bucket: str | None = None,
    slot: str | None = None,
) -> DataFrame:
    """For every first-step row, the first later row of each further step, others may intervene.

    Every start is kept: ``tag`` is ``matched`` when the last step comes less than ``within``
    after the start, else ``timeout``, with the steps not reached in time left null.  Followers
    are found from the last step backwards with a running frame, so the work is linear in the
    rows of a bucket, and rows of no step are dropped before the shuffle.

    ``slot`` asks for slots of that length in place of buckets: no row is copied, and a busy key falls
    into as many pieces as it has slots.  Each slot then tells the earlier ones, for every step, the rows
    that a sequence waiting for that step would take in it; these few are put in key order and chained.
    """
    bound = span(within)
    fits = [f"_fit{i}" for i in range(len(steps))]
    base = (
        df.where(reduce(or_, [s.condition for s in steps]))
        .withColumns({f: F.coalesce(s.condition, F.lit(False)) for f, s in zip(fits, steps)})
        .withColumn("_me", F.struct(*columns, F.col(ts).alias("_ts")))
        .select(*dict.fromkeys([*keys, ts, *tie, *fits, "_me"]))
    )
    if slot is None:
        found = overlapping(base, ts, bucket_width(bound, bucket), ahead=bound)
    else:
        found = in_slots(base, keys, ts, span(slot)).withColumn(HOME, F.lit(True))
    later = (
        Window.partitionBy(*keys, BUCKET)
        .orderBy(*[F.desc(c) for c in [ts, *tie]])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    last = len(steps) - 1
    found = found.withColumn(f"_chain{last}", F.when(F.col(fits[last]), F.array("_me")))
    for i in range(last - 1, -1, -1):
        rest = F.last(f"_chain{i + 1}", ignorenulls=True).over(later)
        chain = F.concat(F.array("_me"), F.coalesce(rest, F.expr("array()").cast(_type(found, last))))
        found = found.withColumn(f"_chain{i}", F.when(F.col(fits[i]), chain))
    starts = found.where(F.col(HOME) & F.col(fits[0]))
    if slot is not None:
        starts = _carried_on(starts, found, keys, [ts, *tie], last)
    starts = starts.withColumn(
        "_chain",
        F.filter("_chain0", lambda r: micros(r["_ts"]) - micros(F.col(ts)) < bound),
    )
    reached = [F.get("_chain", F.lit(i)) for i in range(len(steps))]
    return starts.select(
        *[
            F.when(r.isNotNull(), F.struct(*[r[c].alias(c) for c in columns])).alias(s.name)
            for s, r in zip(steps, reached)
        ],
        F.when(F.size("_chain") == len(steps), "matched").otherwise("timeout").alias("tag"),
    )


def _carried_on(
    starts: DataFrame, found: DataFrame, keys: Sequence[str], order: Sequence[str], last: int
) -> DataFrame:
    """Chains from step 0 that end early in their slot, with what later slots add to them.

    A slot's answer to a sequence that waits for step i: the chain of its first row that fits.  Where that
    ends early, it goes on with the answer of the slots behind it to the step it then waits for.
    """
    nothing = F.expr("array()").cast(_type(found, last))
    place = F.struct(*order)

    def whole(i: int) -> Column:
        chain, rest = F.col(f"_chain{i}"), nothing
        for j in range(i + 1, last + 1):
            answer = F.coalesce(f"_after{j}", nothing)
            rest = F.when(F.size(chain) == j - i, answer).otherwise(rest)
        return F.when(chain.isNotNull(), F.concat(chain, rest))

    slots = found.groupBy(*keys, BUCKET).agg(
        *[
            F.min_by(f"_chain{i}", F.when(F.col(f"_chain{i}").isNotNull(), place)).alias(f"_chain{i}")
            for i in range(1, last + 1)
        ]
    )
    behind = Window.partitionBy(*keys).orderBy(F.desc(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    for i in range(last, 0, -1):
        answer = F.last(f"_whole{i}", ignorenulls=True).over(behind)
        slots = slots.withColumn(f"_whole{i}", whole(i)).withColumn(f"_after{i}", answer)
    carried = slots.select(*keys, BUCKET, *[f"_after{i}" for i in range(1, last + 1)])
    joined = join_summary(starts, carried, [*keys, BUCKET], "left")
    return joined.withColumn("_chain0", whole(0))


def _type(df: DataFrame, last: int):
    return df.schema[f"_chain{last}"].dataType
