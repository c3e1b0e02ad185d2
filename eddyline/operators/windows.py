"""Event-time windows: tumbling and sliding, half-open and aligned to the epoch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import bucket, column_type, from_micros, micros, required, span, timed


def tumbling(
    df: DataFrame, ts: str, size: str, keys: Sequence[str] = (), aggs: Sequence[Column] | None = None
) -> DataFrame:
    """Aggregate per tumbling window (and keys); adds ``window_end``.

    Aggregates are combined map-side, so neither a hot key nor the key-less form sends raw rows
    to one task.  Works on streams with a watermark on ``ts``.  A null event time is an error, here and
    in the other windows.
    """
    aggs = aggs or [F.count(F.lit(1)).alias("cnt")]
    out = timed(df, ts).groupBy(F.window(ts, size).alias("w"), *keys).agg(*aggs)
    return out.withColumn("window_end", F.col("w.end")).drop("w")


@dataclass(frozen=True)
class Mergeable:
    """An aggregate in parts: of rows, of parts, of two parts (either may be null), and what it tells.

    The first two are one aggregate function each, as the parts are also merged along a window.
    """

    create: Callable[[Column], Column]
    merge: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]
    result: Callable[[Column], Column] = lambda part: part


def _added(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


#: The aggregates by name; ``sliding`` and its like also take a ``Mergeable`` of one's own.
KINDS = {
    "count": Mergeable(F.count, F.sum, _added),
    "sum": Mergeable(F.sum, F.sum, _added),
    "min": Mergeable(F.min, F.min, F.least),
    "max": Mergeable(F.max, F.max, F.greatest),
}


def distinct_sketch(bits: int = 12) -> Mergeable:
    """About how many distinct values, by a HyperLogLog sketch of ``2 ** bits`` registers per part.

    The standard error is about ``1.04 / sqrt(2 ** bits)``.  A window without a value has 0.
    """
    return Mergeable(
        lambda value: F.hll_sketch_agg(value, bits),
        lambda part: F.hll_union_agg(part),
        lambda a, b: F.coalesce(F.hll_union(a, b), a, b),
        lambda part: F.hll_sketch_estimate(part),
    )


Aggs = dict[str, tuple[str | Mergeable, Column]]
Parts = dict[str, tuple[Mergeable, Column]]


def _kept(aggs: Aggs) -> tuple[Parts, dict[str, Column]]:
    """Parts by name, and the results as columns over the merged parts.

    An average is the merged sum by the merged count.
    """
    parts: Parts = {}
    result = {}
    for name, (kind, value) in aggs.items():
        if kind == "avg":
            parts[f"_sum_{name}"], parts[f"_n_{name}"] = (KINDS["sum"], value), (KINDS["count"], value)
            result[name] = F.try_divide(f"_sum_{name}", f"_n_{name}")
        elif isinstance(kind, Mergeable) or kind in KINDS:
            how = kind if isinstance(kind, Mergeable) else KINDS[kind]
            parts[name] = (how, value)
            result[name] = how.result(F.col(name))
        else:
            raise ValueError(f"{kind} is none of {', '.join(KINDS)}, avg, and no Mergeable")
    return parts, result


def sliding(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], aggs: Aggs
) -> DataFrame:
    """Aggregates per sliding window and keys, on a table; adds ``window_end``.

    ``aggs``: name -> (count, sum, min, max, avg or a ``Mergeable``, column).  The size must be a multiple
    of the slide.  Rows are aggregated per slide-long pane first.  Time is cut into stretches of one
    window's length; a window then is a tail of one stretch's panes and a head of the next one's, so a
    pane goes to those two.  In a stretch the heads are one running aggregate and the tails another,
    which change only where a pane comes in or falls out; the windows in between are filled in last.
    So neither the shuffle nor the aggregation grows with the number of windows that a row is in: each
    window costs its own result row only.  Nothing is subtracted, so that sums of fractions stay as exact
    as they are, and minima and maxima work alike.
    """
    width, step = span(size), span(slide)
    if df.isStreaming or width % step:
        raise ValueError("panes need a table and a size that is a multiple of the slide")
    parts, result = _kept(aggs)
    kind = column_type(df, ts)
    of = width // step
    panes = df.groupBy(*keys, bucket(required(micros(ts), f"event time {ts}"), step).alias("_pane")).agg(
        *[how.create(value).alias(name) for name, (how, value) in parts.items()]
    )
    # The window numbered w ends with pane w; its panes are w - of + 1 to w.  A change at window w is a
    # pane that comes in, or one that window w no longer has; a stretch begins with a change of nothing.
    own, names = bucket(F.col("_pane"), of), list(parts)
    nothing = F.lit(None).cast(panes.select(F.struct(*names)).schema[0].dataType)

    def change(part: Column, at: Column, comes: Column, goes: Column) -> Column:
        return F.struct(part.alias("_part"), at.alias("_at"), comes.alias("_in"), goes.alias("_out"))

    pane = F.struct(*names)
    changes = F.array(
        change(own, F.col("_pane"), pane, nothing),
        change(own + 1, (own + 1) * of, nothing, nothing),
        change(own + 1, F.col("_pane") + of, nothing, pane),
    )
    # A pane that is the first of its stretch is in no window of the next.
    changes = F.when(F.pmod("_pane", F.lit(of)) == 0, F.slice(changes, 1, 1)).otherwise(changes)
    there = panes.select(*keys, F.explode(changes).alias("_c")).select(*keys, "_c.*")
    at = there.repartition(*keys, "_part").groupBy(*keys, "_part", "_at").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("_in", "_out")]
    )
    line = Window.partitionBy(*keys, "_part")
    upto = line.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = line.orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, -1)
    end_of_stretch = (F.col("_part") + 1) * of
    until = F.coalesce(F.lead("_at").over(line.orderBy("_at")), end_of_stretch)
    merged = at.withColumn("_any_in", F.count("_in").over(upto)).withColumn("_until", until)
    merged = merged.withColumns({f"_head_{n}": parts[n][0].merge(F.col(f"_in.{n}")).over(upto) for n in names})
    merged = merged.withColumn("_any_out", F.count("_out").over(behind))
    merged = merged.withColumns({f"_tail_{n}": parts[n][0].merge(F.col(f"_out.{n}")).over(behind) for n in names})
    filled = merged.where("_any_in + _any_out > 0").withColumn(
        "_window", F.explode(F.sequence(F.col("_at"), F.col("_until") - 1))
    )
    # What an aggregate makes of no part at all is not asked for.
    head = lambda n: F.when(F.col("_any_in") > 0, F.col(f"_head_{n}"))
    tail = lambda n: F.when(F.col("_any_out") > 0, F.col(f"_tail_{n}"))
    whole = filled.select(*keys, "_window", *[parts[n][0].join(head(n), tail(n)).alias(n) for n in names])
    end = from_micros((F.col("_window") + 1) * step, kind)
    return whole.select(
        *keys, end.alias("window_end"), *[c.alias(name) for name, c in result.items()]
    )


def sliding_rows(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], aggs: Aggs
) -> DataFrame:
    """The same result with every row spread over its windows: for streams and for sparse keys.

    Also for sizes that are no multiple of the slide.  Aggregates are combined map-side.
    """
    parts, result = _kept(aggs)
    rows = timed(df, ts).groupBy(F.window(ts, size, slide).alias("w"), *keys).agg(
        *[how.create(value).alias(name) for name, (how, value) in parts.items()]
    )
    return rows.select(
        *keys, F.col("w.end").alias("window_end"), *[c.alias(name) for name, c in result.items()]
    )


def sliding_chained(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], aggs: Aggs, time: str | None = None
) -> DataFrame:
    """The same result on a stream in append mode: a window over panes, chained on their own time.

    State holds panes, and windows of panes, instead of every row in every window.  ``time`` names a
    further column, the event time of the result, for operators chained behind it.
    """
    parts, result = _kept(aggs)
    panes = timed(df, ts).groupBy(F.window(ts, slide).alias("pane"), *keys).agg(
        *[how.create(value).alias(name) for name, (how, value) in parts.items()]
    )
    merged = panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("w"), *keys).agg(
        *[how.merge(F.col(name)).alias(name) for name, (how, _) in parts.items()]
    )
    told = [] if time is None else [F.window_time("w").alias(time)]
    return merged.select(
        *keys, F.col("w.end").alias("window_end"), *[c.alias(name) for name, c in result.items()], *told
    )


def sliding_counts(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    counted: Column | None = None,
    name: str = "cnt",
    how: Callable[..., DataFrame] = sliding,
) -> DataFrame:
    """Rows per sliding window and keys, by one of the three ways above."""
    return how(df, ts, size, slide, keys, {name: ("count", F.lit(1) if counted is None else counted)})
