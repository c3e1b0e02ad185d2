"""Late data on a table with an arrival column: allowed lateness and the late side output.

Batch replay of what a stream would have done with a watermark that follows every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import bucket, column_type, from_micros, micros, required, span
from eddyline.operators.timeline import BUCKET, running

SEEN = "_seen_max"
CLOSED = "_closed"
#: Length of the slots of arrival time that are ordered on their own; busy streams need shorter ones.
SLOT = "10 minutes"
#: So many windows are counted together where panes are summed up to windows, or as many as a pane has.
STRETCH_WINDOWS = 128


def with_progress(
    df: DataFrame, ts: str, arrival: str, tie: str, slot: str = SLOT
) -> DataFrame:
    """Add the largest event time (microseconds) among all earlier arrivals.

    A running maximum over the whole stream, computed per slot of arrival time; only the slot
    maxima, one row per slot, are put in one order.
    """
    slotted = df.withColumns(
        {
            BUCKET: bucket(required(micros(arrival), "arrival"), span(slot)),
            "_us": required(micros(ts), "event time"),
        }
    )
    return running(
        slotted, [], BUCKET, [F.col(arrival), F.col(tie)], {SEEN: F.col("_us")}, F.max,
        inclusive=False,
    ).drop(BUCKET, "_us")


def closed_windows(ts: str, size: str, slide: str, delay: int) -> Column:
    """How many of a row's sliding windows had closed when it arrived, first ones first.

    A window is closed when its end is not after the progress minus ``delay``.
    """
    width, step = span(size), span(slide)
    first_end = (bucket(micros(ts), step) + 1) * step
    past = F.col(SEEN) - delay - first_end
    # The very first arrival has no progress before it: nothing was closed.
    return F.when(past >= 0, F.least(bucket(past, step) + 1, F.lit(width // step))).otherwise(0)


def late_sliding_counts(
    df: DataFrame,
    ts: str,
    arrival: str,
    tie: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    bound: str,
    lateness: str,
    name: str = "cnt",
    slot: str = SLOT,
) -> DataFrame:
    """Final count of every sliding window after corrections by late rows.

    The watermark trails the largest event time by ``bound``; a window takes rows until it is
    ``lateness`` past its end.  Rows are counted per (pane, keys, number of windows already
    closed) before they are spread over their windows.
    """
    width, step = span(size), span(slide)
    kind = column_type(df, ts)
    panes = (
        with_progress(df.select(*keys, ts, arrival, tie), ts, arrival, tie, slot)
        .select(
            *keys,
            bucket(micros(ts), step).alias("_pane"),
            closed_windows(ts, size, slide, span(bound) + span(lateness)).alias(CLOSED),
        )
        .groupBy(*keys, "_pane", CLOSED)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    spread = panes.where(F.col(CLOSED) < width // step).withColumn(
        "_at", F.explode(F.sequence(F.col("_pane") + 1 + F.col(CLOSED), F.col("_pane") + width // step))
    )
    counts = spread.groupBy(*keys, "_at").agg(F.sum("_n").alias(name))
    return counts.select(*keys, from_micros(F.col("_at") * step, kind).alias("window_end"), name)


def late_rows(
    df: DataFrame,
    ts: str,
    arrival: str,
    tie: str,
    size: str,
    slide: str,
    bound: str,
    lateness: str,
    slot: str = SLOT,
) -> DataFrame:
    """Rows that came after all of their windows had closed for good."""
    seen = with_progress(df, ts, arrival, tie, slot)
    closed = closed_windows(ts, size, slide, span(bound) + span(lateness))
    return seen.where(closed == span(size) // span(slide)).drop(SEEN)


def late_corrections(
    df: DataFrame,
    ts: str,
    arrival: str,
    tie: str,
    size: str,
    slide: str,
    keys: Sequence[str],
    bound: str,
    lateness: str,
    slot: str = SLOT,
) -> DataFrame:
    """Windows that fired again: the count at the first firing and the corrected one."""
    width, step = span(size), span(slide)
    kind = column_type(df, ts)
    seen = with_progress(df.select(*keys, ts, arrival, tie), ts, arrival, tie, slot)
    panes = (
        seen.select(
            *keys,
            bucket(micros(ts), step).alias("_pane"),
            closed_windows(ts, size, slide, span(bound)).alias("_fired"),
            closed_windows(ts, size, slide, span(bound) + span(lateness)).alias(CLOSED),
        )
        .groupBy(*keys, "_pane", "_fired", CLOSED)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    spread = panes.where(F.col(CLOSED) < width // step).withColumn(
        "_at", F.explode(F.sequence(F.col("_pane") + 1 + F.col(CLOSED), F.col("_pane") + width // step))
    )
    on_time = F.col("_at") > F.col("_pane") + F.col("_fired")
    counts = spread.groupBy(*keys, "_at").agg(
        F.coalesce(F.sum(F.when(on_time, F.col("_n"))), F.lit(0)).alias("first_cnt"),
        F.sum("_n").alias("final_cnt"),
    )
    return counts.where("first_cnt <> final_cnt").select(
        *keys, from_micros(F.col("_at") * step, kind).alias("window_end"), "first_cnt", "final_cnt"
    )


def stretch_windows(size: str, slide: str) -> int:
    """How many windows a stretch has."""
    return max(span(size) // span(slide), STRETCH_WINDOWS)


def stretches(window_end: str, size: str, slide: str) -> Column:
    """Numbers of the stretches of windows that a pane is in, one or two; it goes by its last window's end."""
    of, length = span(size) // span(slide), stretch_windows(size, slide)
    last = bucket(micros(window_end), span(slide))
    return F.array_distinct(F.array(bucket(last - (of - 1), length), bucket(last, length)))


def windows_of_panes(
    panes: DataFrame, keys: Sequence[str], size: str, slide: str, name: str = "cnt", only: DataFrame | None = None
) -> DataFrame:
    """Count of every sliding window from the counts that its panes had reached while it was open.

    ``panes``: keys, ``window_end`` (of the pane's last window), ``CLOSED`` (how many of the pane's windows,
    first ones first, were closed by then) and ``name``, the rows of the pane up to then; of rows with the
    same ``CLOSED`` the largest count holds.  What a pane has grown by comes into its first open window and falls
    out behind its last one, so a pane makes two rows and each window one, however many windows a row is in.
    ``only``: a frame of ``_part``, the numbers of the ``stretches`` whose windows are wanted.
    """
    step = span(slide)
    of, length = span(size) // step, stretch_windows(size, slide)
    kind = column_type(panes, "window_end")
    rows = panes.withColumn("_part", F.explode(stretches("window_end", size, slide)))
    if only is not None:
        rows = rows.join(only, "_part", "left_semi")
    newest = (
        rows.select(*keys, "_part", bucket(micros("window_end"), step).alias("_last"), CLOSED, name)
        .repartition(*keys, "_part")
        .groupBy(*keys, "_part", "_last", CLOSED)
        .agg(F.max(name).alias("_n"))
    )
    before = F.lag("_n", 1, 0).over(Window.partitionBy(*keys, "_part", "_last").orderBy(CLOSED))
    # Within the stretch: the first window that takes the growth, and the first one behind.
    first = F.greatest(F.col("_last") - (of - 1) + F.col(CLOSED), F.col("_part") * length)
    behind = F.least(F.col("_last") + 1, (F.col("_part") + 1) * length)
    grown = newest.select(
        *keys, "_part", (F.col("_n") - before).alias("_d"), first.alias("_first"), behind.alias("_behind")
    ).where("_first < _behind")
    change = lambda at, by: F.struct(at.alias("_at"), by.alias("_d"))
    changes = F.array(change(F.col("_first"), F.col("_d")), change(F.col("_behind"), -F.col("_d")))
    at = grown.select(*keys, "_part", F.explode(changes).alias("_c")).select(*keys, "_part", "_c.*")
    line = Window.partitionBy(*keys, "_part").orderBy("_at")
    counted = at.groupBy(*keys, "_part", "_at").agg(F.sum("_d").alias("_d")).select(
        *keys, "_at", F.sum("_d").over(line).alias(name), F.lead("_at").over(line).alias("_until")
    )
    filled = counted.where(F.col(name) > 0).withColumn("_at", F.explode(F.sequence("_at", F.col("_until") - 1)))
    return filled.select(*keys, from_micros(F.col("_at") * step, kind).alias("window_end"), name)
