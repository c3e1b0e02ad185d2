"""Tables kept up to date by micro-batches: keyed counts, Top-N with change rows, late rows.

A micro-batch that is run again after a failure overwrites what it wrote before, so it leaves the same
rows behind.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.functions.times import bucket, micros, span
from eddyline.operators import late
from eddyline.operators.topn import top_n_changes, top_n_per_window
from eddyline.schemas import fields


class Folder:
    """A folder of a shared file system, through the session's own access to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        self.files = where.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, below: str = "") -> list[str]:
        """Names of the folders in it, without hidden ones."""
        if not self.files.exists(self._at(below)):
            return []
        found = [s.getPath().getName() for s in self.files.listStatus(self._at(below)) if s.isDirectory()]
        return sorted(n for n in found if n[0] not in "._")

    def holds(self, name: str) -> bool:
        return self.files.exists(self._at(name))

    def remove(self, name: str) -> None:
        self.files.delete(self._at(name), True)


class Progress:
    """The largest event time so far: one value, written anew by every micro-batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def upto(self, batch_id: int) -> int | None:
        """In microseconds, as of a batch; none before the first one."""
        try:
            seen = self.spark.read.schema("us long").parquet(f"{self.path}/batch_id={batch_id}")
        except AnalysisException:
            return None
        return seen.first()["us"]

    def put(self, batch_id: int, *known: int | None) -> None:
        us = F.lit(max((us for us in known if us is not None), default=None)).cast("long")
        self.spark.range(1).select(us.alias("us")).write.mode("overwrite").parquet(
            f"{self.path}/batch_id={batch_id}"
        )


#: So many runs of one length are merged into one of the next.
FAN = 8


def _date(day: str) -> dt.date:
    return dt.date.fromisoformat(day.removeprefix("day="))


class WindowValues:
    """One value per (window_end, key), of which each batch brings the changed ones.

    A log of sorted-out runs: a batch writes its own rows, and the value of a later batch counts.  Every
    ``FAN``-th batch merges the last runs into one, as long as the largest power of ``FAN`` that divides
    their number; so a value is written about log(batches) times, however large the table is, and a
    reader meets at most ``FAN`` runs of each length.  In a run rows lie by the day of their window, and a
    batch reads the days it touches.  Runs that a merged one covers stay for one more batch, so that one
    that is run again after a failure starts from the same state; a run counts once it is complete.
    ``keep`` (such as ``"30 days"``) drops days that are so much older than the newest.  Of an empty
    table the columns are not known yet: ``latest`` then gives a frame without any.  ``also`` names further
    columns of the key.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, value: str = "cnt", keep: str | None = None,
        also: Sequence[str] = (),
    ):
        self.spark, self.path, self.key, self.value = spark, path, key, value
        self.keys = [key, *also]
        self.keep = None if keep is None else span(keep) // span("1 day")
        self.runs = Folder(spark, f"{path}/runs")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.put(batch, batch_id)

    @staticmethod
    def _name(first: int, last: int) -> str:
        return f"run={first}-{last}"

    def _complete(self) -> list[tuple[int, int]]:
        """First and last batch of every complete run, the newest and among them the longest first."""
        names = [n for n in self.runs.names() if self.runs.holds(f"{n}/_SUCCESS")]
        found = [tuple(map(int, n.removeprefix("run=").split("-"))) for n in names]
        return sorted(found, key=lambda run: (-run[1], run[0]))

    def _cover(self, upto: int | None = None, since: int = 0, but: tuple[int, int] | None = None) -> list[tuple[int, int]]:
        """The fewest runs that hold what the batches from one to another brought."""
        out: list[tuple[int, int]] = []
        for run in self._complete():
            known = (upto is None or run[1] <= upto) and run[0] >= since and run != but
            if known and (not out or run[1] < out[-1][0]):
                out.append(run)
        return out

    def _read(self, cover: list[tuple[int, int]], days: list[str] | None = None) -> DataFrame:
        """The rows of some runs with ``_last``, the last batch of theirs."""
        about = f"{self.path}/columns"
        schema = self.spark.read.parquet(about).schema
        paths = [f"{self.path}/runs/{self._name(*run)}" for run in cover]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("_last", F.lit(0))
        placed = T.StructType([*schema.fields, *fields("run string, day string").fields])
        rows = self.spark.read.schema(placed).option("basePath", f"{self.path}/runs").parquet(*paths)
        if days is not None:
            rows = rows.where(F.col("day").isin([d.removeprefix("day=") for d in days]))
        return rows.select(*schema.names, F.split("run", "-")[1].cast("int").alias("_last"))

    def _newest(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_end", *self.keys).agg(F.max_by(self.value, "_last").alias(self.value))

    def _write(self, rows: DataFrame, first: int, last: int) -> None:
        day = F.date_format("window_end", "yyyy-MM-dd").alias("day")
        path = f"{self.path}/runs/{self._name(first, last)}"
        # Few files a day, but a crowded day in several.
        rows.select("*", day).hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)

    def _tidy(self, batch_id: int) -> None:
        """Removes runs of earlier batches that a longer one covers, and days beyond ``keep``."""
        settled = [run for run in self._complete() if run[1] < batch_id]
        needed = self._cover(batch_id - 1)
        for run in settled:
            if run not in needed:
                self.runs.remove(self._name(*run))
        if self.keep is None:
            return
        names = {run: self.runs.names(self._name(*run)) for run in needed}
        oldest = self._oldest(names.values())
        for run, found in names.items():
            for name in found:
                if _date(name) < oldest:
                    self.runs.remove(f"{self._name(*run)}/{name}")

    def _oldest(self, days: Iterable[list[str]]) -> dt.date | None:
        newest = max((_date(name) for found in days for name in found), default=None)
        return newest and newest - dt.timedelta(self.keep)

    def oldest(self) -> dt.date | None:
        """The oldest day that is kept, if some are dropped."""
        if self.keep is None:
            return None
        return self._oldest(self.runs.names(self._name(*run)) for run in self._cover())

    def put(self, batch: DataFrame, batch_id: int) -> list[str]:
        """Write a batch; returns the days it touched."""
        self._tidy(batch_id)
        new = batch.select("window_end", *self.keys, self.value)
        if not Folder(self.spark, f"{self.path}/columns").holds("_SUCCESS"):
            self.spark.createDataFrame([], new.schema).limit(0).write.mode("overwrite").parquet(f"{self.path}/columns")
        self._write(new, batch_id, batch_id)
        length = 1
        while (batch_id + 1) % (length * FAN) == 0:
            length *= FAN
        if length > 1:
            first = batch_id + 1 - length
            merged = self._newest(self._read(self._cover(batch_id, first, but=(first, batch_id))))
            self._write(merged, first, batch_id)
        return self.runs.names(self._name(batch_id, batch_id))

    def written(self, upto: int | None = None, since: int = 0, days: list[str] | None = None) -> DataFrame:
        """The values that the batches from one to another wrote, those that are out of date as well."""
        return self._read(self._cover(upto, since), days).drop("_last")

    def latest(
        self, upto: int | None = None, touched_by: int | None = None, days: list[str] | None = None
    ) -> DataFrame:
        """The values as of a batch; of some days only, and of the windows that a batch touched."""
        if not Folder(self.spark, f"{self.path}/columns").holds("_SUCCESS"):
            return self.spark.createDataFrame([], T.StructType([]))
        rows = self._read(self._cover(upto), days)
        if touched_by is not None:
            touched = self._read([(touched_by, touched_by)]).select("window_end").distinct()
            rows = rows.join(touched, "window_end", "left_semi")
        return self._newest(rows)


def days_around(days: list[str], reach: int) -> list[str]:
    """The folders of some days and of those up to ``reach`` days from one of them."""
    near = {_date(d) + dt.timedelta(k) for d in days for k in range(-reach, reach + 1)}
    return [f"day={d.isoformat()}" for d in sorted(near)]


class TopNTable:
    """Top-N per window under corrections, and the change rows of every micro-batch.

    Feed it a windowed count in update mode: a key's newer count replaces the older one, the
    touched windows are ranked again, and what entered or left a list is written as ``+`` and
    ``-`` rows.

    With ``sliding`` (size, slide, bound and lateness of ``queries.late_sliding_counts``) it takes counts of
    panes.  A pane's count is kept beside the number of its windows that were closed for the batch, and a
    window adds up what its panes had reached while it was open.  A window is closed for a batch as Spark
    has it for late rows: by the progress before the batch before.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, n: int, keep: str | None = None,
        sliding: tuple[str, str, str, str] | None = None,
    ):
        self.spark, self.path, self.key, self.n, self.sliding = spark, path, key, n, sliding
        also = () if sliding is None else (late.CLOSED,)
        self.counts = WindowValues(spark, f"{path}/counts", key, keep=keep, also=also)
        self.progress = Progress(spark, f"{path}/progress")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        days = self.counts.put(batch, batch_id) if self.sliding is None else self._put_panes(batch, batch_id)
        if not days:
            return
        after, before = (self._ranked(self._touched(upto, batch_id, days)) for upto in (batch_id, batch_id - 1))
        top_n_changes(before, after).write.mode("overwrite").parquet(
            f"{self.path}/changes/batch_id={batch_id}"
        )

    def _put_panes(self, batch: DataFrame, batch_id: int) -> list[str]:
        size, slide, bound, lateness = map(span, self.sliding)
        # Spark's watermark begins at the epoch.
        passed = max(0, (self.progress.upto(batch_id - 2) or 0) - bound - lateness)
        ahead = F.lit(passed // slide) - (bucket(micros("window_end"), slide) - size // slide)
        seen = Observation()
        days = self.counts.put(
            batch.withColumn(late.CLOSED, F.greatest(F.lit(0), ahead).cast("int")).observe(
                seen, F.max("seen_us").alias("us")
            ),
            batch_id,
        )
        self.progress.put(batch_id, self.progress.upto(batch_id - 1), seen.get.get("us"))
        return days

    def _touched(self, upto: int, batch_id: int, days: list[str]) -> DataFrame:
        """The counts as of a batch in the windows that a batch touched; of panes, also in those near them."""
        if self.sliding is None:
            return self.counts.latest(upto, batch_id, days)
        size, slide = self.sliding[:2]
        parts = F.explode(late.stretches("window_end", size, slide)).alias("_part")
        # A stretch's windows have panes beyond both of its ends.
        reach = -(-(late.stretch_windows(size, slide) * span(slide) + span(size)) // span("1 day"))
        near = days_around(days, reach)
        touched = self.counts.written(batch_id, batch_id, days).select(parts).distinct()
        return self._windows(self.counts.written(upto, days=near), touched)

    def _windows(self, panes: DataFrame, only: DataFrame | None = None) -> DataFrame:
        counts = late.windows_of_panes(panes, [self.key], *self.sliding[:2], only=only)
        oldest = self.counts.oldest()
        # Windows of the last day that was dropped still have panes on the next one.
        return counts if oldest is None else counts.where(F.to_date("window_end") >= F.lit(oldest))

    def _ranked(self, counts: DataFrame) -> DataFrame:
        return top_n_per_window(counts.select(self.key, "cnt", "window_end"), self.n, self.key)

    def current(self) -> DataFrame:
        return self._ranked(self.counts.latest() if self.sliding is None else self._windows(self.counts.written()))

    def changes(self) -> DataFrame:
        path = f"{self.path}/changes"
        return self.spark.read.option("basePath", path).parquet(path)


class ClosedTopN:
    """Top-N of windows as they close; feed it a windowed count in append mode.

    Append mode hands over all keys of a closing window in one micro-batch, so ranking inside
    the batch is complete.
    """

    def __init__(self, path: str, key: str, n: int):
        self.path, self.key, self.n = path, key, n

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        top_n_per_window(batch, self.n, self.key).write.mode("overwrite").parquet(
            f"{self.path}/batch_id={batch_id}"
        )


class LateRouter:
    """Separates rows that come after all of their windows have closed for good.

    The progress of time (largest event time so far) is one value, written anew by every
    micro-batch and read from the batch before.  A row is late when its last window's end plus the lateness is not after the progress before
    its batch minus the disorder bound.
    """

    def __init__(
        self, spark: SparkSession, path: str, ts: str, size: str, slide: str, bound: str, lateness: str
    ):
        self.spark, self.path, self.ts = spark, path, ts
        self.size, self.slide = span(size), span(slide)
        self.delay = span(bound) + span(lateness)
        self.progress = Progress(spark, f"{path}/progress")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.progress.upto(batch_id - 1)
        us = micros(self.ts)
        last_end = bucket(us, self.slide) * self.slide + self.size
        late = F.lit(False) if before is None else last_end <= before - self.delay
        seen = Observation()
        (
            batch.withColumn("tag", F.when(late, "late").otherwise("on_time"))
            .observe(seen, F.max(us).alias("us"))
            .write.mode("overwrite")
            .partitionBy("tag")
            .parquet(f"{self.path}/rows/batch_id={batch_id}")
        )
        self.progress.put(batch_id, before, seen.get.get("us"))

    def rows(self, tag: str) -> DataFrame:
        path = f"{self.path}/rows"
        return (
            self.spark.read.option("basePath", path).parquet(path).where(F.col("tag") == tag).drop("tag")
        )


class TagTables:
    """One table per side-output tag, all written in one pass over each micro-batch."""

    def __init__(self, path: str, tag: str = "tag"):
        self.path, self.tag = path, tag

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(self.tag).parquet(
            f"{self.path}/batch_id={batch_id}"
        )

    def read(self, spark: SparkSession, tag: str) -> DataFrame:
        rows = spark.read.option("basePath", self.path).parquet(self.path)
        return rows.where(F.col(self.tag) == tag).drop(self.tag)


def console(stream: DataFrame, label: str, mode: str = "append"):
    """Print a stream's rows, each with a label in front."""
    return (
        stream.select(F.lit(label).alias("output"), "*")
        .writeStream.format("console")
        .outputMode(mode)
        .option("truncate", "false")
    )
