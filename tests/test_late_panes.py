"""Late counts kept by pane against those kept by window."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import at, stream_rows
from pyspark.sql import functions as F
from test_streaming import DDL, fed  # noqa: F401

from eddyline.operators import late
from eddyline.plans import stream_queries
from eddyline.streaming import queries, runs, sinks

FIGURES = ("1 minute", "10 seconds", "2 seconds", "30 seconds")


def of_both(spark, tmp_path, streams, keep=None):
    """Lists and change rows, by window and by pane; a stream after another continues the same query."""
    size, slide, bound, lateness = FIGURES
    tables = {}
    for panes in (False, True):
        path = str(tmp_path / f"panes={panes}")
        tables[panes] = sinks.TopNTable(spark, path, "key", 3, keep, sliding=FIGURES if panes else None)
    for stream in streams:
        for panes, table in tables.items():
            counts = queries.late_sliding_counts(stream, "ts", size, slide, ["key"], bound, lateness, panes=panes)
            runs.each_batch(counts, table, f"{table.path}/checkpoint", "update")
    return [
        [sorted(map(str, rows.collect())) for rows in (table.current(), table.changes().select(
            "batch_id", "op", "window_end", "rk", "key", "cnt"
        ))]
        for table in tables.values()
    ]


def test_late_rows_count_for_their_open_windows_only(spark, fed, tmp_path, monkeypatch):  # noqa: F811
    """Rows up to four minutes behind, null keys among them, over more batches than runs are merged after."""
    monkeypatch.setattr(late, "STRETCH_WINDOWS", 4)
    monkeypatch.setattr(sinks, "FAN", 4)
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 1, 2, 3, 4]), rng.randrange(400), k, "v") for k in range(240)]
    rows.sort(key=lambda r: r[1] + rng.choice([0, 0, 10, 70, 90, 240]))
    batches = [rows[k : k + 40] for k in range(0, 240, 40)]

    def streams():
        stream = fed(batches[:5], delay=None, flush=False)
        yield stream
        part = stream_rows(spark, [(r[0], at(r[1]), *r[2:]) for r in batches[5]], DDL)
        part.coalesce(1).write.parquet(str(tmp_path / "in" / "b=100"))
        yield stream

    by_window, by_pane = of_both(spark, tmp_path, streams())
    assert by_pane == by_window
    kept = sinks.TopNTable(spark, str(tmp_path / "panes=True"), "key", 3, sliding=FIGURES).counts.written()
    # The case is there: late for some of their windows.
    assert kept.where(F.col(late.CLOSED) > 0).count() > 5


def test_days_beyond_keep_leave_no_part_of_a_window(spark, fed, tmp_path):  # noqa: F811
    day = 86400
    batches = [
        [(1, day - 45, 0, "v"), (2, day - 5, 1, "v")],
        [(1, day + 5, 2, "v")],
        *[[(3, 2 * day + 100 * k, 3 + k, "v")] for k in range(2)],
    ]
    stream = fed(batches, delay=None, flush=False)
    (by_window, _), (by_pane, _) = of_both(spark, tmp_path, [stream], keep="1 day")
    assert by_pane == by_window and len(by_pane) > 12
    assert not any("2024, 3, 1, 23" in row for row in by_pane)


def test_an_own_longer_watermark_is_an_error(spark, fed):  # noqa: F811
    stream = fed([[(1, 1, 0, "v")]], "1 hour")
    with pytest.raises(ValueError, match="trails by more"):
        queries.late_sliding_counts(stream, "ts", "1 minute", "10 seconds", ["key"], *FIGURES[2:], panes=True)


def test_hot_urls_with_late_rows_keep_a_request_once(spark, tmp_path, monkeypatch):
    """A request is in ten windows, but is kept and written for one pane."""
    monkeypatch.setattr(stream_queries, "new_folder", lambda _, name: str(tmp_path / name))
    start = dt.datetime(2024, 1, 1)
    rows = [
        (k, start + dt.timedelta(hours=k % 97, seconds=7 * k), k, "click", 1.0, f'{{"k": {k}}}') for k in range(300)
    ]
    ddl = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    stream_rows(spark, rows, ddl).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    found = stream_queries.hot_urls_late_stream(spark, str(tmp_path))
    end = max(r[1] for r in rows)
    near = {r[0]: r[1] for r in rows if r[0] % 50 or r[1] >= end - dt.timedelta(days=1)}
    assert {r.url for r in found.collect()} == {f"/item/{k}" for k in near}
    assert found.where("rk = 1").select("window_end").distinct().count() > 2000
    kept = spark.read.parquet(str(tmp_path / "hot-urls-late" / "top" / "counts" / "runs"))
    assert kept.where("run like '%-%'").select("url", "window_end").distinct().count() <= len(rows)
