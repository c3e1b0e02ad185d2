"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import os
import re

import pytest

from eddyline.plans.event_queries import BATCH

FOLDER = os.environ.get("EDDYLINE_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no generated tables")


def plan(spark, name: str) -> str:
    """The plan before anything has run, so that sizes known only at run time play no part."""
    return BATCH[name](spark, FOLDER)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", [n for n in BATCH if n != "login_fail_window"])
def test_no_plan_multiplies_or_leaves_the_jvm(spark, name):
    text = plan(spark, name)
    physical = text[text.index("== Physical Plan ==") :]
    assert "CartesianProduct" not in physical
    assert "BroadcastNestedLoopJoin" not in physical
    assert "Python" not in physical and "InPandas" not in physical


@pytest.mark.parametrize("name", ["hot_items_topn", "hot_urls_topn", "hot_urls_late", "click_blacklist"])
def test_rank_limits_are_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit.*Partial", plan(spark, name))


@pytest.mark.parametrize(
    "name, filters",
    [
        ("pv_hourly", "EqualTo(event_type,view)"),
        ("hot_urls_topn", "EqualTo(event_type,click)"),
        ("pay_receipt_interval", "EqualTo(event_type,purchase)"),
        ("order_timeout_pattern", "Or(EqualTo(event_type,click),EqualTo(event_type,purchase))"),
        ("order_timeout_state", "Or(EqualTo(event_type,click),EqualTo(event_type,purchase))"),
    ],
)
def test_filters_reach_the_scan(spark, name, filters):
    assert filters in BATCH[name](spark, FOLDER)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize(
    "name, columns",
    [("pv_hourly", {"ts", "event_type"}), ("uv_hourly_exact", {"ts", "user_id"})],
)
def test_scans_read_only_needed_columns(spark, name, columns):
    text = BATCH[name](spark, FOLDER)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == columns


@pytest.mark.parametrize(
    "name",
    ["login_fail_strict_seq_slots", "order_timeout_pattern_slots", "order_timeout_state_slots", "pay_receipt_reconcile_all"],
)
def test_slots_copy_no_rows(spark, name):
    text = plan(spark, name)
    assert "Generate" not in text[text.index("== Physical Plan ==") :]


@pytest.mark.parametrize(
    "name",
    ["login_fail_pairs", "login_fail_strict_seq", "order_timeout_pattern", "order_timeout_state"],
)
def test_bounded_sequences_take_one_shuffle(spark, name):
    text = plan(spark, name)
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") == 1
    assert "_bucket" in re.search(r"Exchange hashpartitioning\(([^)]*)\)", physical).group(1)


@pytest.mark.parametrize("name", ["channel_behavior_counts", "channel_stats"])
def test_one_shuffle_after_the_panes(spark, name):
    text = plan(spark, name)
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") == 2
    # The panes move by key and stretch; the windows are made behind that.
    assert re.search(r"Exchange hashpartitioning\([^)]*_part[^)]*\), REPARTITION_BY_COL", physical)


@pytest.mark.parametrize("name", ["province_peak_5s", "hot_urls_topn_5s"])
def test_windows_are_filled_in_last(spark, name):
    """A pane goes to three changes at most; one row per window comes behind the running aggregates."""
    text = plan(spark, name)
    physical = text[text.index("== Physical Plan ==") :]
    spreads = [line for line in physical.splitlines() if "Generate explode(" in line]
    assert len(spreads) == 2 and "sequence(" in spreads[0] and "_in" in spreads[1]
    first, second = (physical.index(line) for line in spreads)
    assert "Window [" in physical[first:second] and "sequence(" not in physical[second:]
