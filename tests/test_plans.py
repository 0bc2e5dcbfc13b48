"""Plans: what is read, what is shuffled, and what must never appear."""

import re

import pytest

from retentide.plans.catalog import REGISTRY as QUERIES

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = (
    "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsIn",
    "FlatMapCoGroupsIn", "CartesianProduct", "BroadcastNestedLoopJoin",
)


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    """Keys of all shuffles; the subquery for the last day only gathers one row per task."""
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pairs(name, spark):
    text = plan(spark, name)
    assert not [node for node in FORBIDDEN if node in text]


@pytest.mark.parametrize(
    "name, keys",
    [
        ("gold_scd2_user_state", ["user_id"]),
        ("gold_scd2_orders_quarter", ["user_id"]),
        ("cohort_retention", ["cohort_date", "user_id"]),
        ("growth_monthly", ["period_start", "user_id"]),
        ("user_daily_activity", ["event_date, user_id"]),
        ("bronze_dedup", ["event_time, user_id, event_type"]),
        ("dq_events_assertions", []),
    ],
)
def test_shuffle_keys(name, keys, spark):
    found = [re.sub(r"#\d+L?", "", k) for k in shuffles(plan(spark, name))]
    # A computed grouping key has a generated name.
    found = [re.sub(r"_groupingexpression", "cohort_date", k) for k in found]
    assert found == keys


def test_flagship_reads_what_it_needs(spark):
    text = plan(spark, "gold_scd2_user_state")
    assert "PushedFilters: [IsNotNull(ts)" in text or "isnotnull(ts" in text
    schemas = set(re.findall(r"ReadSchema: struct<(.*?)>", text))
    assert all("props" not in s and "value" not in s and "event_id" not in s for s in schemas)


def test_sets_are_combined_before_the_shuffle(spark):
    text = plan(spark, "gold_scd2_user_state")
    assert text.index("Exchange hashpartitioning(user_id") < text.index("partial_collect_set")
