"""What the registered queries must not do at scale, read off their physical plans."""

import re

import pytest

from gridspark.plans import PLANS

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "InMemoryRelation"]


def physical_plan(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan =="):]


@pytest.fixture
def no_automatic_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_pairing_no_python_no_single_task_window(spark, name, no_automatic_broadcast):
    plan = physical_plan(PLANS[name](spark, SF_DIR))
    # ZIP archives are the one thing that Python reads.
    assert not [word for word in FORBIDDEN if word in plan and not (word == "MapInPandas" and "archive" in name)]
    # A single partition is fine for one-row aggregates, and for ids over partition counts.
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    if name != "surrogate_id":
        assert all("windowspecdefinition(" in line and not re.search(r"windowspecdefinition\([^,]* (ASC|DESC)", line) for line in windows)


@pytest.mark.parametrize("name, columns", [
    ("slot_keys", {"event_id", "ts", "user_id"}),
    ("area_supply_halfhour", {"ts", "user_id", "event_type", "value"}),
    ("duplicate_keys", {"l_orderkey", "l_linenumber"}),
    ("coverage_summary", {"ts", "user_id"}),
])
def test_only_needed_columns_are_read(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", physical_plan(PLANS[name](spark, SF_DIR)))
    assert {part.split(":")[0] for schema in schemas for part in schema.split(",")} == columns


@pytest.mark.parametrize("name, exchanges", [
    ("area_supply_halfhour", 1), ("wide_areas", 1), ("area_supply_parse", 1), ("bid_stack", 2), ("bid_stack_first", 1),
    ("unit_generation_matrix", 1), ("first_reading", 1), ("rejects", 0), ("slot_keys", 0),
])
def test_number_of_shuffles(spark, name, exchanges):
    plan = physical_plan(PLANS[name](spark, SF_DIR))
    assert len(re.findall(r"\bExchange ", plan)) == exchanges


@pytest.mark.parametrize("name", ["area_supply_parse", "first_reading", "candidate_pick", "insert_ignore", "spot_price_parse"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    plan = physical_plan(PLANS[name](spark, SF_DIR))
    assert len(re.findall(r"WindowGroupLimit.*Partial", plan)) == len(re.findall(r"WindowGroupLimit.*Final", plan)) > 0
