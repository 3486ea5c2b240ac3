"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry_point
from fleetlens.plans.registry import REGISTERED

SF = "/root/testdata/sf0.001"
PYTHON = {
    "service_status", "service_replicas", "list_view_services",
    "wait_ready_stream", "wait_terminal_stream", "transitions_stream", "transitions_stream_shuffled",
}
# These run jobs when they are called: they write a dump or drain a stream first.
EAGER = {name for name in REGISTERED if name.startswith(("read_", "write_", "landed_", "snapshots_")) or "_stream" in name or name in {
    "reconcile_bucketed", "lookup_bucketed", "log_follow", "log_follow_until_end", "progress_heartbeat", "on_progress"}}
LAZY = sorted(set(REGISTERED) - EAGER)


def plan(spark, name):
    return entry_point.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins_and_no_stray_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON:
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", text)


def test_transitions_read_and_shuffle_the_polls_once(spark):
    """With many cells per resource too: the border rows come out of the same shuffle."""
    for name in ("transitions", "transitions_hot_keys", "transitions_ties"):
        df = entry_point.queries()[name](spark, SF)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert text.count("FileScan") <= 2 and len(re.findall(r"\bExchange ", text)) <= 4, name


def test_deep_merge_shuffles_each_leaf_once(spark):
    text = plan(spark, "deep_merge").split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 2 and len(re.findall(r"\bExchange ", text)) == 1 and "Join" not in text


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    """Not by a broadcast either, which is turned off here to stand for large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("reconcile_bucketed", "lookup_bucketed"):
            text = plan(spark, name)
            assert "SortMergeJoin" in text and "Exchange" not in text, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rank_filters_are_pushed_below_the_shuffle(spark):
    for name in ("latest_snapshot", "log_tail", "number_attempts"):
        text = plan(spark, name)
        assert text.count("WindowGroupLimit") == 2, name


def test_scans_read_only_the_needed_columns(spark):
    text = plan(spark, "podset_counts")
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan(spark, "lookup")


def test_reconcile_ships_digests_only(spark):
    exchanges = [line for line in plan(spark, "reconcile").splitlines() if "Exchange" in line]
    assert exchanges
    joined = plan(spark, "reconcile")
    assert "sha2" in joined


def test_fleet_summary_expands_after_the_first_aggregate(spark):
    text = plan(spark, "fleet_summary")
    assert text.index("Expand") < text.rindex("HashAggregate")
    assert text[text.index("Expand"):].count("HashAggregate") == 2


def test_validation_needs_no_shuffle(spark):
    for name in ("validate_clusters", "validate_services", "merge_leaves", "cluster_status"):
        assert "hashpartitioning" not in plan(spark, name)


def optimized(spark, name):
    return entry_point.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_outcomes_are_worked_out_on_all_cores(spark):
    """Customers in one small file are dealt out before the documents are rendered and merged."""
    assert plan(spark, "deployment_outcomes").count("REPARTITION_BY_NUM") >= 2


@pytest.mark.parametrize("name", ["service_status", "service_replicas"])
def test_deployments_are_listed_once(spark, name):
    assert optimized(spark, name).count("map_values(") == 1


def test_desired_state_reads_shown_resources_only(spark):
    text = optimized(spark, "desired_state")
    assert "StructField(limits,StringType" in text
    assert "StructField(limits,StringType,true),StructField(requests,StringType" not in text


def test_parts_grow_with_the_rows(spark, monkeypatch):
    from fleetlens.plans import bindings

    rows = spark.range(1000)
    assert bindings.parts_for(rows) is None
    monkeypatch.setattr(bindings, "SORTED_ROWS", 100)
    assert bindings.parts_for(rows) == 10 and bindings.parts_for(rows, 7) == 70
