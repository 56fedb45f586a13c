"""Scale checks on the physical plans of every registered query."""

import pytest

from ledgerlens.plans.catalog import QUERIES
from tests.conftest import SMOKE

BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
          "FlatMapGroupsInPandas", "SinglePartition"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_has_no_cartesian_udf_or_single_partition(spark, key):
    df = QUERIES[key](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in BANNED:
        assert word not in plan, f"{key}: {word} in plan"


def test_scan_prune_pushes_filter_and_prunes_columns(spark):
    df = QUERIES["scan_prune"](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(l_returnflag" in plan or "In(l_returnflag" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in plan


def test_latest_per_key_uses_group_limit(spark):
    df = QUERIES["latest_status"](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


FULL_WIDTH = {"lineitem": 11, "orders": 6, "customer": 5, "part": 6, "supplier": 4, "events": 6}
VIEW_KEYS = {"billing_reconciliation", "contract_items", "rental_invoices", "asset_register", "used_sales"}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - VIEW_KEYS - {"star_plus"}))
def test_scans_are_column_pruned(spark, key):
    """No key reads every column of a wide driver table (``star_plus`` selects * by definition)."""
    import re
    plan = QUERIES[key](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "FileScan" not in line:
            continue
        table = re.search(r"/(\w+)\.parquet", line).group(1)
        cols = len(re.search(r"FileScan parquet \[([^\]]*)\]", line).group(1).split(","))
        assert cols < FULL_WIDTH.get(table, 10 ** 6), f"{key} reads all {cols} columns of {table}"


@pytest.mark.parametrize("key, column", [("date_window", "o_orderdate"), ("residual_value", "l_shipdate")])
def test_date_ranges_reach_the_scan(spark, key, column):
    plan = QUERIES[key](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert f"GreaterThanOrEqual({column}" in pushed and f"LessThan({column}" in pushed


VIEWS = ["rental_invoices", "asset_register", "used_sales", "contract_items"]


@pytest.mark.parametrize("key", VIEWS)
def test_building_a_view_runs_no_job_once_its_lines_are_staged(spark, key):
    """The order lines are written when a view is first built (``plans.stages``); after that building starts no job."""
    QUERIES[key](spark, SMOKE)
    sc = spark.sparkContext
    sc.setJobGroup(f"build {key}", "")
    try:
        df = QUERIES[key](spark, SMOKE)
        df.schema
        # reading the schema of a Parquet file is a job of one task; nothing else may run
        for job in sc.statusTracker().getJobIdsForGroup(f"build {key}"):
            assert all(sc.statusTracker().getStageInfo(i).numTasks == 1 for i in sc.statusTracker().getJobInfo(job).stageIds)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


# scans of the order lines' stage and joins of a view's plan, before any is turned into a broadcast: what a change must not exceed
BOUNDS = {"rental_invoices": (3, 5), "asset_register": (0, 16), "used_sales": (10, 48), "contract_items": (10, 21)}


@pytest.mark.parametrize("key", VIEWS)
def test_views_stay_within_their_scans_and_joins(spark, key):
    plan = QUERIES[key](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    scans = sum("Relation" in line and "line_seq" in line for line in plan.splitlines())
    joins = sum(" Join " in f" {line.lstrip(' :+-')}" for line in plan.splitlines())
    assert scans <= BOUNDS[key][0] and joins <= BOUNDS[key][1], (scans, joins)


def test_views_do_not_force_a_broadcast(spark):
    plan = QUERIES["contract_items"](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" not in plan and "leftHint=(strategy=broadcast)" not in plan
