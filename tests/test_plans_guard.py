"""Scale guards on the physical plans of every registered batch query."""

import pytest

from ohlcflow.queries import queries

from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SortAggregate")


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_has_no_unbounded_pattern(spark, name):
    df = queries()[name](spark, SF_SMALL)
    plan = executed(df)
    for pattern in FORBIDDEN:
        assert pattern not in plan, f"{name}: {pattern}"


def executed(df) -> str:
    """The plan that ran, after adaptive execution changed it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=false" not in plan
    # An adaptive plan also prints the one it began with.
    return plan.split("+- == Initial Plan ==")[0]


def scans(plan: str, table: str) -> list[str]:
    return [x for x in plan.split("\n") if "FileScan parquet" in x and table in x]


@pytest.mark.parametrize("name, n", [("tier_select", 3), ("last_n_bars", 1)])
def test_time_bounds_reach_the_scan(spark, name, n):
    # The planned scans: a run drops branches that turn out empty.
    df = queries()[name](spark, SF_SMALL)
    found = scans(df._jdf.queryExecution().sparkPlan().toString(), "events")
    assert len(found) == n
    assert all("LessThan(ts," in x for x in found)


def test_tiers_read_the_ticks_once(spark):
    plan = executed(queries()["tier_union"](spark, SF_SMALL))
    assert len(scans(plan, "events")) == 1, plan
    assert "ReusedExchange" in plan


def test_multiset_difference_deals_rows_once(spark):
    plan = executed(queries()["multiset_except"](spark, SF_SMALL))
    # Left and right side, each read once though both kinds of rows use the counts.
    assert len(scans(plan, "events")) == 2, plan


def test_symbols_prune_partitions(spark):
    plan = executed(queries()["symbols_pruned"](spark, SF_SMALL))
    assert "PartitionFilters: [symbol" in plan and "007" in plan
