"""Plan-shape checks: the physical plans we want at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from dq_mart.plans.registry import load_all

from conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", sorted(load_all()))
def test_no_python_or_cartesian(spark, key):
    plan = plan_of(E.queries()[key](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, (key, bad)


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan_of(E.queries()["top_diagnoses"](spark, SF_SMALL))


def test_fact_is_aggregated_before_dimension_join(spark):
    text = optimized_of(E.queries()["substitution_rate"](spark, SF_SMALL))
    lines = text.splitlines()
    join_at = min(i for i, ln in enumerate(lines) if "Join Inner, (_b" in ln)
    # the fact side of the dimension join is an Aggregate (one row per branch)
    assert "Aggregate [" in lines[join_at + 1], text


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["monthly_visits"](spark, SF_SMALL)
    df.collect()
    plan = plan_of(df)
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in \
        df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")) \
        or "o_totalprice" not in plan


def test_keep_first_is_an_aggregate_not_a_window(spark):
    plan = plan_of(E.queries()["dedup_keep_first"](spark, SF_SMALL))
    assert "Window" not in plan and "Aggregate" in plan


def test_fk_checks_shuffle_only_their_distinct_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # the plan before execution (an executed adaptive plan prints both
        # its final and its initial form)
        plan = plan_of(E.queries()["fk_orphans"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # eleven relationships: one shuffle per side (the distinct), joined in
    # place; the empty child's is folded away
    n = plan.count("SortMergeJoin")
    assert n >= 10
    assert plan.count("Exchange hashpartitioning") == 2 * n


def test_fk_examples_are_limited_per_task(spark):
    df = E.queries()["fk_integrity"](spark, SF_SMALL)
    df.collect()
    assert "WindowGroupLimit" in plan_of(df)


def test_row_counts_read_no_column(spark):
    text = plan_of(E.queries()["catalog_row_counts"](spark, SF_SMALL))
    assert "Expand" in text and "ReadSchema: struct<>" in text


@pytest.mark.parametrize("key", ["etl_surgeries", "etl_billing", "conform_to_schema", "conform_rejects"])
def test_cleaning_is_evaluated_once(spark, key):
    """The filter on the reject reasons stays above the cleaning: the reasons
    occur in one node of the optimized plan only."""
    text = optimized_of(E.queries()[key](spark, SF_SMALL))
    assert sum("concat_ws(; " in line for line in text.splitlines()) == 1


def test_report_has_no_window(spark):
    assert "Window" not in optimized_of(E.queries()["report_sections"](spark, SF_SMALL))


def test_profile_has_no_window_by_column(spark):
    from dq_mart.operators.table_profile import TableProfile
    from dq_mart.plans import profiling_keys as PK
    from dq_mart.plans.standins import DriverTables
    t = DriverTables(spark, SF_SMALL)
    prof = TableProfile(PK.orders_profiled(t), "orders").categorical(["yn_raw"]).yes_no(["yn_raw"])
    assert "Window" not in optimized_of(prof.long())


def test_a_profiled_table_is_scanned_twice(spark):
    from dq_mart.operators.table_profile import TableProfile
    from dq_mart.plans import profiling_keys as PK
    from dq_mart.plans.standins import DriverTables
    t = DriverTables(spark, SF_SMALL)
    prof = (TableProfile(PK.customer_nt(t), "customer").nulls().types("c_custkey")
            .categorical(["segment", "c_nationkey"]).yes_no(["segment"]).long())
    # one aggregate scan; the value pass was the other, its distinct values
    # are read from the checkpoint
    text = optimized_of(prof)
    assert text.count("Relation [") == 1 and "LogicalRDD" in text
