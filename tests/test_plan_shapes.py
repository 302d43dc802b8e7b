"""Plan-shape guards for the scale properties the design relies on (checked on the
optimised and physical plans, without running the queries)."""
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tallyho.plans.catalog import QUERIES


def plan_of(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString() + "\n" + qe.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_at_a_time_python(spark, name):
    if name in ("readings_stream", "readings_rollup_stream"):
        pytest.skip("streaming queries return the sink's table")
    plan = plan_of(spark, name)
    assert "BatchEvalPython" not in plan          # no row-at-a-time Python UDF anywhere
    assert "CartesianProduct" not in plan         # no cross product of data


def test_diff_runs_on_the_jvm(spark):
    plan = plan_of(spark, "diff_only_left")
    assert "InPandas" not in plan and "InArrow" not in plan and "monotonically" not in plan


def test_top_n_is_bounded(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "extract_top")
    assert "TakeOrderedAndProject" in plan_of(spark, "spend_topk_vendor")


def test_scan_pruning_and_pushdown(spark):
    plan = plan_of(spark, "keyword_excluded")
    assert "Contains(event_type" in plan
    audit = plan_of(spark, "audit_mismatch_by_term")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in audit


def test_date_range_reaches_the_scan(spark):
    df = entry.queries()["readings_window"](spark, SF_SMALL)
    pushed = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line]
    assert pushed and any("GreaterThanOrEqual(ts" in line and "LessThan(ts" in line for line in pushed)


def test_audit_rule_not_inlined_into_join(spark):
    plan = plan_of(spark, "audit_mismatch_by_term")
    assert "CollectMetrics" in plan
    assert len(plan) < 60_000   # the rule chain is evaluated once, not copied into every reference


def test_hot_sheet_is_split_in_joins(spark):
    """Without broadcasts, the join of a sheet's rows with its header has the row block in its key."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plans = [entry.queries()[n](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
                 for n in ("cells_table", "consolidated")]
    finally:
        spark.conf.set(key, before)
    for plan in plans:
        assert "SortMergeJoin [file" in plan and "_tly_rows" in plan
        assert any("SortMergeJoin" in line and "_tly_rows" in line for line in plan.splitlines())


def test_fill_down_windows_are_blocked(spark):
    plan = plan_of(spark, "consolidated")
    assert "_tly_block" in plan
