"""Plan properties that matter at scale, checked on the executed physical plans."""

import re

import __spark_entry__ as entry
from conftest import SF_SMALL


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()      # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_no_query_uses_a_cross_or_nested_loop_join(spark):
    for name in set(entry.queries()) - set(entry.LLM_QUERIES):
        plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_time_in_status_window_sum_and_pivot_share_one_exchange(spark):
    plan = _plan(spark, "status_durations")
    assert _hash_exchanges(plan) == 1
    assert "Window" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "left_enrich")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O), IsNotNull(o_custkey)]" in plan
    orders_schema = [s for s in re.findall(r"ReadSchema: (struct<[^>]*>)", plan) if "o_" in s][0]
    assert "o_orderdate" not in orders_schema and "o_orderpriority" not in orders_schema


def test_page_append_is_an_equi_join(spark):
    plan = _plan(spark, "natural_full_join")
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_reports_and_matrices_read_the_issue_table_without_an_exchange(spark):
    for name in ("sbp_time_in_status", "com_tactics", "com_audiences", "com_audience_count", "par_report", "csr_report"):
        plan = _plan(spark, name)
        assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan, name


def test_indicator_matrix_shares_the_joins_exchange(spark):
    assert _hash_exchanges(_plan(spark, "indicator_matrix")) == 2      # orders and line items, by order
