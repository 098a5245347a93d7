"""The physical plans that the scale of the jobs depends on."""

import os
import re

import pytest
from pyspark.sql import functions as F

from turnstile.checks import QUERIES
from turnstile.checks.registry import Tables
from turnstile.operators.joins import (
    aggregate_then_join,
    fits_broadcast,
    interval_join_left,
    interval_totals_left,
)
from turnstile.operators.windows import latest_version

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# Runs that read back what they wrote: their returned plan is a plain scan.
WRITERS = {
    "stream_ingest", "replace_period_tables", "landed_receipts", "cancelled_receipts_run", "landed_answers",
    "newest_order_state", "append_then_anti_join",
}


def plan_of(df, mode="simple"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_pairs_of_everything_and_no_python_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas", plan)


# One row per city at most reaches these single-task steps.
RANKINGS = {"rank_total_first", "rank_label", "weekly_mart"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS - RANKINGS))
def test_no_global_window(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for line in plan.splitlines():
        if "Window [" in line and "windowspecdefinition(" in line:
            assert not re.search(r"\], \[\](,|$)", line), line


def test_latest_version_is_cut_before_the_shuffle(spark):
    events = Tables(spark, FOLDER).events
    plan = plan_of(latest_version(events, ["user_id"], [F.col("ts").desc(), F.col("event_id")]))
    exchange = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[exchange:] and "WindowGroupLimit" in plan[exchange:]


def test_totals_expand_after_the_first_sum(spark):
    plan = plan_of(QUERIES["attribution_cube_week"](spark, FOLDER))
    assert plan.count("Expand ") == 1
    assert plan.index("Expand ") < plan.index("Exchange hashpartitioning(year", plan.index("Expand "))


def test_facts_are_summed_before_the_dimension_join(spark):
    plan = plan_of(QUERIES["dim_join_weekly"](spark, FOLDER))
    join, scan = plan.index("HashJoin"), plan.index("FileScan parquet [o_custkey")
    assert "HashAggregate" in plan[join:scan]
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_dimension_is_broadcast_only_when_its_size_is_known(spark):
    t = Tables(spark, FOLDER)
    nations = t.nation.select("n_nationkey", "n_name")

    def build():
        groups = [F.year("o_orderdate").alias("year")]
        facts = t.orders.withColumn("k", F.col("o_custkey") % 25)
        return aggregate_then_join(
            facts, nations, "k", "n_nationkey", groups, ["year", "n_name"], {"n": F.lit(1)}
        )

    assert fits_broadcast(nations)
    small = build()
    assert "BroadcastHashJoin" in plan_of(small)
    expected = sorted(tuple(r) for r in small.collect())
    for limit in ("-1", "1kb"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            assert not fits_broadcast(nations)
            large = build()
            plan = plan_of(large)
            assert "SortMergeJoin" in plan and "HashAggregate" in plan[plan.index("SortMergeJoin") :]
            assert sorted(tuple(r) for r in large.collect()) == expected
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_interval_totals_shuffle_once_and_join_nothing(spark):
    t = Tables(spark, FOLDER)
    left = t.events.select("user_id", "ts")
    right = t.events.select(
        F.col("user_id").alias("u2"), F.col("ts").alias("t2"), "event_type", F.lit(1).alias("n"), "value"
    )
    plan = plan_of(
        interval_totals_left(left, right, {"user_id": "u2"}, "ts", "t2", 60, "event_type", "n", "value")
    )
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_interval_join_hashes_on_time(spark):
    t = Tables(spark, FOLDER)
    left = t.events.select("user_id", "ts")
    right = t.events.select(F.col("user_id").alias("u2"), F.col("ts").alias("t2"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(interval_join_left(left, right, {"user_id": "u2"}, "ts", "t2", 60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[user_id#\d+L, __bucket#\d+L\]", plan)


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["scan_clean_rename"](spark, FOLDER))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "Not(EqualTo(o_orderstatus,P))" in pushed and "IsNotNull(o_totalprice)" in pushed
    plan = plan_of(QUERIES["status_net_amount"](spark, FOLDER))
    assert "In(l_returnflag, [A,R])" in plan


@pytest.mark.parametrize("name", ["revenue_with_total", "receipt_revenue_with_total", "wow_change", "report_text", "offline_revenue_by_week"])
def test_revenue_reads_each_fact_once(spark, name):
    df = QUERIES[name](spark, FOLDER)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    final = final[: final.index("== Initial Plan ==")] if "== Initial Plan ==" in final else final
    scans = re.findall(r"FileScan parquet (\[[^\]]*\]).*?(\w+)\.parquet", final)
    for table, amount in (("lineitem", "l_extendedprice"), ("orders", "o_totalprice")):
        facts = [columns for columns, of in scans if of == table and amount in columns]
        assert len(facts) <= 1, (table, facts)
