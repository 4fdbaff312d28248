"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from claimspan.operators import analytics, etl, views, windows
from claimspan.plans.bindings import Tables

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: q for name, q in queries().items() if not re.match(r"op\d|pipeline", name)}
# Queries that run whole jobs (files, streams) while they are built.
EAGER = ("S", "D5", "T", "E1", "E2", "E3", "E8", "Q5_json_file", "Q5_record_index", "D1_enrollment_job", "D2_termination_job")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(EAGER)])
def test_no_cross_join_and_no_python(spark, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = planned(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in plan, plan


def test_a_hot_key_of_a_row_join_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2k",
    )
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
    claims = spark.range(0, 60_000, 1, 12).select(
        F.col("id").alias("claim_id"), hot.alias("member_id"), (F.col("id") % 40).alias("provider_id")
    )
    members = spark.range(0, 400).withColumnRenamed("id", "member_id")
    providers = spark.range(0, 40).withColumnRenamed("id", "provider_id")
    routed = etl.classify_claims(claims, members, providers)
    assert "skew=true" in executed(routed)
    assert routed.filter("reject_reason is null").count() == claims.filter("member_id < 400").count()


@pytest.mark.parametrize(
    "build",
    [
        lambda t: views.provider_claim_summary(t.providers, t.claims),
        lambda t: analytics.denial_rate_by(t.claims, t.payer, "payer_id", "payer_name"),
        lambda t: analytics.member_utilization(t.claims, t.members),
        lambda t: analytics.drilldown(t.claims, t.payer, t.providers),
    ],
)
def test_facts_are_folded_before_the_join(spark, build):
    """Below the lowest join, the branch that scans the facts already holds an aggregate."""
    plan = build(Tables(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(plan) if "o_orderkey" in line and "Relation" in line)
    join = max(i for i, line in enumerate(plan[:scan]) if "Join" in line)
    assert any("Aggregate" in line for line in plan[join:scan])


def test_only_needed_columns_are_read(spark):
    t = Tables(spark, SF_DIR)
    plan = planned(analytics.denial_rate_by_provider(t.claims))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_windows_see_no_whole_partition_key(spark):
    """Ranks run inside slots: every window but the running sums is partitioned by a slot."""
    t = Tables(spark, SF_DIR)
    for df in (windows.contract_ranks(t.contracts), analytics.denial_rate_by_specialty(t.claims, t.providers)):
        lines = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
        assert lines and all("_slot" in x or "_parent" in x for x in lines)


def test_a_threshold_on_a_stored_column_reaches_the_scan(spark):
    plan = planned(QUERIES["P9_order_alert"](spark, SF_DIR))
    assert "GreaterThan(o_totalprice" in plan and "o_comment" not in plan


@pytest.mark.parametrize("name", ["J8_near_duplicates", "J10_contract_overlaps"])
def test_pairs_have_one_plan_without_a_forced_broadcast(spark, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    assert "BroadcastHashJoin" not in executed(QUERIES[name](spark, SF_DIR))
