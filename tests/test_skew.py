"""A third of the rows on one key: results stay whole and no task gets them all."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillbook import plans
from tillbook.operators.dedup import dedup
from tillbook.operators.lookup import add_agent, salted_lookup
from tillbook.operators.merge import merge_upsert
from tillbook.operators.rollups import terminal_summary

ROWS = 60_000


@pytest.fixture
def small_limits(spark):
    """Limits that make a small hot partition count as a large one, and no broadcasts."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield spark
    for name in limits:
        spark.conf.unset(name)


def hot(column, value):
    """One row in three gets the hot value."""
    return F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(column)


@pytest.fixture
def service(spark):
    return spark.range(0, ROWS, 1, 8).select(
        hot(F.concat(F.lit("w"), (F.col("id") % 5000).cast("string")), "w1").alias("wallet"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("terminal"),
        F.lit("c").alias("category"), F.lit("1.50").alias("amount"),
        F.lit(datetime(2025, 6, 3).isoformat()).cast("timestamp_ntz").alias("updated_at"),
    )


@pytest.fixture
def agents(spark):
    return spark.range(0, 4000).select(
        F.concat(F.lit("w"), "id").alias("wallet_id"), F.concat(F.lit("B"), "id").alias("bvn"),
        F.lit(None).cast("string").alias("nin"), F.lit("+1").alias("phone_number"),
        F.lit("x").alias("address"), F.lit("Lagos").alias("state_of_residence"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_adaptive_execution_splits_the_hot_wallet(small_limits, service, agents):
    joined = add_agent(service, agents, {"bvn": "bvn"})
    assert "skew=true" in final_plan(joined)
    weekly = plans.weekly_agent_activity_history(service, agents)
    assert "skew=true" in final_plan(weekly)
    assert weekly.count() == ROWS


def test_salted_report_equals_the_plain_one(spark, service, agents):
    plain = plans.weekly_agent_activity_history(service, agents)
    salted = plans.weekly_agent_activity_history(service, agents, join=salted_lookup)
    assert salted.count() == ROWS
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def shuffled_rows(df):
    """Rows written to the shuffles of an aggregation without joins."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().executedPlan()
    total, stack = 0, [plan]
    while stack:
        node = stack.pop()
        metrics = node.metrics()
        if node.nodeName() == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            total += metrics.apply("shuffleRecordsWritten").value()
        if node.nodeName().endswith("QueryStage"):
            stack.append(node.plan())
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return total


def test_rollup_of_a_hot_terminal_shuffles_groups_not_rows(spark):
    txns = spark.range(0, ROWS, 1, 8).select(
        hot(F.concat(F.lit("t"), (F.col("id") % 10).cast("string")), "hot").alias("terminal_id"),
        F.lit("m").alias("merchant_id"), F.lit("M").alias("merchant"),
        F.lit("2.00").cast("decimal(18,2)").alias("amount"),
        F.lit(datetime(2025, 6, 3).isoformat()).cast("timestamp_ntz").alias("date"),
    )
    summary = terminal_summary(txns, rate_scale=4)
    # 11 groups from each of 8 tasks, twice at most.
    assert shuffled_rows(summary) <= 2 * 8 * 11
    by_id = {r["terminal_id"]: r["volume"] for r in summary.collect()}
    assert by_id["hot"] == ROWS // 3 and sum(by_id.values()) == ROWS


def test_dedup_of_a_hot_null_key_shuffles_one_row_per_task(spark):
    rows = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("r")).cast("string").alias("ref"),
        F.col("id").alias("amount"),
    )
    once = dedup(rows, ["ref"], ["amount"])
    assert shuffled_rows(once) <= 8 * 2
    assert sorted(r["amount"] for r in once.collect()) == [0, 1]


def test_merge_with_a_hot_null_and_a_hot_target_key(small_limits, spark):
    target = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot")
        .otherwise(F.col("id").cast("string")).alias("k"),
        F.concat(F.lit("old"), F.col("id").cast("string")).alias("v"),
    )
    source = spark.createDataFrame([("hot", "new"), ("fresh", "new")], "k STRING, v STRING")
    merged = merge_upsert(target, source, "k")
    counts = {r["v"]: r["count"] for r in merged.groupBy(F.left("v", F.lit(3)).alias("v")).count().collect()}
    assert counts == {"new": ROWS // 3 + 1, "old": 2 * ROWS // 3}
    assert "skew=true" in final_plan(merged)


def test_equal_rows_of_a_hot_key_are_split(spark):
    facts = spark.range(100_000).select(F.lit("hot").alias("k")).repartition(4)
    dim = spark.createDataFrame([("hot", "found")], "k STRING, v STRING")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_lookup(facts, dim, F.col("k"), "k", {"v": "v"})
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        nulls = salted_lookup(
            facts.select(F.lit(None).cast("string").alias("k")), dim, F.col("k"), "k", {"v": "v"}
        )
        null_sizes = [r["count"] for r in nulls.groupBy(F.spark_partition_id()).count().collect()]
        scans = salted_lookup(
            spark.range(10).selectExpr("id AS k"), dim, F.col("k").cast("string"), "k", {"v": "v"},
            row_id=F.col("k"),
        )
        assert scans.count() == 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for found in (sizes, null_sizes):
        assert sum(found) == 100_000 and len(found) >= 8 and max(found) < 40_000
    assert out.where("v = 'found'").count() == 100_000


def test_sync_with_a_unique_target_is_one_join(spark):
    from tillbook.operators.merge import merge_sync

    target = spark.createDataFrame([("a", 1, "t"), ("b", 2, "u"), (None, 3, "v")], "k STRING, x INT, note STRING")
    source = spark.createDataFrame([("a", None), ("c", 9), (None, 7)], "k STRING, x INT")
    rows = lambda df: sorted(map(tuple, df.collect()))
    once = merge_sync(target, source, "k", target_unique=True)
    assert rows(once) == rows(merge_sync(target, source, "k")) == [("a", None, "t"), ("c", 9, None)]
    twice = target.union(target.where("k = 'a'"))
    with pytest.raises(Exception, match="duplicate k"):
        merge_sync(twice, source, "k", target_unique=True).collect()


@pytest.mark.parametrize("name", ["daily", "daily_history", "monthly", "monthly_history"])
def test_malformed_text_dates_are_null(spark, name):
    from datetime import date

    from tillbook.plans import terminals

    txns = spark.createDataFrame(
        [("2057AB12", "5", "M1", "S", "2025-06-03"), ("2057AB12", "7", "M1", "S", "n/a")],
        "terminal_id STRING, amount STRING, merchant_id STRING, merchant STRING, date STRING",
    )
    roster = spark.createDataFrame([("2057AB12", "LA")], "terminal_id STRING, state STRING")
    banks = spark.createDataFrame([("2057", "B")], "bank_code STRING, bank STRING")
    states = spark.createDataFrame([("LA", "Lagos", "SW")], "state_initials STRING, state STRING, region STRING")
    if name == "daily":
        out = terminals.daily_terminal(txns, roster, None, banks, states, date(2025, 6, 6))
    elif name == "daily_history":
        out = terminals.daily_terminal_history(txns, roster, None, banks, states)
    elif name == "monthly":
        out = terminals.monthly_terminal(txns, banks, date(2025, 6, 6))
    else:
        out = terminals.monthly_terminal_history(txns, banks)
    dates = {r["date"] for r in out.collect()}
    assert "n/a" not in dates and len(dates) == (2 if "history" in name else 1)
