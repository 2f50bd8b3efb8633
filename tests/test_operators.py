from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillbook.operators import dedup as dd
from tillbook.operators import lookup as lk
from tillbook.operators import rollups as ru

D = Decimal


# Lookups


def test_lookup_keeps_every_fact_and_fans_out(frame, rows):
    facts = frame([(1, "a"), (2, "b"), (3, None)], "n INT, k STRING")
    dim = frame([("a", "x"), ("a", "y"), (None, "z")], "id STRING, v STRING")
    out = lk.lookup(facts, dim, F.col("k"), "id", {"value": "v"})
    assert rows(out) == [(1, "a", "x"), (1, "a", "y"), (2, "b", None), (3, None, None)]


def test_unique_lookup_fails_on_repeated_keys(frame, rows):
    facts = frame([(1, "a")], "n INT, k STRING")
    good = frame([("a", "x"), (None, "z"), (None, "w")], "id STRING, v STRING")
    out = lk.lookup(facts, good, F.col("k"), "id", {"value": "v"}, unique=True)
    assert rows(out) == [(1, "a", "x")]
    bad = frame([("a", "x"), ("q", "1"), ("q", "2")], "id STRING, v STRING")
    with pytest.raises(Exception, match="duplicate id: q"):
        lk.lookup(facts, bad, F.col("k"), "id", {"value": "v"}, unique=True).collect()


def test_salted_lookup_equals_lookup(spark, rows):
    facts = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
    )
    dim = spark.range(40).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
    dim = dim.unionByName(spark.createDataFrame([("hot", -1), ("hot", -2)], "key STRING, v BIGINT"))
    take = {"v": "v"}
    plain = lk.lookup(facts, dim, F.col("k"), "key", take)
    salted = lk.salted_lookup(facts, dim, F.col("k"), "key", take, share=0.1, salts=7)
    assert salted.count() == 4000
    assert rows(salted) == rows(plain)


def test_salting_spreads_hot_and_null_keys(spark):
    facts = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id").cast("string")).alias("k"),
    )
    dim = spark.createDataFrame([("hot", 1)], "key STRING, v INT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = {
            label: max(
                r["count"]
                for r in join.groupBy(F.spark_partition_id()).count().collect()
            )
            for label, join in (
                ("plain", lk.lookup(facts, dim, F.col("k"), "key", {"v": "v"})),
                ("salted", lk.salted_lookup(facts, dim, F.col("k"), "key", {"v": "v"})),
            )
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes["plain"] >= 3000
    assert sizes["salted"] < 2000


def test_heavy_keys_are_bounded_by_the_share(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert lk.heavy_keys(df, F.col("k"), 0.1).count() == 10
    assert lk.heavy_keys(df, F.col("k"), 0.11).count() == 0


def test_flags(frame, rows):
    df = frame([("a",), ("b",), (None,)], "terminal_id STRING")
    members = frame([("a",), ("a",), (None,)], "terminal_id STRING")
    assert rows(lk.flag_membership(df, members, "f")) == [(None, 0), ("a", 1), ("b", 0)]
    assert rows(lk.flag_membership(df, None, "f")) == [(None, 0), ("a", 0), ("b", 0)]


def test_last_activity_without_activity_set(frame):
    out = lk.add_last_activity(frame([("a",)], "terminal_id STRING"), None)
    assert out.dtypes[-1] == ("last_transaction_time", "string") and out.first()[1] is None


def test_bank_and_override(frame, rows):
    df = frame(
        [("2.0351234", "NOVA 1"), ("20351234", "nova"), ("99", None)], "terminal_id STRING, merchant STRING"
    )
    banks = frame([("2.035", "B1"), ("2035", "B2")], "bank_code STRING, bank STRING")
    banked = lk.add_bank(df, banks)
    out = lk.override_when(banked, "bank", F.col("merchant").startswith("NOVA"), "NOVA BANK")
    assert rows(out.select("terminal_id", "bank")) == [
        ("2.0351234", "NOVA BANK"), ("20351234", "B2"), ("99", None),
    ]
    assert rows(lk.match_stats(banked, "bank")) == [(2, 1)]


def test_state_by_name_ignores_case(frame, rows):
    agents = lk.prepare_agent_states(
        frame([("w1", " lagos "), ("w2", "Federal Capital territory"), ("w3", None)],
              "wallet_id STRING, state_of_residence STRING")
    )
    states = frame([("Lagos", "SW"), (" Abuja", "NC")], "state STRING, region STRING")
    out = lk.add_state_by_name(agents, states).select("wallet_id", "agent_state", "state", "region")
    assert rows(out) == [
        ("w1", "lagos", "Lagos", "SW"), ("w2", "Abuja", " Abuja", "NC"), ("w3", None, None, None),
    ]


def test_without_match(frame, rows):
    left = frame([("a",), ("b",), (None,)], "k STRING")
    right = frame([("a",), ("a",), (None,)], "k STRING")
    assert rows(lk.without_match(left, right, "k")) == [(None,), ("b",)]


# Rollups


def test_daily_activity(frame, rows):
    t = datetime
    df = frame(
        [
            ("w", "t", "c", D("1.10"), t(2025, 1, 1, 0)), ("w", "t", "c", D("2.20"), t(2025, 1, 1, 23)),
            ("w", "t", "c", None, t(2025, 1, 2)), (None, None, None, D("5.00"), t(2025, 1, 1)),
        ],
        "wallet STRING, terminal STRING, category STRING, amount DECIMAL(18,2), updated_at TIMESTAMP_NTZ",
    )
    assert rows(ru.daily_activity(df)) == [
        (None, None, None, date(2025, 1, 1), 1, D("5.00"), t(2025, 1, 1)),
        ("w", "t", "c", date(2025, 1, 1), 2, D("3.30"), t(2025, 1, 1, 23)),
        ("w", "t", "c", date(2025, 1, 2), 1, None, t(2025, 1, 2)),
    ]


TXN = "terminal_id STRING, merchant_id STRING, merchant STRING, amount DECIMAL(18,2), date TIMESTAMP_NTZ"


def test_terminal_summary(frame, rows):
    t = datetime
    df = frame(
        [
            ("a", "m2", "B", D("10.00"), t(2025, 1, 2)), ("a", "m1", "A", D("20.00"), t(2025, 1, 1)),
            ("a", "m0", "Z", D("1.00"), None), ("a", None, None, D("0.01"), t(2025, 1, 1)),
            (None, "m9", "N", D("3.00"), t(2025, 1, 3)),
        ],
        TXN,
    )
    assert rows(ru.terminal_summary(df, rate_scale=4)) == [
        (None, 0, D("3.00"), D("0.003900"), "m9", "N", t(2025, 1, 3)),
        ("a", 4, D("31.01"), D("0.040313"), "m1", "A", t(2025, 1, 1)),
    ]


def test_terminal_summary_does_not_depend_on_partitioning(spark, sf_dir, rows):
    from catalogue.inputs import load

    txns = load(spark, sf_dir, "pos_txn")
    expected = rows(ru.terminal_summary(txns, rate_scale=6))
    for n in (1, 7):
        assert rows(ru.terminal_summary(txns.repartition(n, "merchant"), rate_scale=6)) == expected


def test_state_rollup_counts_wallets_once_per_state(frame, rows):
    totals = frame(
        [("w1", 2, D("5.00"), "Lagos", "SW"), ("w1", 2, D("5.00"), "Lagos", "SW"),
         ("w2", 1, None, "Lagos", "SW"), (None, 3, D("1.00"), None, None)],
        "wallet STRING, volume BIGINT, value DECIMAL(38,2), state STRING, region STRING",
    )
    assert rows(ru.state_rollup(totals)) == [
        (None, None, 3, D("1.00"), 0), ("Lagos", "SW", 5, D("10.00"), 2),
    ]


def test_paging_and_order(frame):
    df = frame([(i, datetime(2025, 1, 1 + i % 3)) for i in range(10)], "_id INT, ts TIMESTAMP_NTZ")
    assert [r["_id"] for r in ru.first_page(df, "_id", 3).collect()] == [0, 1, 2]
    assert [r["_id"] for r in ru.first_page(df, "_id", 3, after=2).collect()] == [3, 4, 5]
    assert [r["_id"] for r in ru.top_recent(df, "ts", 4, "_id").collect()] == [2, 5, 8, 1]
    plan = ru.top_recent(df, "ts", 4, "_id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_counting_stages_adds_no_pass(frame):
    df, seen = ru.count_rows(frame([(1,), (2,), (3,)], "a INT"), "read")
    df, kept = ru.count_rows(df.where("a > 1"), "kept")
    df.write.format("noop").mode("overwrite").save()
    assert (seen.get["rows"], kept.get["rows"]) == (3, 2)


def test_rollups_of_nothing(frame):
    assert ru.terminal_summary(frame([], TXN), rate_scale=4).isEmpty()
    bounds = ru.key_bounds(frame([], "k STRING"), "k").first()
    assert tuple(bounds) == (None, None)


# Deduplication


SCHEMA = "k STRING, status STRING, amount INT"
ROWS = [
    ("a", "S", 2), ("a", "F", 9), ("a", "F", 3), (None, "S", 1), (None, "S", 0), ("b", None, 1), ("b", "F", 0),
]


def test_dedup_picks_by_order(frame, rows):
    df = frame(ROWS, SCHEMA)
    assert rows(dd.dedup(df, ["k"], ["status", "amount"])) == [
        (None, "S", 0), ("a", "F", 3), ("b", None, 1),
    ]
    assert rows(dd.dedup(df, ["k"], ["amount"], keep="last")) == [
        (None, "S", 1), ("a", "F", 9), ("b", None, 1),
    ]
    assert dd.dedup(df, ["k"]).columns == df.columns


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dedup_is_idempotent_and_order_free(frame, rows, parts):
    df = frame(ROWS * 3, SCHEMA)
    once = dd.dedup(df, ["k"], ["amount"])
    shuffled = dd.dedup(df.repartition(parts).orderBy(F.rand(7)), ["k"], ["amount"])
    assert rows(once) == rows(shuffled) == rows(dd.dedup(once, ["k"], ["amount"]))


def test_dedup_on_every_column(frame, rows):
    df = frame([("a", 1), ("a", 1), ("a", 2)], "k STRING, n INT")
    assert rows(dd.dedup(df, ["k", "n"])) == [("a", 1), ("a", 2)]


def test_dedup_combines_before_the_shuffle(spark):
    hot = spark.range(0, 100000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("n"))
    out = dd.dedup(hot, ["k"], ["n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")
    assert out.collect() == [("hot", 0)]


def test_dedup_if_present(frame):
    df = frame([("a",), ("a",)], "merchantid STRING")
    assert dd.dedup_if_present(df, "merchant_id").count() == 2


def test_unions_match_names(frame, rows):
    a, b = frame([(1, "x")], "n INT, s STRING"), frame([("y", 2), ("x", 1)], "s STRING, n INT")
    assert rows(dd.union_all([a, b])) == [(1, "x"), (1, "x"), (2, "y")]
    assert rows(dd.union_distinct_rows([a, b], ["n"])) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        dd.union_all([])
