"""Tables cut by a hash of their key: merges of touched buckets, joins without shuffles."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillbook.operators.lookup import flag_membership, flag_memberships
from tillbook.operators.merge import merge_upsert
from tillbook.plans.roster import terminal_roster
from tillbook.sources.buckets import KeyedTable, write_bucketed

SCHEMA = "k STRING, state STRING, note STRING"


def table_of(tmp_path, buckets=32):
    return KeyedTable(str(tmp_path / "t"), "k", buckets)


def files(tmp_path):
    return {p for p in (tmp_path / "t" / "data").rglob("*.parquet")}


def test_an_upsert_rewrites_the_touched_buckets_alone(spark, tmp_path, frame, rows):
    table = table_of(tmp_path)
    first = spark.range(4000).selectExpr("CAST(id AS STRING) AS k", "'old' AS state", "'n' AS note")
    table.upsert(first, "1")
    before = files(tmp_path)
    change = frame([("7", "new"), ("8", None), ("x", "new")], "k STRING, state STRING")
    written = table.upsert(change, "2")
    new = files(tmp_path) - before
    assert len(written) <= 3 and len(new) == len(written)
    assert sum(p.stat().st_size for p in new) < 0.2 * sum(p.stat().st_size for p in before)
    assert rows(table.read(spark)) == rows(merge_upsert(first, change, "k"))


def test_versions_one_after_another(spark, tmp_path, frame, rows):
    table, want = table_of(tmp_path, 4), None
    loads = [
        [("a", "1", "x"), ("b", "1", "y"), (None, "1", "z"), ("a", "2", "again")],
        [("c", "3", None), (None, "4", "w")],
        [],
        [("b", None, None), ("d", "5", "v")],
    ]
    for number, load in enumerate(loads):
        source = frame(load, SCHEMA)
        want = merge_upsert(want, source, "k", source_unique=True)
        table.upsert(source, str(number), source_unique=True)
        assert rows(table.read(spark)) == rows(want)


def test_an_empty_first_load_is_a_version(spark, tmp_path, frame, rows):
    table = table_of(tmp_path)
    assert table.read(spark) is None
    table.upsert(frame([], SCHEMA), "1")
    assert table.read(spark).collect() == [] and table.read(spark).columns == ["k", "state", "note"]
    table.upsert(frame([("a", "1", "x")], SCHEMA), "2")
    assert rows(table.read(spark)) == [("a", "1", "x")]


def test_a_load_that_died_leaves_no_trace(spark, tmp_path, frame, rows):
    table = table_of(tmp_path, 4)
    table.upsert(frame([("a", "1", "x")], SCHEMA), "1")
    twice = frame([("a", "2", "x"), ("a", "3", "x")], SCHEMA)
    with pytest.raises(PySparkException):
        table.upsert(twice, "2")
    assert rows(table.read(spark)) == [("a", "1", "x")]
    table.upsert(frame([("a", "2", "x")], SCHEMA), "2")
    with pytest.raises(ValueError, match="exists"):
        table.upsert(frame([("a", "9", "x")], SCHEMA), "1")
    assert rows(table.read(spark)) == [("a", "2", "x")]


def test_upsert_reads_each_side_once(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("target", "source")]
    for path in paths:
        spark.range(50).selectExpr("CAST(id AS STRING) AS k", "'s' AS state").write.parquet(path)
    target, source = (spark.read.parquet(p) for p in paths)
    plan = merge_upsert(target, source, "k", source_unique=True, one_join=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_one_join_gives_the_rows_of_two(frame, rows):
    target = frame([("a", "1", "x"), ("a", "2", "y"), ("b", "1", None), (None, "1", "z")], SCHEMA)
    source = frame([("a", None), ("c", "9"), (None, "8")], "k STRING, state STRING")
    for update in (None, ["state"], []):
        assert rows(merge_upsert(target, source, "k", update, one_join=True)) == rows(
            merge_upsert(target, source, "k", update)
        )


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange")


def test_bucketed_roster_has_no_exchange(spark, rows):
    def named(name, df):
        table = f"{name}_{uuid.uuid4().hex}"
        write_bucketed(df, table, "terminal_id", 8)
        return spark.table(table)

    ids = spark.range(300).selectExpr("CAST(id % 200 AS STRING) AS terminal_id", "CONCAT('S', id) AS state")
    sets = [ids.where(f"terminal_id % {n} = 0").select("terminal_id") for n in (2, 3, 5)]
    activity = ids.groupBy("terminal_id").agg(F.max("state").alias("last_transaction_time"))
    inputs = [ids, *sets, activity]
    tables = [named(n, df) for n, df in zip(("registered", "connected", "active", "inactive", "activity"), inputs)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed = terminal_roster(*tables, order=["state"])
        assert exchanges(bucketed) == 0 < exchanges(terminal_roster(*inputs, order=["state"]))
        assert rows(bucketed) == rows(terminal_roster(*inputs, order=["state"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_all_flags_from_one_join(frame, rows):
    df = frame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "terminal_id STRING, n INT")
    sets = {
        "one": frame([("a",), ("a",), (None,)], "terminal_id STRING"),
        "two": None,
        "three": frame([("b",), ("c",)], "terminal_id STRING"),
    }
    want = df
    for flag, ids in sets.items():
        want = flag_membership(want, ids, flag)
    got = flag_memberships(df, sets)
    assert rows(got) == rows(want) and got.dtypes == want.dtypes
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert rows(flag_memberships(df, {"x": None})) == rows(flag_membership(df, None, "x"))
