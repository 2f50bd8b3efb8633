"""Merges, incremental loads and streams."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tillbook.plans.loads  # noqa: F401
from tillbook import plans
from tillbook.operators.incremental import (
    high_watermark,
    rows_after,
    rows_between,
    time_watermark,
)
from tillbook.operators.merge import merge_sync, merge_upsert
from tillbook.streaming import loads

TARGET = "k STRING, state STRING, note STRING"


@pytest.fixture
def target(frame):
    return frame(
        [("a", "S1", "old"), ("b", "S2", "old"), ("b", "S3", "twin"), (None, "S4", "null"), ("z", "S5", "gone")],
        TARGET,
    )


@pytest.fixture
def source(frame):
    return frame([("a", "N1"), ("b", None), ("n", "N3"), (None, "N4")], "k STRING, state STRING")


def test_upsert(target, source, rows):
    assert rows(merge_upsert(target, source, "k")) == [
        (None, "N4", None), (None, "S4", "null"), ("a", "N1", "old"), ("b", None, "old"),
        ("b", None, "twin"), ("n", "N3", None), ("z", "S5", "gone"),
    ]


def test_upsert_of_chosen_columns(target, frame, rows):
    source = frame([("a", "N1", "new"), ("n", "N2", "new")], TARGET)
    merged = merge_upsert(target.where("k IS NOT NULL"), source, "k", ["state"])
    assert rows(merged) == [
        ("a", "N1", "old"), ("b", "S2", "old"), ("b", "S3", "twin"), ("n", "N2", "new"), ("z", "S5", "gone"),
    ]


def test_sync(target, source, rows):
    assert rows(merge_sync(target, source, "k")) == [
        ("a", "N1", "old"), ("b", None, "old"), ("b", None, "twin"), ("n", "N3", None),
    ]


def test_sync_keys_are_the_source_keys(spark, rows):
    target = spark.range(0, 100).select(F.col("id").cast("string").alias("k"), F.lit("t").alias("v"))
    source = spark.range(50, 150).select(F.col("id").cast("string").alias("k"), F.lit("s").alias("v"))
    assert rows(merge_sync(target, source, "k")) == rows(source)


@pytest.mark.parametrize("merge", [merge_upsert, merge_sync])
def test_duplicate_source_keys_fail(target, frame, merge):
    source = frame([("a", "1"), ("a", "2")], "k STRING, state STRING")
    with pytest.raises(Exception, match="duplicate k: a"):
        merge(target, source, "k").collect()


@pytest.mark.parametrize("merge", [merge_upsert, merge_sync])
def test_duplicate_check_survives_a_later_join(target, frame, merge):
    source = frame([("a", "1"), ("a", "2")], "k STRING, state STRING")
    facts = frame([("a",)], "k STRING")
    with pytest.raises(Exception, match="duplicate k: a"):
        facts.join(merge(target, source, "k"), "k").collect()


@pytest.mark.parametrize("merge", [merge_upsert, merge_sync])
def test_merge_without_target_and_of_nothing(target, source, frame, rows, merge):
    assert rows(merge(None, source, "k")) == rows(source)
    nothing = frame([], "k STRING, state STRING")
    expected = rows(target) if merge is merge_upsert else []
    assert rows(merge(target, nothing, "k")) == expected


def test_merge_needs_the_source_columns(target, frame):
    with pytest.raises(ValueError, match="lacks"):
        merge_upsert(target, frame([("a", 1)], "k STRING, other INT"), "k")


# Incremental loads

JOURNAL = "_id INT, ts TIMESTAMP_NTZ"


def at(*parts):
    return datetime(2025, 1, *parts)


def test_watermarks(frame):
    loaded = frame([(3, at(5)), (9, at(4))], JOURNAL)
    assert high_watermark(loaded, "_id").first()[0] == 9
    assert time_watermark(loaded, "ts", at(20)).first()[0] == at(5)
    nothing = frame([], JOURNAL)
    assert high_watermark(nothing, "_id").first()[0] is None
    assert time_watermark(nothing, "ts", at(20)).first()[0] == datetime(2024, 12, 31, 23, 59, 59, 999000)


def test_rows_after(frame, rows):
    journal = frame([(i, at(i)) for i in range(1, 6)], JOURNAL)
    loaded = frame([(3, at(3))], JOURNAL)
    assert [r[0] for r in rows(rows_after(journal, loaded, "_id"))] == [4, 5]
    assert [r[0] for r in rows(rows_after(journal, loaded, "_id", inclusive=True))] == [3, 4, 5]
    assert rows_after(journal, frame([], JOURNAL), "_id").count() == 5


def test_rows_between_skips_loaded_boundary_rows(frame, rows):
    journal = frame([(1, at(1)), (2, at(2)), (3, at(2)), (4, at(3)), (5, at(9))], JOURNAL)
    loaded = frame([(1, at(1)), (2, at(2))], JOURNAL)
    new = rows_between(journal, loaded, ts="ts", key="_id", as_of=at(8))
    assert [r[0] for r in rows(new)] == [3, 4]


def test_slices_add_up_to_one_load(frame, rows):
    journal = frame([(i, at(1 + i % 20, i % 24)) for i in range(200)], JOURNAL)
    loaded = frame([], JOURNAL)
    for upto in (5, 11, 20, 25):
        arrived = journal.where(F.col("ts") < F.lit(f"2025-01-{upto:02d}").cast("timestamp_ntz"))
        new = rows_between(arrived, loaded, ts="ts", key="_id", as_of=at(upto))
        # Plain rows cut the growing lineage of the test.
        loaded = frame([tuple(r) for r in loaded.unionByName(new).collect()], JOURNAL)
    assert rows(loaded) == rows(journal)


def scans_of(df, column):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and column in line]


def test_watermarks_reach_the_scan(spark, sf_dir):
    from catalogue.inputs import load

    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    loaded = load(spark, sf_dir, "journal_target").withColumnsRenamed({"_id": "event_id"})
    by_key = scans_of(rows_after(source, loaded, "event_id"), "user_id")
    assert len(by_key) == 1 and "GreaterThan(event_id," in by_key[0]

    new = rows_between(
        source, loaded, ts="ts", target_ts="transactiontime", key="event_id", as_of=datetime(2024, 2, 1)
    )
    by_time = scans_of(new, "user_id")
    assert len(by_time) == 1 and "LessThanOrEqual(ts," in by_time[0]
    data_filters = by_time[0].split("DataFilters:")[1].split("Format:")[0]
    assert "ts" in data_filters and ">= Subquery" in data_filters


def test_increment_layout(frame):
    journal = frame(
        [(1, "Purchase", "655", "x\x00", at(2)), (2, "VAS", "1", "y", at(2))],
        "_id INT, transactionType STRING, amount STRING, customData STRING, transactionTime TIMESTAMP_NTZ",
    )
    out = plans.purchase_increment(journal, frame([], "_id INT"))
    assert len(out.columns) == len(plans.loads.PURCHASE_FIELDS)
    row = out.first()
    assert (row["_id"], row["amount"], row["customdata"], row["maskedpan"]) == (
        1, Decimal("6.5500"), "x", None,
    )
    loaded = frame([], "_id INT, transactiontime TIMESTAMP_NTZ")
    service = plans.service_increment(journal, loaded, at(3))
    assert len(service.columns) == len(plans.loads.SERVICE_FIELDS) and service.count() == 1


# Streams


def events(spark, path, batch):
    spark.createDataFrame(
        batch, "k STRING, ts TIMESTAMP_NTZ, n INT"
    ).coalesce(1).write.mode("append").parquet(path)


SCHEMA = "k STRING, ts TIMESTAMP_NTZ, n INT"


def run(stream, folder, **options):
    loads.write_batches(
        stream, f"{folder}/rows", f"{folder}/checkpoint", **options
    ).awaitTermination()


def test_stream_resumes_where_it_stopped(spark, tmp_path, rows):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, src, [("a", at(1), 1)])
    run(loads.file_stream(spark, "parquet", src, SCHEMA), out)
    events(spark, src, [("b", at(2), 2)])
    run(loads.file_stream(spark, "parquet", src, SCHEMA), out)
    run(loads.file_stream(spark, "parquet", src, SCHEMA), out)
    assert rows(loads.appended_rows(spark, f"{out}/rows")) == [("a", at(1), 1), ("b", at(2), 2)]


def test_replayed_batch_replaces_its_first_attempt(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, src, [("a", at(1), 1)])
    failed = []

    def fail_once(batch):
        if not failed:
            failed.append(True)
            raise RuntimeError("lost")
        return batch

    with pytest.raises(Exception, match="lost"):
        run(loads.file_stream(spark, "parquet", src, SCHEMA), out, transform=fail_once)
    run(loads.file_stream(spark, "parquet", src, SCHEMA), out, transform=fail_once)
    assert loads.appended_rows(spark, f"{out}/rows").count() == 1


def test_keys_load_once_across_batches(spark, tmp_path, rows):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, src, [("a", at(1), 1), ("b", at(1, 1), 2), ("b", at(1, 1), 2)])
    events(spark, src, [("a", at(1, 2), 1), ("c", at(1, 3), 4)])
    stream = loads.file_stream(spark, "parquet", src, SCHEMA, max_files=1)
    run(stream, out, key="k", partition_by=["n"])
    assert [r[0] for r in rows(loads.appended_rows(spark, f"{out}/rows"))] == ["a", "b", "c"]


def test_rows_without_a_key_are_all_loaded(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, src, [(None, at(1), 1), (None, at(1), 1), ("a", at(1), 1)])
    events(spark, src, [(None, at(2), 2), ("a", at(1), 1)])
    stream = loads.file_stream(spark, "parquet", src, SCHEMA, max_files=1)
    run(stream, out, key="k")
    loaded = [r["k"] for r in loads.appended_rows(spark, f"{out}/rows").collect()]
    assert sorted(loaded, key=str) == [None, None, None, "a"]


def test_a_new_checkpoint_adds_to_a_used_target(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, src, [(str(i), at(1), i) for i in range(5)])
    run(loads.file_stream(spark, "parquet", src, SCHEMA), out)
    more = str(tmp_path / "more")
    events(spark, more, [("x", at(2), 1), ("y", at(2), 2)])
    loads.write_batches(
        loads.file_stream(spark, "parquet", more, SCHEMA), f"{out}/rows", f"{out}/second"
    ).awaitTermination()
    assert loads.appended_rows(spark, f"{out}/rows").count() == 7


@pytest.mark.parametrize("name", ["daily", "latest", "once"])
def test_streams_equal_batch_in_any_order_of_files(spark, tmp_path, rows, name):
    """Four files in no order of time, one to a micro-batch, days apart."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = (
        "_id INT, wallet STRING, terminal STRING, category STRING, terminal_id STRING, "
        "amount DECIMAL(18,2), updated_at TIMESTAMP_NTZ, transaction_time TIMESTAMP_NTZ"
    )
    for days in ((20, 1), (3, 28), (1, 20), (9,)):
        spark.createDataFrame(
            [(d * 10 + n, "w", f"t{n}", "c", f"t{n}", Decimal(d), at(d, n), at(d, n)) for d in days for n in range(3)],
            schema,
        ).coalesce(1).write.mode("append").parquet(src)
    stream = loads.file_stream(spark, "parquet", src, schema, max_files=1)
    batch = spark.read.parquet(src)
    if name == "daily":
        run(stream, out, transform=loads.daily_activity)
        want, got = loads.daily_activity(batch), loads.current_daily(spark, f"{out}/rows")
    elif name == "latest":
        run(stream, out, transform=loads.latest_activity)
        want, got = loads.latest_activity(batch), loads.current_latest(spark, f"{out}/rows")
    else:
        run(stream, out, key="_id")
        want, got = batch.dropDuplicates(["_id"]), loads.appended_rows(spark, f"{out}/rows")
    assert len(list((tmp_path / "out" / "rows").glob("stream_id=*/batch_id=*"))) == 4
    assert rows(got.select(*want.columns)) == rows(want)


def test_a_replay_keeps_what_its_first_attempt_loaded(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, src, [("a", at(1), 1)])
    stream = loads.file_stream(spark, "parquet", src, SCHEMA)
    run(stream, out, key="k")
    # As after a crash between the write and the commit: the batch runs again.
    for commit in (tmp_path / "out" / "checkpoint" / "commits").glob("*"):
        commit.unlink()
    run(stream, out, key="k")
    assert loads.appended_rows(spark, f"{out}/rows").count() == 1


def test_last_activity_stream(spark, tmp_path, rows):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, src, [("a", at(1), 1), ("b", at(3), 2)])
    events(spark, src, [("a", at(2), 3)])
    stream = loads.file_stream(spark, "parquet", src, SCHEMA, max_files=1).select(
        F.col("k").alias("terminal_id"), F.col("ts").alias("transaction_time"),
        F.col("ts").alias("updated_at"),
    )
    run(stream, out, transform=loads.latest_activity)
    live = loads.current_latest(spark, f"{out}/rows")
    assert rows(live) == [("a", at(2), at(2)), ("b", at(3), at(3))]
