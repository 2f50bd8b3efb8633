"""Streams of event-time windows: every row is in a closed window, an open one or the side table."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillbook.functions.periods import day_of
from tillbook.operators.rollups import daily_activity
from tillbook.streaming import loads
from tillbook.streaming.windows import activity_windows, daily_windows

SCHEMA = (
    "txn INT, wallet STRING, terminal STRING, category STRING, amount DECIMAL(18,2), updated_at TIMESTAMP_NTZ"
)


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def files(spark, path, *days):
    """A file each of three rows a day."""
    for number, some in enumerate(days):
        spark.createDataFrame(
            [
                (number * 100 + d * 3 + n, "w", f"t{n}", None if n else "c", Decimal(d), at(d, n))
                for d in some
                for n in range(3)
            ],
            SCHEMA,
        ).coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, **options):
    rows = loads.file_stream(spark, "parquet", path, SCHEMA, max_files=1, **options)
    return rows.withColumn("day", day_of(F.col("updated_at")))


def drain(windows, stream, out):
    query = windows.write(stream, f"{out}/rows", f"{out}/checkpoint")
    query.awaitTermination()
    return [p for p in query.recentProgress]


def by_day(spark, out, windows):
    place = (spark, f"{out}/rows", f"{out}/checkpoint")
    def days(df):
        return sorted({r[0].day for r in df.select(F.to_date("updated_at")).collect()})

    return days(windows.closed(*place)), days(windows.open(spark, place[2])), days(windows.late(*place))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_windows_and_side_table_equal_batch(spark, tmp_path, rows, zone):
    """Files in no order of time, one a batch, far more than the delay apart."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    files(spark, src, (20, 1), (3, 28), (1, 20), (9,), (27, 28))
    windows = daily_windows("2 days")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        drain(windows, stream_of(spark, src), out)
        place = (spark, f"{out}/rows", f"{out}/checkpoint")
        assert by_day(spark, out, windows) == ([1, 3, 20], [27, 28], [1, 9])
        want = daily_activity(spark.read.schema(SCHEMA).parquet(src))
        got = windows.current(*place).select(*want.columns)
        assert rows(got.withColumn("value", F.col("value").cast("decimal(38,2)"))) == rows(want)
        counts = windows.late_counts(*place)
        assert rows(counts.select("batch_id", "rows", "windows")) == [(2, 3, 1), (3, 3, 1)]
        in_one_place_each(spark, src, windows, place)
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def in_one_place_each(spark, src, windows, place):
    parts = windows.closed(*place), windows.open(spark, place[2]), windows.late(*place)
    assert sum(p.agg(F.sum("volume")).first()[0] for p in parts) == spark.read.parquet(src).count()
    closed, still, _ = (
        {tuple(r) for r in p.select("window_start", "terminal", "category").collect()} for p in parts
    )
    assert not closed & still and len(closed) == windows.closed(*place).count()


def test_a_restart_goes_on_from_the_state(spark, tmp_path, rows):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    windows = daily_windows("3 days")
    for some in ((5, 6), (7, 2), (1, 12)):
        files(spark, src, some)
        drain(windows, stream_of(spark, src), out)
    want = daily_activity(spark.read.schema(SCHEMA).parquet(src))
    got = windows.current(spark, f"{out}/rows", f"{out}/checkpoint").select(*want.columns)
    assert rows(got.withColumn("value", F.col("value").cast("decimal(38,2)"))) == rows(want)


def test_a_replayed_batch_replaces_its_first_attempt(spark, tmp_path, rows):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    windows = daily_windows("1 day")
    files(spark, src, (5,), (9,), (4, 20))
    drain(windows, stream_of(spark, src), out)
    # As after a crash between the write and the commit of the last batches.
    commits = sorted((tmp_path / "out" / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for commit in commits[2:]:
        commit.unlink()
    for crc in (tmp_path / "out" / "checkpoint" / "commits").glob(".*.crc"):
        crc.unlink()
    drain(windows, stream_of(spark, src), out)
    want = daily_activity(spark.read.schema(SCHEMA).parquet(src))
    got = windows.current(spark, f"{out}/rows", f"{out}/checkpoint").select(*want.columns)
    assert rows(got.withColumn("value", F.col("value").cast("decimal(38,2)"))) == rows(want)


def test_state_holds_open_windows_only(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    files(spark, src, *[(day,) for day in range(1, 13)])
    progress = drain(daily_windows("2 days"), stream_of(spark, src), out)
    held = [p.stateOperators[0].numRowsTotal for p in progress]
    # Three windows a day, of the days that the delay keeps open and the one after.
    assert max(held) <= 3 * 5 and len(progress) >= 12


def test_rows_without_a_time_are_late(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(
        [(1, "w", "t", "c", Decimal(1), None), (2, "w", "t", "c", None, at(3))], SCHEMA
    ).coalesce(1).write.parquet(src)
    windows = daily_windows("1 day")
    drain(windows, stream_of(spark, src), out)
    place = (spark, f"{out}/rows", f"{out}/checkpoint")
    found = {(r["day"], r["volume"], r["value"]) for r in windows.current(*place).collect()}
    assert found == {(None, 1, Decimal("1.00")), (at(3).date(), 1, None)}
    assert windows.late(*place).first()["window_start"] is None


def test_an_empty_stream_has_no_windows(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(src)
    windows = daily_windows()
    drain(windows, stream_of(spark, src), out)
    assert windows.current(spark, f"{out}/rows", f"{out}/checkpoint").collect() == []


def test_repeats_are_counted_once(spark, tmp_path, rows):
    """The same files twice, the second time after a restart and within the delay."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    windows = daily_windows("10 days", unique=("txn",))
    files(spark, src, (5, 6), (7,))
    drain(windows, stream_of(spark, src), out)
    files(spark, src, (5, 6), (7,), (8,))
    progress = drain(windows, stream_of(spark, src), out)
    once = spark.read.schema(SCHEMA).parquet(src).dropDuplicates(["txn"])
    want = daily_activity(once)
    got = windows.current(spark, f"{out}/rows", f"{out}/checkpoint").select(*want.columns)
    assert rows(got.withColumn("value", F.col("value").cast("decimal(38,2)"))) == rows(want)
    assert windows.late(spark, f"{out}/rows", f"{out}/checkpoint").count() == 0
    assert len(progress[0].stateOperators) == 2


def test_keys_of_repeats_leave_the_state(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    files(spark, src, *[(day,) for day in range(1, 11)])
    progress = drain(daily_windows("2 days", unique=("txn",)), stream_of(spark, src), out)
    for operator in (0, 1):
        assert max(p.stateOperators[operator].numRowsTotal for p in progress) <= 3 * 7


def test_latest_activity_after_a_restart_in_mid_stream(spark, tmp_path, rows):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    windows = activity_windows("2 days", unique=("txn",))

    def activity():
        return stream_of(spark, src).select(
            "txn", F.col("terminal").alias("terminal_id"), F.col("updated_at").alias("transaction_time"), "updated_at"
        )

    files(spark, src, (5, 6), (2, 9))
    drain(windows, activity(), out)
    files(spark, src, (1, 4), (20,), (19, 3))
    progress = drain(windows, activity(), out)
    want = loads.latest_activity(
        spark.read.schema(SCHEMA).parquet(src).select(
            F.col("terminal").alias("terminal_id"), F.col("updated_at").alias("transaction_time"), "updated_at"
        )
    )
    got = windows.totals(spark, f"{out}/rows", f"{out}/checkpoint")
    assert rows(got.select(*want.columns)) == rows(want)
    assert all(o.numRowsTotal <= 3 * 5 for p in progress for o in p.stateOperators)
