"""Counts of micro-batches against the rows they wrote."""

from __future__ import annotations

import shutil
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillbook.streaming import loads
from tillbook.streaming.ledger import Ledger, counted, ledger_rows, reconcile

SCHEMA = "k STRING, amount DECIMAL(18,2)"


def add(spark, path, rows):
    rows = [(k, None if a is None else Decimal(a)) for k, a in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def books(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"), f"load-{uuid.uuid4().hex}")
    spark.streams.addListener(ledger)
    yield ledger
    spark.streams.removeListener(ledger)


def run(spark, tmp_path, books, name=None):
    stream = loads.file_stream(spark, "parquet", str(tmp_path / "in"), SCHEMA, max_files=1)
    kept = counted(counted(stream, "read").where("amount is not null"), "kept", "amount")
    books.settle(
        loads.write_batches(
            kept, str(tmp_path / "out"), str(tmp_path / "checkpoint"), name=name or books.name
        )
    )


def compared(spark, tmp_path, stage="kept", totals=("amount",)):
    rows = reconcile(
        ledger_rows(spark, str(tmp_path / "ledger")),
        loads.batch_rows(spark, str(tmp_path / "out")), stage, totals,
    )
    return [tuple(r)[1:] for r in rows.orderBy("batch_id").collect()]


def test_every_batch_is_counted_and_agrees(spark, tmp_path, books):
    add(spark, str(tmp_path / "in"), [("a", "1.25"), ("b", None)])
    add(spark, str(tmp_path / "in"), [("c", None)])
    run(spark, tmp_path, books)
    add(spark, str(tmp_path / "in"), [("d", "2.50"), ("d", "2.50"), (None, "-1.00")])
    run(spark, tmp_path, books)
    counts = {
        (r["batch_id"], r["stage"]): (r["rows"], r["totals"])
        for r in ledger_rows(spark, str(tmp_path / "ledger")).collect()
    }
    assert sorted(n for (_, stage), (n, _) in counts.items() if stage == "read") == [1, 2, 3]
    assert sum(t["amount"] or 0 for (_, s), (_, t) in counts.items() if s == "kept") == Decimal("5.25")
    rows = compared(spark, tmp_path)
    assert [r[0] for r in rows] == [0, 1, 2] and all(r[3] for r in rows)
    assert sorted(r[1:3] for r in rows) == [(0, 0), (1, 1), (3, 3)]
    # Rows were rejected between reading and writing: the first stage does not agree.
    assert sorted(r[3] for r in compared(spark, tmp_path, "read", ())) == [False, False, True]


def test_a_replayed_batch_replaces_its_counts(spark, tmp_path, books):
    add(spark, str(tmp_path / "in"), [("a", "1.25"), ("b", "3.00")])
    run(spark, tmp_path, books)
    for commit in (tmp_path / "checkpoint" / "commits").glob("*"):
        commit.unlink()
    run(spark, tmp_path, books)
    assert compared(spark, tmp_path) == [(0, 2, 2, True)]


def test_lost_rows_and_lost_counts_show(spark, tmp_path, books):
    for n in range(3):
        add(spark, str(tmp_path / "in"), [("a", "1.25")] * (n + 1))
    run(spark, tmp_path, books)
    (stream,) = (tmp_path / "out").glob("stream_id=*")
    shutil.rmtree(stream / "batch_id=1")
    shutil.rmtree(tmp_path / "ledger" / stream.name / "batch_id=2")
    rows = compared(spark, tmp_path)
    assert [r[3] for r in rows] == [True, False, False]
    assert rows[1][2] == 0 and rows[2][1] is None


def test_a_changed_amount_shows(spark, tmp_path, books):
    add(spark, str(tmp_path / "in"), [("a", "1.25")])
    run(spark, tmp_path, books)
    found = loads.batch_rows(spark, str(tmp_path / "out")).withColumn("amount", F.col("amount") + 1)
    ledger = ledger_rows(spark, str(tmp_path / "ledger"))
    assert [r["agrees"] for r in reconcile(ledger, found, "kept").collect()] == [True]
    assert [r["agrees"] for r in reconcile(ledger, found, "kept", ["amount"]).collect()] == [False]


def test_other_streams_and_empty_ledgers(spark, tmp_path, books):
    add(spark, str(tmp_path / "in"), [("a", "1.25")])
    run(spark, tmp_path, books, name=f"other-{uuid.uuid4().hex}")
    assert ledger_rows(spark, str(tmp_path / "ledger")).count() == 0
    assert compared(spark, tmp_path) == [(0, None, 1, False)]


def test_what_a_listener_cannot_write_is_raised(spark, tmp_path, books):
    (tmp_path / "ledger").write_text("not a folder")
    add(spark, str(tmp_path / "in"), [("a", "1.25")])
    with pytest.raises(Exception, match="ledger"):
        run(spark, tmp_path, books)
