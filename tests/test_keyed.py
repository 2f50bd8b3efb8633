"""Streams that load each key once by way of a key index."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from tillbook.streaming import loads
from tillbook.streaming.keyed import Index, _set, keyed_rows, load_log, write_keyed

SCHEMA = "k STRING, n INT"


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, src, out, index=Index(8, 2), checkpoint="checkpoint", **options):
    stream = loads.file_stream(spark, "parquet", src, SCHEMA, max_files=1)
    write_keyed(stream, out, f"{out}/{checkpoint}", key="k", index=index, **options).awaitTermination()


def loaded(spark, out):
    return sorted(map(tuple, keyed_rows(spark, out).collect()), key=repr)


def test_a_key_loads_once_and_its_winner_is_defined(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(spark, src, [("a", 3), ("a", 1), ("a", 2), ("b", 5), (None, 1), (None, 1)])
    add(spark, src, [("a", 0), ("c", 9), ("c", 7), (None, 2)])
    run(spark, src, out)
    want = [("a", 1), ("b", 5), ("c", 7), (None, 1), (None, 1), (None, 2)]
    assert loaded(spark, out) == want
    # A second stream finds what the first one loaded.
    run(spark, src, out, checkpoint="second")
    assert [r for r in loaded(spark, out) if r[0]] == want[:3]


def test_a_replay_keeps_what_its_first_attempt_loaded(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(spark, src, [("a", 1), ("b", 2)])
    run(spark, src, out)
    for commit in (tmp_path / "out" / "checkpoint" / "commits").glob("*"):
        commit.unlink()
    run(spark, src, out)
    assert loaded(spark, out) == [("a", 1), ("b", 2)]


def test_a_lost_filter_is_built_from_the_keys(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(spark, src, [(f"k{i}", i) for i in range(40)])
    run(spark, src, out)
    shutil.rmtree(tmp_path / "out" / "filters" / "bucket=3")
    add(spark, src, [(f"k{i}", -i) for i in range(20, 60)])
    run(spark, src, out)
    add(spark, src, [(f"k{i}", -i) for i in range(60)])
    run(spark, src, out)
    assert {k: n for k, n in loaded(spark, out)} == {
        **{f"k{i}": i for i in range(40)}, **{f"k{i}": -i for i in range(40, 60)}
    }
    assert len(loaded(spark, out)) == 60


def test_new_keys_read_no_loaded_ones(spark, tmp_path):
    """What a batch of new keys reads does not grow: filters of one size, no bucket of keys."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in range(8):
        add(spark, src, [(f"{batch}-{i}", i) for i in range(50)])
    run(spark, src, out)
    log = sorted(load_log(spark, out).collect(), key=lambda r: r["batch_id"])
    assert [r["rows"] for r in log] == [50] * 8
    assert {r["buckets"] for r in log} == {8} and {r["buckets_read"] for r in log} == {0}
    cells = spark.read.parquet(f"{out}/filters")
    assert cells.count() == 16 and {r[0] for r in cells.select(F.length("bits")).collect()} == {4096}
    # Loaded keys send the batch to their buckets alone.
    add(spark, src, [("0-1", 0), ("new", 1)])
    run(spark, src, out)
    assert max(load_log(spark, out).collect(), key=lambda r: r["batch_id"])["buckets_read"] == 1
    assert len(loaded(spark, out)) == 401


@pytest.mark.parametrize("key", ["CAST(id AS STRING)", "id", "CAST(id AS DECIMAL(20,2))"])
def test_filters_know_their_keys(spark, key):
    index = Index(4, 2)
    keys = index.placed(spark.range(2000).selectExpr(f"{key} AS k"), "k")
    cells = index.filters(keys).drop("bucket")
    all_set = F.forall("__at", _set)
    assert keys.join(cells, "cell").where(~all_set).count() == 0
    others = index.placed(spark.range(10_000, 14_000).selectExpr(f"{key} AS k"), "k")
    assert others.join(cells, "cell").where(all_set).count() < 40
