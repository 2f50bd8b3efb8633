"""The external shuffle against a plain version, and its law."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillbook.llm import queries, sharding
from tillbook.llm.sharding import Shuffle


def plain_shuffle(rows, buckets, seed=42):
    """(hash, id, text) rows in shuffled order: by bucket, then Fisher-Yates."""
    held = defaultdict(list)
    for row in sorted(rows, key=lambda r: r[0]):
        held[(row[0] >> 32) * buckets >> 31].append(row)
    out = []
    for bucket in sorted(held):
        some = held[bucket]
        draw = np.random.Generator(np.random.PCG64([seed, bucket]))
        steps = draw.integers(0, np.arange(len(some), 0, -1))
        for i, step in enumerate(steps):
            some[i], some[i + step] = some[i + step], some[i]
        out += some
    return out


def hashed(docs, seed=42):
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 1)
    return [tuple(r) for r in docs.select(h, "doc_id", "text").collect()]


def cut(rows, shards):
    n = len(rows)
    edges = [-(-s * n // shards) for s in range(shards + 1)]
    return {
        (s, slot): rows[edges[s] + slot] for s in range(shards) for slot in range(edges[s + 1] - edges[s])
    }


def held_law(rows, n, shards=40):
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["slot"])
    counts = [len(places[s]) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1 and set(places) <= set(range(shards))
    for slots in places.values():
        assert sorted(slots) == list(range(len(slots)))


def test_query_equals_the_plain_shuffle(spark, sf_dir, docs, texts):
    rows = queries.QUERIES["op13_external_shuffle"](spark, sf_dir).collect()
    size = sum(len((t or "").encode()) + 16 for t in texts.values())
    expected = cut(plain_shuffle(hashed(docs), -(-size // (16 << 20))), 40)
    assert {(r["shard"], r["slot"]): r["doc_id"] for r in rows} == {p: r[1] for p, r in expected.items()}
    for r in rows:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert r["law"] == "rows" and r["grown_shard"] is None
    held_law(rows, len(texts))


@pytest.mark.parametrize("bucket_bytes", [2_000, 30_000])
def test_many_buckets(spark, docs, bucket_bytes):
    stored = docs.withColumn("part", F.lit("x"))
    how = Shuffle(seed=7, bucket_bytes=bucket_bytes)
    rows = sharding.sharded(stored, 7, how).collect()
    size = docs.agg(F.sum(sharding.record_size(F.col("text")))).first()[0]
    if bucket_bytes > 20_000:  # no cell is too large for its bucket
        expected = cut(plain_shuffle(hashed(docs, 7), -(-size // bucket_bytes), 7), 7)
        assert {(r["shard"], r["slot"]): r["text"] for r in rows} == {p: r[2] for p, r in expected.items()}
    held_law(rows, docs.count(), 7)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())
    assert {r["part"] for r in rows} == {"x"}


def test_a_row_repeated_beyond_a_bucket(spark, tmp_path):
    path = str(tmp_path / "docs")
    same = spark.range(6000).selectExpr("1L AS doc_id", "'the same text' AS text")
    other = spark.range(3000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    same.union(other).repartition(5).write.parquet(path)
    docs = spark.read.parquet(path)
    how = Shuffle(bucket_bytes=8_000)
    folder = str(tmp_path / "out")
    part, at = sharding.write_shuffled(docs, folder, how)
    sizes = spark.read.parquet(folder).groupBy(part).count().collect()
    assert sum(r["count"] for r in sizes) == 9000
    assert max(r["count"] for r in sizes) < 2500  # no task has the 6000 copies
    rows = sharding.sharded(docs, 40, how).collect()
    held_law(rows, 9000)
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(map(tuple, docs.collect()))
    again = sharding.sharded(docs, 40, how)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, rows))


def test_odd_rows(odd, nothing):
    rows = sharding.sharded(odd, 3).collect()
    held_law(rows, 12, 3)
    assert Counter(tuple(r)[:-2] for r in rows) == Counter(map(tuple, odd.collect()))
    assert sharding.sharded(odd).count() == 12
    assert sharding.sharded(nothing).collect() == []


def test_clashing_columns(spark):
    names = ("shard", "slot", "part", "at", "bucket", "hash", "cell", "before", "rows")
    docs = spark.range(50).selectExpr("id AS doc_id", "'t' AS text", *[f"'x' AS `{n}`" for n in names])
    out = sharding.sharded(docs, 4)
    assert out.columns == ["doc_id", "text", *names, "_shard", "_slot"]
    assert all(r[n] == "x" for r in out.collect() for n in names)


def test_fisher_yates_is_fair():
    counts = Counter(tuple(sharding.fisher_yates(3, 1, b)) for b in range(6000))
    assert len(counts) == 6 and max(counts.values()) < 1150 and min(counts.values()) > 850
    assert sharding.fisher_yates(0, 1, 1).tolist() == []
