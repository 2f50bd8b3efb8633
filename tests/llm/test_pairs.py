"""Near-duplicates, mixing and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillbook.llm import decontamination, mixing, near_dedup, queries
from tillbook.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_simhash(text):
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or (
        [" ".join(words)] if words else []
    )
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_simhash_query_equals_brute_force(spark, sf_dir, texts):
    rows = queries.QUERIES["op1_simhash_near_dedup"](spark, sf_dir).collect()
    prints = {i: plain_simhash(t) for i, t in sorted(texts.items())}
    groups = plain_components(prints)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        i: (f"{prints[i]:016x}", groups[i]) for i in texts
    }
    assert len(rows) == len(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB \n\té", max_size=30), max_size=6))
def test_simhash_of_any_text(some):
    for text in some:
        assert near_dedup.simhash(text.encode()) == plain_simhash(text)


def test_masks_catch_every_pair_within_the_radius():
    rng = random.Random(3)
    for radius in (0, 1, 2, 3):
        masks = near_dedup.block_masks(radius)
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(flips & mask == 0 for mask in masks)


@pytest.mark.parametrize("seed", range(4))
def test_forest_finds_all_links_of_each_bucket(seed, monkeypatch):
    monkeypatch.setattr(near_dedup, "PAIRS", 200)
    rng = random.Random(seed)
    bucket, prints = [], []
    for b in range(6):
        base = rng.getrandbits(64)
        some = {base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for _ in range(40)}
        prints += [x % (1 << 64) for x in some]
        bucket += [b] * len(some)
    found = near_dedup.Forest(np.array(bucket), np.array(prints, np.uint64)).linked(2)
    for b in set(bucket):
        own = {i: prints[i] for i in range(len(prints)) if bucket[i] == b}
        assert {i: found[i] for i in own} == plain_components(own)


def test_chains_and_stars_become_one_component(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    rows = components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert {r["node"]: r["root"] for r in rows} == {
        **{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}
    }
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_near_duplicates_of_odd_rows(odd, nothing):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == 12
    zero = {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert zero == {3}
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert near_dedup.near_duplicates(nothing).count() == 0
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([1, 3, 6, 7, None, 8, 9])
    assert near_dedup.drop_near_duplicates(nothing).count() == 0


def test_a_group_without_ids_keeps_one_row(spark):
    docs = spark.createDataFrame([(None, "a b c d")] * 3 + [(None, "x y z w v")], "doc_id long, text string")
    assert near_dedup.near_duplicates(docs).where("component_id is null").count() == 4
    assert near_dedup.drop_near_duplicates(docs).count() == 2


def plain_targets(sizes, repeats=3, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(repeats * sizes[n] for n in full)
        share = sum(weight[n] for n in names if n not in full)
        target = {n: repeats * sizes[n] if n in full else rest * weight[n] / share for n in names}
        more = {n for n in names if n not in full and target[n] > repeats * sizes[n]}
        if not more:
            return target
        full |= more


def test_mixing_query_meets_its_targets(spark, sf_dir, docs, texts):
    query = queries.QUERIES["op2_source_mixing"]
    rows = query(spark, sf_dir).collect()
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    target = plain_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]])
    block = mixing.Mix().block
    for name in sizes:
        assert abs(taken[name] - target[name]) <= 2 * block
    assert sorted(map(tuple, rows)) == sorted(map(tuple, query(spark, sf_dir).collect()))


def test_sources_that_run_dry_pass_their_share_on(spark):
    rows = [(i, "w " * 1000, "a") for i in range(1)] + [(10 + i, "w " * 1000, s) for i in range(30) for s in "bcd"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["source"]: r for r in mixing.mix_plan(docs).join(docs, "doc_id").groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    # Ids repeat over b, c and d, so that every document is joined three times over.
    target = plain_targets({"a": 1000, "b": 30000, "c": 30000, "d": 30000})
    assert target["a"] == 3000 and found["a"]["taken"] == pytest.approx(3000, abs=64)


@pytest.mark.parametrize("seed", range(3))
def test_apportionment_takes_the_highest_quotients(spark, seed):
    rng = random.Random(seed)
    parts = [(g, p, rng.choice([0.0, rng.random() * 100, 7.0]), rng.randrange(0, 60), 50 + 17 * g)
             for g in range(3) for p in range(9)]
    frame = spark.createDataFrame(parts, "`group` int, part long, share double, most long, seats long")
    found = {(r["group"], r["part"]): r["quota"] for r in mixing.apportioned(frame).collect()}
    assert found.keys() == {(g, p) for g, p, *_ in parts}
    for g in range(3):
        own = [x for x in parts if x[0] == g]
        free = [(g, p, share, 10**6, seats) for _, p, share, _, seats in own]
        best = sorted((-s / (2 * k + 1), p) for _, p, s, _, n in free if s for k in range(n))
        won = Counter(p for _, p in best[: own[0][4]])
        loose = mixing.apportioned(spark.createDataFrame(free, frame.schema))
        assert {r["part"]: r["quota"] for r in loose.collect()} == {p: won[p] for _, p, *_ in own}
        assert all(found[g, p] <= most for _, p, _, most, _ in own)


@pytest.mark.parametrize("group_shards", (1, 3, 1 << 12))
def test_shards_in_groups_share_all_seats(spark, group_shards):
    rng = random.Random(group_shards)
    rows = [(s, k, rng.randrange(20_000), 0, 700) for s in range(2) for k in range(40)]
    rows = [(s, k, ring, 3 * ring // 64, seats) for s, k, ring, _, seats in rows] + [(2, 0, 0, 0, 0)]
    rings = spark.createDataFrame(rows, "__src int, __shard long, __ring long, most long, seats long")
    got = mixing.shard_quotas(rings, mixing.Mix(group_shards=group_shards)).collect()
    quota = {(r["__src"], r["__shard"]): r["quota"] for r in got}
    assert quota.keys() == {r[:2] for r in rows} and len(got) == len(rows)
    for source in (0, 1):
        own = {r[1]: r for r in rows if r[0] == source}
        assert sum(quota[source, k] for k in own) == 700
        total = sum(r[2] for r in own.values())
        assert all(abs(quota[source, k] - 700 * r[2] / total) <= 2 for k, r in own.items())


def test_mixed_documents_hold_the_words_taken(spark, docs):
    mix = mixing.Mix(shard_docs=16)
    plan = {r["doc_id"]: r for r in mixing.mix_plan(docs, mix).collect()}
    out = mixing.mixed(docs, mix)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got, texts = Counter(), {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.collect():
        words = WORD.findall(r["text"])
        got[r["doc_id"]] += len(words)
        assert r["text"] in texts[r["doc_id"]]
        if len(words) < plan[r["doc_id"]]["size"]:
            assert r["n_chars"] == len(r["text"])
    assert got == Counter({i: r["taken"] for i, r in plan.items() if r["taken"]})


def test_mixing_odd_rows(odd, nothing):
    rows = mixing.mix_plan(odd).collect()
    assert len(rows) == 12
    assert all(r["size"] == 0 == r["taken"] for r in rows if r["doc_id"] in (3, 4, 5))
    assert mixing.mix_plan(nothing).count() == 0
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mixed(nothing).count() == 0
    blank = odd.where("doc_id in (3, 4, 5)")
    assert [r["target"] for r in mixing.mix_plan(blank).collect()] == [0.0] * 3


def plain_windows(items, width=13):
    out = defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        for k in range(max(1, len(words) - width + 1) if words else 0):
            out[tuple(words[k : k + width])].add(str(item))
    return out


def bench_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))


def plain_hits(text, known):
    words, hit, items = bench_words(text), set(), set()
    for n in {len(k) for k in known}:
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in known:
                hit |= set(range(k, k + n))
                items |= known[tuple(words[k : k + n])]
    return len(words), len(hit), items


def test_contamination_query_equals_brute_force(spark, sf_dir, texts):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    known = plain_windows([(r["item_id"], r["text"]) for r in bench])
    rows = queries.QUERIES["op3_benchmark_decontamination"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and any(r["contaminated"] for r in rows)
    for r in rows:
        n, hit, items = plain_hits(texts[r["doc_id"]], known)
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(items), digest)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


@pytest.mark.parametrize("part_windows", (200_000, 7))
def test_contamination_in_parts_with_offsets(spark, odd, part_windows):
    items = [(1, "Beta, GAMMA"), (1, "beta gamma"), (2, "gamma delta"), (3, None), (4, "?!"), (5, "中文")] + [
        (None, " ".join(f"word{i}" for i in range(k, k + 20))) for k in range(0, 40, 10)
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(odd, bench, part_windows=part_windows)
    known = plain_windows([("" if i is None else i, t) for i, t in items])
    rows = found.collect()
    assert len(rows) == 12
    texts = defaultdict(set)
    for r in odd.collect():
        texts[r["doc_id"]].add(r["text"])
    for r in rows:
        want = [plain_hits(t, known) for t in texts[r["doc_id"]]]
        assert (r["n_words"], r["n_hit"], set(r["items"])) in want
        for s in r["spans"]:
            inside = [t[s["start"] : s["stop"]] for t in texts[r["doc_id"]] if t]
            assert any(len(bench_words(t)) == s["past"] - s["first"] for t in inside)
    first = next(r for r in rows if r["doc_id"] == 1)
    assert [(s["start"], s["stop"]) for s in first["spans"]] == [(6, 22)]


def test_contamination_of_nothing_and_by_nothing(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert decontamination.contamination(nothing, bench).count() == 0
    clean = decontamination.contamination(odd, bench.limit(0))
    assert clean.where("contaminated or n_hit > 0").count() == 0 and clean.count() == 12
    left = decontamination.drop_contaminated(odd, bench)
    assert left.columns == odd.columns and left.count() == 11


def test_queries_with_sql_equal_it(spark, sf_dir):
    from compare import compare, connect

    for name, sql in queries.ORACLES.items():
        assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), sql) == []
