"""The Merkle manifest against a plain tree, and multiproofs of chosen leaves."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillbook.llm import merkle, queries


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return sha(*[field(row[c]) for c in merkle.FIELDS])


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return out


def plain_version(rows):
    """For every row its leaf, subroot, root, digest of siblings and folded root."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"] is not None, row["doc_id"], leaf_of(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels_of([m[2] for m in sorted(groups[g], key=lambda m: m[:3])]) for g in names]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for tree, name in enumerate(names):
        for at, (_, id_, leaf, row) in enumerate(sorted(groups[name], key=lambda m: m[:3])):
            own = leaf
            if id_ is not None and zlib.crc32(str(id_).encode()) % 3 == 0:
                own = leaf_of({**row, "text": lowered(row["text"])})
            siblings = ""
            for levels, place in ((trees[tree], at), (top, tree)):
                for nodes in levels[:-1]:
                    run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
                    left, right = "".join(run[: place % 8]), "".join(run[place % 8 + 1 :])
                    siblings, own, place = siblings + left + right, sha(left, own, right), place // 8
            root = top[-1][0]
            out.append((id_, leaf, trees[tree][-1][0], root, sha(siblings), own, own == root))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_the_plain_trees(spark, sf_dir, docs):
    found = result(queries.QUERIES["op12_merkle_manifest"](spark, sf_dir))
    assert found == plain_version([r.asDict() for r in docs.collect()])
    assert {r[-1] for r in found} == {True, False}


def proven(made):
    folded = merkle.folded(F.col("leaf"), F.col("proof"))
    return merkle.proofs(made).select(
        "id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof")), folded, folded == F.col("root")
    )


def untampered(rows):
    return sorted(((*r[:5], r[3], True) for r in plain_version(rows)), key=repr)


def test_odd_rows(odd, nothing):
    rows = [r.asDict() for r in odd.collect()]
    assert result(proven(merkle.manifest(odd))) == untampered(rows)
    empty = merkle.manifest(nothing)
    assert merkle.proofs(empty).collect() == [] and empty.trees.count() == 0


def test_clashing_extra_columns(spark):
    names = ("tree", "at", "n", "level", "block", "digest", "id", "group", "root", "own", "rank", "one")
    docs = spark.range(30).selectExpr(
        "id AS doc_id", "'s' AS source", "CAST(id % 3 AS STRING) AS lang", "id AS n_chars", "'T' AS text",
        *[f"'x' AS `{n}`" for n in names if n != "id"],
    )
    rows = [r.asDict() for r in docs.collect()]
    assert result(proven(merkle.manifest(docs))) == untampered(rows)


@pytest.mark.parametrize("sizes", [(1,), (8,), (9, 1), (64, 65, 1), (513, 70)])
def test_trees_of_any_size_over_small_blocks(spark, monkeypatch, sizes):
    # The functions of a task read DEPTH and SPAN where they are built, on the driver.
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "SPAN", 8)
    rows = [
        {"doc_id": i, "source": None, "lang": f"l{g}", "n_chars": i, "text": "Aé" * (i % 5)}
        for g, n in enumerate(sizes)
        for i in range(n)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert result(proven(merkle.manifest(docs))) == untampered(rows)


def test_more_trees_than_a_run(spark):
    rows = [
        {"doc_id": i, "source": "s", "lang": f"é{i % 70}", "n_chars": None, "text": None}
        for i in range(200)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert result(proven(merkle.manifest(docs))) == untampered(rows)


def test_missing_nodes_are_the_fewest():
    assert [m.tolist() for m in merkle.missing(np.arange(70), 70)] == [[], [], []]
    need = merkle.missing(np.array([0, 1, 9]), 70)
    assert need[0].tolist() == [2, 3, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15]
    assert need[1].tolist() == [2, 3, 4, 5, 6, 7]
    assert need[2].tolist() == [1]


def test_chosen_leaves(spark, docs):
    made = merkle.manifest(docs)
    chosen = made.leaves.where("id % 7 = 3")
    rows = merkle.proofs(made, chosen).withColumn("up", merkle.folded(F.col("leaf"), F.col("proof"))).collect()
    every = {r["id"]: r for r in merkle.proofs(made).collect()}
    assert len(rows) == chosen.count() > 0
    for r in rows:
        assert r["up"] == r["root"] and r["proof"] == every[r["id"]]["proof"]
    assert merkle.proofs(made, made.leaves.limit(0)).collect() == []
