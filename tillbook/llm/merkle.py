"""A Merkle manifest of a dataset and its proofs by Octopus multiproofs.

H is the lowercase hex SHA-256 of its inputs end to end, digests as hex text.  A document is a
leaf.  The leaves of a group, in ascending order of the id, make a tree: every eight consecutive
nodes become their H (the last run may have fewer, even one) until one node is left, the group's
subroot.  The subroots, null group first, make a tree of the same kind, whose top is the root.

A node is known by its tree, its level (0 for leaves) and its place there.  Trees are numbered in
the order of their groups; the tree of subroots is number -1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, with_running

ARITY = 8
#: Levels that one group of nodes climbs at a time: a group is 4096 nodes at most.
DEPTH = 4
SPAN = ARITY**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROOTS = -1


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """H of the fields: ``-`` for a null, else its length in UTF-8 bytes, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(
        F.concat(
            *[
                F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                for t in texts
            ]
        ),
        256,
    )


@dataclass(frozen=True)
class Manifest:
    """Tables of a manifest, all stored.

    ``leaves(id, tree, at, digest, ...)``; ``nodes(tree, level, at, digest)`` above the leaves;
    ``trees(group, tree, n, subroot, n_trees, root)``, one row a group.
    """

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    extra: tuple[str, ...] = ()


def manifest(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    extra: dict[str, Column] | None = None,
) -> Manifest:
    """The trees of a table; texts are read once and never shuffled.

    ``extra`` adds columns to the leaves, by expressions over ``docs``.  Null ids come first;
    rows of the same id follow their digests, and rows equal in all fields are leaves of their
    own, alike.  Texts of any length count whole.  An empty table has no trees.  Columns that
    are neither named nor fields are not read.
    """
    extra = extra or {}
    found = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(group_col).alias("group"),
            leaf_digest([F.col(f"`{c}`") for c in fields]).alias("digest"),
            *[value.alias(f"extra_{name}") for name, value in extra.items()],
        ),
        "merkle-leaves",
    )
    groups = found.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    groups = stored(
        with_running(groups, [F.col("group")], "n", "tree", "start", "merkle-groups"), "merkle-trees"
    )
    ranked = with_running(
        found.withColumn("one", F.lit(1).cast("long")),
        [F.col("group"), F.col("id"), F.col("digest")],
        "one", "rank", "before", "merkle-order",
    )
    named = groups.withColumnRenamed("group", "own")
    leaves = stored(
        ranked.join(named, F.col("group").eqNullSafe(F.col("own"))).select(
            "id", "tree", (F.col("rank") - F.col("start")).alias("at"), "digest", "n",
            *[f"extra_{name}" for name in extra],
        ),
        "merkle-places",
    )

    most, n_trees = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    inner = _raised(leaves.select("tree", "at", "digest", "n"), most or 0)
    tops = leaves.select("tree", "digest", "n").unionByName(inner.select("tree", "digest", "n"))
    subroots = stored(tops.where("n = 1").select("tree", "digest"), "merkle-subroots")
    upper = _raised(
        subroots.select(
            F.lit(ROOTS).cast("long").alias("tree"), F.col("tree").alias("at"), "digest",
            F.lit(n_trees).cast("long").alias("n"),
        ),
        n_trees,
    )
    top = subroots.select("digest") if n_trees == 1 else upper.where("n = 1").select("digest")
    trees = groups.join(subroots.withColumnRenamed("digest", "subroot"), "tree").select(
        "group", "tree", "n", "subroot", F.lit(n_trees).cast("long").alias("n_trees")
    )
    root = top.first()
    trees = stored(trees.withColumn("root", F.lit(root[0] if root else None).cast("string")), "merkle-roots")
    return Manifest(
        leaves.withColumnsRenamed({f"extra_{name}": name for name in extra}),
        inner.unionByName(upper).drop("n"),
        trees,
        tuple(extra),
    )


def _raised(nodes: DataFrame, most: int) -> DataFrame:
    """All nodes above ``nodes(tree, at, digest, n)``, ``n`` being the nodes of that level.

    Each round climbs ``DEPTH`` levels within groups of ``SPAN`` nodes of one tree, so a tree of
    any size is spread over groups; ``most`` is the size of the largest tree.
    """

    def climb(group: pa.Table) -> pa.Table:
        at = group["at"].to_numpy()
        order = np.argsort(at)
        level, tree, n = (group[c][0].as_py() for c in ("level", "tree", "n"))
        first = int(at[order[0]])
        here = group["digest"].take(order).to_pylist()
        out: list[tuple[int, int, int, str, int]] = []
        for _ in range(DEPTH):
            if n <= 1:
                break
            here = [digest(*here[i : i + ARITY]) for i in range(0, len(here), ARITY)]
            first, n, level = first // ARITY, -(-n // ARITY), level + 1
            out += [(tree, level, first + k, h, n) for k, h in enumerate(here)]
        columns = list(zip(*out)) or [()] * len(_NODE)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _NODE)], schema=_NODE)

    below = nodes.withColumn("level", F.lit(0).cast("long"))
    found = None
    height = 0
    while found is None or most > 1:
        blocks = below.groupBy("tree", F.floor(F.col("at") / SPAN))
        raised = stored(blocks.applyInArrow(climb, _NODE_DDL), "merkle-nodes")
        found = raised if found is None else found.unionByName(raised)
        most, height = -(-most // SPAN), height + DEPTH
        below = raised.where((F.col("level") == height) & (F.col("n") > 1))
    return found


_NODE = pa.schema([("tree", "int64"), ("level", "int64"), ("at", "int64"), ("digest", "string"), ("n", "int64")])
_NODE_DDL = "tree bigint, level bigint, at bigint, digest string, n bigint"


def missing(at: np.ndarray, n: int) -> list[np.ndarray]:
    """Per level the fewest nodes that, with the leaves at ``at``, give all nodes above them.

    These are the other nodes of the runs on the way up that are not on it themselves.
    """
    out = []
    at = np.unique(at)
    while n > 1:
        above = np.unique(at // ARITY)
        run = (above[:, None] * ARITY + np.arange(ARITY)).ravel()
        out.append(np.setdiff1d(run[run < n], at, assume_unique=True))
        at, n = above, -(-n // ARITY)
    return out


def sides(
    own: dict[int, str], fetched: list[dict[int, str]], n: int
) -> tuple[list[dict[int, tuple[str, str]]], str]:
    """Per level what stands left and right of each own node in its run, and the top.

    Nodes above the own ones are derived on the way, each once.
    """
    out: list[dict[int, tuple[str, str]]] = []
    level = 0
    while n > 1:
        known = own | fetched[level]
        around, above = {}, {}
        for run in {at // ARITY for at in own}:
            stop = min(n, (run + 1) * ARITY)
            digests = [known[at] for at in range(run * ARITY, stop)]
            above[run] = digest(*digests)
            for k in range(len(digests)):
                if run * ARITY + k in own:
                    around[run * ARITY + k] = "".join(digests[:k]), "".join(digests[k + 1 :])
        out.append(around)
        own, n, level = above, -(-n // ARITY), level + 1
    return out, own[0]


def proofs(made: Manifest, chosen: DataFrame | None = None) -> DataFrame:
    """``(id, tree, leaf, proof, subroot, root, ...)`` for the chosen rows of ``made.leaves``.

    A proof lists, from the leaf to the root, what stands ``left`` and ``right`` of the node in
    its run; ``folded`` computes the root from it.  The chosen leaves of a block of ``SPAN``
    places are one partition: it names the nodes that it lacks, each once, fetches them in one
    join, derives the nodes that its leaves share and writes out a proof each.  All leaves are
    chosen unless told otherwise; none give none.
    """
    leaves = made.leaves if chosen is None else chosen
    blocked = (
        leaves.join(made.trees.select(F.col("tree").alias("own"), "n_trees"), F.col("tree") == F.col("own"))
        .drop("own")
        .withColumn("block", F.floor(F.col("at") / SPAN))
    )
    asked = stored(
        blocked.select("tree", "block", "at", "n", "n_trees")
        .groupBy("tree", "block")
        .applyInArrow(_wanted, "tree bigint, block bigint, of bigint, level bigint, at bigint"),
        "merkle-wanted",
    )
    # Where whole blocks are chosen no leaf is asked for, and the leaves are not read again.
    lowest = asked.where(F.col("of") != ROOTS).agg(F.min("level")).first()[0]
    nodes = made.nodes
    if lowest == 0:
        level = F.lit(0).cast("long").alias("level")
        nodes = nodes.unionByName(made.leaves.select("tree", level, "at", "digest"))
    level0 = made.trees.select(
        F.lit(ROOTS).cast("long").alias("tree"), F.lit(0).cast("long").alias("level"),
        F.col("tree").alias("at"), F.col("subroot").alias("digest"),
    )
    nodes = nodes.unionByName(level0).withColumnRenamed("tree", "of")
    got = asked.join(nodes, ["of", "level", "at"])

    id_type = leaves.schema["id"].dataType.simpleString()
    extra = [leaves.schema[c] for c in made.extra]
    ddl = "".join(f", x{i} {f.dataType.simpleString()}" for i, f in enumerate(extra))
    out = (
        blocked.select("id", "tree", "block", "at", "digest", "n", "n_trees",
                       *[F.col(f.name).alias(f"x{i}") for i, f in enumerate(extra)])
        .groupBy("tree", "block")
        .cogroup(got.groupBy("tree", "block"))
        .applyInArrow(_expanded, f"id {id_type}, tree bigint, leaf string, "
                                 f"proof array<struct<left:string,right:string>>{ddl}")
    )
    tops = made.trees.select(F.col("tree").alias("own"), "subroot", "root")
    return (
        out.join(tops, F.col("tree") == F.col("own"))
        .drop("own")
        .withColumnsRenamed({f"x{i}": f.name for i, f in enumerate(extra)})
    )


def _wanted(block: pa.Table) -> pa.Table:
    tree, at_block, n, n_trees = (block[c][0].as_py() for c in ("tree", "block", "n", "n_trees"))
    rows = [
        (tree, at_block, of, level, int(at))
        for of, need in (
            (tree, missing(block["at"].to_numpy(), n)),
            (ROOTS, missing(np.array([tree]), n_trees)),
        )
        for level, places in enumerate(need)
        for at in places
    ]
    names = ("tree", "block", "of", "level", "at")
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(names, columns)})


_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


def _expanded(block: pa.Table, fetched: pa.Table) -> pa.Table:
    leaf, at = block["digest"].to_pylist(), block["at"].to_pylist()
    if not leaf:
        tree = n = n_trees = 0
    else:
        tree, n, n_trees = (block[c][0].as_py() for c in ("tree", "n", "n_trees"))
    known: dict[int, list[dict[int, str]]] = {}
    for of, size in ((tree, n), (ROOTS, n_trees)):
        known[of] = [{} for _ in range(64)]
    for of, level, place, value in zip(*(fetched[c].to_pylist() for c in ("of", "level", "at", "digest"))):
        known[of][level][place] = value
    steps: list[tuple[str, str]] = []
    length = 0
    if leaf:
        below, subroot = sides(dict(zip(at, leaf)), known[tree], n)
        above, _ = sides({tree: subroot}, known[ROOTS], n_trees)
        shared = [around[tree // ARITY**level] for level, around in enumerate(above)]
        for place in at:
            steps += [around[place // ARITY**level] for level, around in enumerate(below)]
            steps += shared
        length = len(below) + len(above)
    listed = pa.ListArray.from_arrays(
        pa.array(np.arange(len(leaf) + 1) * length, pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array([s[k] for s in steps], pa.string()) for k in (0, 1)], fields=list(_STEP)
        ),
    )
    others = [c for c in block.column_names if c.startswith("x")]
    return pa.table(
        [block["id"], block["tree"], block["digest"], listed, *[block[c] for c in others]],
        names=["id", "tree", "leaf", "proof", *others],
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and a proof lead to, by nothing else."""
    return F.aggregate(
        proof, leaf, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256)
    )


def siblings_digest(proof: Column) -> Column:
    """H of all siblings of a proof, from the leaf's level up, each level from left to right."""
    around = F.transform(proof, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(around, ""), 256)
