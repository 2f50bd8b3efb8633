"""SimHash near-duplicates, linked with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, stored
from .components import components

SEED = 42
#: Rows of one pass over trees, and pairs of one step of a search: bounds of task memory.
ROWS = 1 << 18
PAIRS = 1 << 21


def simhash(data: bytes | None, width: int = 3) -> int:
    """Fingerprint of a UTF-8 text: the majority of its shingles' XXH64 bits; 0 without words."""
    words = data.lower().split() if data else []
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    count = max(1, len(words) - width + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """SimHash of a text column as a signed 64-bit integer; a null text is an empty one."""

    @F.arrow_udf("bigint")
    def hashed(texts: pa.Array) -> pa.Array:
        data = texts.cast(pa.binary())
        values = np.fromiter((simhash(v.as_py(), width) for v in data), np.uint64, len(data))
        return pa.array(values.view(np.int64))

    return hashed(text)


def block_masks(radius: int) -> list[int]:
    """Masks over four of ``radius + 4`` bit blocks.

    Two fingerprints within the radius differ in at most ``radius`` blocks, so they agree on
    at least one mask.  A mask fixes about ``256 / (radius + 4)`` bits: 42 for a radius of 2, so
    a bucket holds at most 2**22 different fingerprints, whatever the data are.
    """
    n = radius + 4
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    return [reduce(int.__or__, four) for four in combinations(blocks, 4)]


class Forest:
    """One BK-tree per bucket, grown level by level for all buckets of a batch at once.

    A child is keyed by its integer Hamming distance to its parent.  ``levels[i]`` holds the
    edges out of depth ``i`` as sorted codes ``parent * 65 + distance`` with their children.
    ``bucket`` is non-decreasing and fingerprints within a bucket differ.
    """

    def __init__(self, bucket: np.ndarray, fp: np.ndarray) -> None:
        self.fp = fp
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(fp) else np.array([], int)
        self.root = np.repeat(first, np.diff(np.r_[first, len(fp)]))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        items = np.flatnonzero(self.root != np.arange(len(fp)))
        node = self.root[items]
        while len(items):
            codes, lead, member = np.unique(
                node * 65 + self._distance(items, node), return_index=True, return_inverse=True
            )
            children = items[lead]
            self.levels.append((codes, children))
            node = children[member]
            below = node != items
            items, node = items[below], node[below]

    def _distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.fp[a] ^ self.fp[b]).astype(np.int64)

    def linked(self, radius: int) -> np.ndarray:
        """For every item the least item of its bucket that links lead to."""
        parent = np.arange(len(self.fp))
        alone = np.r_[np.diff(self.root) != 0, True] & np.r_[True, np.diff(self.root) != 0]
        items = np.flatnonzero(~alone)
        upto = np.cumsum(np.bincount(self.root)[self.root[items]])
        start = done = 0
        while start < len(items):
            stop = max(start + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
            self._search(items[start:stop], radius, parent)
            start, done = stop, int(upto[stop - 1])
        return _roots(parent, np.arange(len(parent)))

    def _search(self, query: np.ndarray, radius: int, parent: np.ndarray) -> None:
        node = self.root[query]
        for codes, children in [*self.levels, (np.array([], np.int64), np.array([], np.int64))]:
            far = self._distance(query, node)
            near = far <= radius
            _unite(parent, query[near], node[near])
            # Only edges within the radius of the query's own distance can lead to a match.
            low = np.searchsorted(codes, node * 65 + np.maximum(far - radius, 0), "left")
            high = np.searchsorted(codes, node * 65 + np.minimum(far + radius, 64), "right")
            count = high - low
            if not count.sum():
                return
            at = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            query, node = np.repeat(query, count), children[at]


def _roots(parent: np.ndarray, items: np.ndarray) -> np.ndarray:
    root = parent[items]
    while True:
        above = parent[root]
        if np.array_equal(above, root):
            parent[items] = root
            return root
        root = above


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        a, b = _roots(parent, a), _roots(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _bucket_links(radius: int):
    def links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket; whole buckets are worked off as soon as enough came."""
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size >= ROWS:
                rows = pd.concat(held)
                last = (rows["t"] == rows["t"].iat[-1]) & (rows["key"] == rows["key"].iat[-1])
                held, size = [rows[last]], int(last.sum())
                yield stars(rows[~last])
        if size:
            yield stars(pd.concat(held))

    def stars(rows: pd.DataFrame) -> pd.DataFrame:
        t, key, fp = (rows[c].to_numpy() for c in ("t", "key", "fp"))
        new = np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])][: len(t)]
        shared = ~(new & np.r_[new[1:], True][: len(t)])
        fp, bucket = fp[shared], np.cumsum(new)[shared]
        root = Forest(bucket, fp.view(np.uint64)).linked(radius)
        apart = root != np.arange(len(fp))
        return pd.DataFrame({"u": fp[apart], "v": fp[root[apart]]})

    return links


def linked_fingerprints(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """``(node, root)`` for every fingerprint with another one within ``radius`` bits.

    ``fingerprints`` has one column ``fp`` without repeats.  Each is dealt to the buckets of
    the block masks; a bucket is a shard with a BK-tree of its own, which its members search.
    Within a bucket links shrink to one star per connected group, so that a large group
    returns as many rows as it has members, never its pairs.
    """
    keys = F.array(
        *[
            F.struct(
                F.lit(t).cast("byte").alias("t"),
                F.col("fp").bitwiseAND(F.lit(mask - (mask >> 63 << 64)).cast("long")).alias("key"),
            )
            for t, mask in enumerate(block_masks(radius))
        ]
    )
    dealt = fingerprints.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp")
    sharded = dealt.repartition("t", "key").sortWithinPartitions("t", "key", "fp")
    return components(sharded.mapInPandas(_bucket_links(radius), "u bigint, v bigint"))


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    radius: int = 2,
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    The component is the least id reachable over links of at most ``radius`` bits.  A null or
    blank text has fingerprint zero and is linked like any other.  Repeated rows stay.  A null
    id is never a component's id, unless the component has no other.  An empty table gives
    none; columns other than the two named are not read.
    """
    prints = stored(
        docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), width).alias("fp")),
        "fingerprints",
    )
    # Stored, so that either side of the join is a plain shuffle: a fingerprint of many copies
    # is then one that adaptive execution can split.
    parts = stored(fingerprint_components(prints, radius), "fingerprint-components")
    return prints.join(parts, "fp", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def fingerprint_components(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``(fp, component_id, root)`` for the fingerprints of ``prints(id, fp)``.

    The root is a fingerprint of the component: components of the same least id, as where an
    id repeats, differ in it.
    """
    each = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = stored(linked_fingerprints(each.select("fp"), radius), "fingerprint-roots")
    member = roots.join(each, roots["node"] == each["fp"]).select("node", "root", "least")
    group = member.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = roots.join(group, "root").select(F.col("node").alias("fp"), "component_id", "root")
    return each.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("component_id", "least").alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    radius: int = 2,
) -> DataFrame:
    """Keep one document of each group, the one of the least id, with all its columns.

    Rows of the same id are told apart by a hash of the whole row, the least one staying; of
    rows equal in every column one stays.  Groups without any id keep one row likewise.  Null
    and blank texts are one group; an empty table gives an empty one; texts count whole; no
    column's name matters but the two given.
    """
    names = [f"`{c}`" for c in docs.columns]
    row, won, own_id, copies = free_names(docs, "row", "won", "own_id", "copies")
    keyed = docs.withColumn(row, F.xxhash64(*names))
    prints = stored(
        keyed.select(
            F.col(id_col).alias("id"),
            F.col(row).alias("row"),
            fingerprint(F.col(text_col), width).alias("fp"),
        ),
        "fingerprints",
    )
    parts = stored(fingerprint_components(prints.select("id", "fp"), radius), "fingerprint-components")
    rows = prints.groupBy("fp", "id", "row").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "n"))
    winner = rows.join(parts, "fp").groupBy("root").agg(best.alias("best"))
    winner = stored(
        winner.select(
            F.col("best.id").alias(own_id), F.col("best.row").alias(won), F.col("best.n").alias(copies)
        ),
        "kept-rows",
    )
    kept = keyed.join(
        winner, (F.col(row) == F.col(won)) & F.col(id_col).eqNullSafe(F.col(own_id))
    )
    once = kept.where(F.col(copies) == 1)
    repeated = kept.where(F.col(copies) > 1).dropDuplicates([own_id, row])
    return once.unionByName(repeated).select(*names)
