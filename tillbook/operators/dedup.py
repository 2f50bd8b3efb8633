"""Deduplication by a caller-given total order.

One row per key is picked by a struct minimum or maximum instead of a window: the
aggregate combines before the shuffle, so a key (or the null key) holding a large share
of the rows never meets in one task, and the result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), keep: str = "first"
) -> DataFrame:
    """One row per key: the first (or last) by ``order``, then by the other columns.

    Null keys form one group.  Nulls sort before values.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    payload = [*order, *[c for c in df.columns if c not in order and c not in keys]]
    if not payload:
        return df.select(*keys).distinct()
    pick = F.min if keep == "first" else F.max
    picked = df.groupBy(*keys).agg(pick(F.struct(*payload)).alias("__row"))
    return picked.select(
        *[F.col(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    )


def dedup_if_present(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """``dedup`` when the key column exists, else the frame as it is."""
    return dedup(df, [key], order) if key in df.columns else df


def latest_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Key and its latest time; only the two columns are read."""
    return df.groupBy(key).agg(F.max(ts).alias(ts))


def union_distinct_rows(
    parts: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Union by column name, then one row per key."""
    return dedup(union_all(parts), keys, order)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; every part must have the same columns."""
    if not parts:
        raise ValueError("nothing to union")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
