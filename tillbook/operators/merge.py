"""Upsert and sync as joins.

Plain file tables refuse ``MERGE INTO``, so the merged table is a new frame that the
caller writes to a new location or version, never over the input being read.

Null keys never match, so rows without a key take a branch that does not shuffle, and a
null key holding many rows cannot become one task.  A duplicate source key fails the merge
through a guard branch that reads only the key column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import duplicate_guard


def merge_upsert(
    target: DataFrame | None,
    source: DataFrame,
    key: str,
    update: Sequence[str] | None = None,
    *,
    source_unique: bool = False,
    one_join: bool = False,
) -> DataFrame:
    """Update matched target rows, insert unmatched source rows, keep the rest.

    ``update`` names the columns a match overwrites (all non-key source columns if None);
    a null in the source overwrites too.  Target-only columns survive; inserted rows have
    null there.  Without a target the result is the source.  ``source_unique`` skips the
    duplicate check for a source that was just aggregated by key.  ``one_join`` plans either
    side once, in a full join, in which adaptive execution cannot split a hot target key.
    """
    if target is None:
        return source
    updated = [c for c in source.columns if c != key] if update is None else list(update)
    if one_join:
        keyed = _full(target, source, key, updated)
    else:
        keyed = _overwritten(target, source, key, updated, keep_unmatched=True).unionByName(
            _unmatched(target, source, key), allowMissingColumns=True
        )
    merged = keyed.unionByName(target.where(F.col(key).isNull())).unionByName(
        source.where(F.col(key).isNull()), allowMissingColumns=True
    )
    return merged if source_unique else merged.unionByName(duplicate_guard(source, key, target))


def _full(target: DataFrame, source: DataFrame, key: str, updated: Sequence[str]) -> DataFrame:
    """Keyed rows of both sides from one full join: each side is planned and shuffled once."""
    _require_columns(target, source)
    incoming = source.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in source.columns if c != key]
    )
    known = target.where(F.col(key).isNotNull()).withColumn("__known", F.lit(True))
    joined = known.join(incoming, F.col(key) == F.col("__key"), "full")
    matched, fresh = F.col("__key").isNotNull(), F.col("__known").isNull()

    def value(column: str) -> Column:
        if column == key:
            return F.coalesce(key, "__key")
        if column not in source.columns:
            return F.col(column)
        # The match decides, not the value: a null in the source overwrites.
        taken = matched if column in updated else fresh
        return F.when(taken, F.col(f"__new_{column}")).otherwise(F.col(column))

    return joined.select(*[value(c).alias(c) for c in target.columns])


def merge_sync(
    target: DataFrame | None,
    source: DataFrame,
    key: str,
    *,
    source_unique: bool = False,
    target_unique: bool = False,
    one_join: bool = False,
) -> DataFrame:
    """Upsert every column, then delete the rows whose key the source lacks.

    The delete also takes rows without a key, freshly inserted ones included.
    ``target_unique`` says that a key is one target row: the merge is then a single join with
    the source planned once, and a duplicate target key fails it.  Without it a matched key
    keeps all of its target rows, and adaptive execution can split a hot one.  ``one_join``
    keeps them too in a single join, in which a hot target key is not split.
    """
    if target is None:
        return source
    if target_unique or one_join:
        _require_columns(target, source)
        merged = _joined_once(target, source, key, target_unique)
        if target_unique:
            merged = merged.unionByName(duplicate_guard(target, key, target))
        return merged if source_unique else merged.unionByName(duplicate_guard(source, key, target))
    updated = [c for c in source.columns if c != key]
    merged = _overwritten(target, source, key, updated, keep_unmatched=False).unionByName(
        _unmatched(target, source, key), allowMissingColumns=True
    )
    return merged if source_unique else merged.unionByName(duplicate_guard(source, key, target))


def _joined_once(
    target: DataFrame, source: DataFrame, key: str, target_unique: bool
) -> DataFrame:
    """Keyed source rows, once for each target row, with what only the target knows of them."""
    own = [c for c in target.columns if c not in source.columns]
    keyed = source.where(F.col(key).isNotNull())
    if target_unique and not own:
        return keyed.select(*target.columns)
    known = target.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), *own)
    return keyed.join(known, F.col(key) == F.col("__key"), "left").select(*target.columns)


def _require_columns(target: DataFrame, source: DataFrame) -> None:
    missing = [c for c in source.columns if c not in target.columns]
    if missing:
        raise ValueError(f"target lacks source columns {missing}")


def _overwritten(
    target: DataFrame, source: DataFrame, key: str, updated: Sequence[str], keep_unmatched: bool
) -> DataFrame:
    """Keyed target rows, with the updated columns of their source match."""
    _require_columns(target, source)
    incoming = source.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in updated]
    )
    joined = target.where(F.col(key).isNotNull()).join(
        incoming, F.col(key) == F.col("__key"), "left" if keep_unmatched else "inner"
    )
    # The match decides, not the value: a null in the source overwrites.
    matched = F.col("__key").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in updated
            else F.col(c)
            for c in target.columns
        ]
    )


def _unmatched(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keyed source rows the target lacks."""
    loaded = target.where(F.col(key).isNotNull()).select(key).distinct()
    return source.where(F.col(key).isNotNull()).join(loaded, key, "left_anti")
