"""Batches of a stream folded into one table, so that readers stop combining them all.

``compact`` combines what is done into a new version of a table at ``place``, next to the target
of the stream, which may run on meanwhile.  The newest batch of every stream stays out, as it is
the one that may be written again.  A version is named by the batches it covers and becomes
current with its pointer, so rows and cover change together: a reader sees a batch in the version
or in its folder, never in both and never in neither, and a compaction that died leaves nothing.

Folders of covered batches are listed but not opened; removing them is the owner's to decide,
as readers that began earlier may still need them.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import current_version, read_version, write_version
from .loads import BATCH, STREAM, done_batches

Combine = Callable[[DataFrame], DataFrame]


def covered(spark: SparkSession, place: str) -> dict[str, int]:
    """The last batch of each stream that the compacted table holds."""
    version = current_version(spark, place)
    return {} if version is None else json.loads(version)


def compact(spark: SparkSession, path: str, place: str, combine: Combine) -> bool:
    """Fold all batches under ``path`` but each stream's newest into the table at ``place``.

    ``combine`` makes one frame of several of its own results, such as ``combined_daily``.  It
    reads the last version and the batches since, none twice.  False if there is nothing new.
    """
    batches = done_batches(spark, path)
    if batches is None:
        return False
    before = covered(spark, place)
    # One row a stream.
    newest = batches.groupBy(F.col(STREAM).cast("string").alias(STREAM)).agg(F.max(BATCH).alias(BATCH))
    until = before | {
        r[STREAM]: r[BATCH] - 1 for r in newest.collect() if r[BATCH] - 1 > before.get(r[STREAM], -1)
    }
    if until == before:
        return False
    rows = combine(_since(spark, batches.where(_within(until)), place, before))
    write_version(rows, place, json.dumps(until, sort_keys=True))
    return True


def compacted(spark: SparkSession, path: str, place: str, combine: Combine) -> DataFrame:
    """What ``combine`` makes of all batches: the compacted table and the batches since."""
    batches = done_batches(spark, path)
    if batches is None:
        raise ValueError(f"no batch is written under {path}")
    return combine(_since(spark, batches, place, covered(spark, place)))


def _within(until: dict[str, int]):
    found = F.lit(False)
    for stream, last in until.items():
        found = found | ((F.col(STREAM) == stream) & (F.col(BATCH) <= last))
    return found


def _since(spark: SparkSession, batches: DataFrame, place: str, known: dict[str, int]) -> DataFrame:
    later = batches.where(~_within(known)).drop(STREAM, BATCH)
    table = read_version(spark, place) if known else None
    return later if table is None else table.unionByName(later)
