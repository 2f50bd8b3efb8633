"""Shards of a shuffled table by a two-pass external shuffle.

Pass one scatters the rows over buckets by a seeded hash; ranges of the hash are buckets, and
runs of buckets are the partitions of one shuffle.  Pass two takes a bucket at a time, puts its
rows in the order of their hashes, Fisher-Yates shuffles them by a seed of the bucket's own and
writes them.  Buckets end to end are the shuffled table; shards are equal runs of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_names, shared_folder, stored


@dataclass(frozen=True)
class Shuffle:
    """Parameters; the defaults are those of the registered query."""

    seed: int = 42
    #: Bytes of a bucket, roughly: what a task holds at a time.
    bucket_bytes: int = 16 << 20
    #: Buckets that a task of pass two works off, where there are many.
    run: int = 16
    #: Hash ranges in which pass one looks for rows that are too many for one bucket.
    cells: int = 1 << 24


#: The hash without its sign, and the bits of it that choose cell and bucket.
_BITS, _TOP = 63, 31


def record_size(text: Column) -> Column:
    """UTF-8 bytes of a text, none for a null, and 16 for the rest of the record."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def _hash(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - _BITS)


def _range(hash_: Column, ranges: int) -> Column:
    """Which of equal ranges of the hash; never falls as the hash grows."""
    top = F.shiftright(hash_, _BITS - _TOP)
    return F.shiftright(top * F.lit(ranges).cast("long"), _TOP)


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A shuffled order of ``n`` rows."""
    order = list(range(n))
    draw = np.random.Generator(np.random.PCG64([seed, bucket]))
    steps = draw.integers(0, np.arange(n, 0, -1)) if n else []
    for i, step in enumerate(steps):
        order[i], order[i + step] = order[i + step], order[i]
    return np.array(order, np.int64)


def write_shuffled(
    docs: DataFrame,
    path: str,
    how: Shuffle = Shuffle(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[str, str]:
    """Write the shuffled table; return the names of its two added columns.

    These are the partition of pass two that a row came from and its place there; partitions in
    ascending order, end to end, are the shuffled order.  ``docs`` has to be a stored table: one
    row repeated so often that its copies would overflow a bucket is scattered by the places of
    the copies in its files, which are the same when a lost task runs again.
    """
    spark = docs.sparkSession
    hash_, cell, bucket, part, at = free_names(docs, "hash", "cell", "bucket", "part", "at")
    keyed = docs.withColumn(hash_, _hash(F.lit(how.seed), F.col(id_col), F.col(text_col)))
    cells = stored(
        keyed.groupBy(_range(F.col(hash_), how.cells).alias(cell)).agg(
            F.sum(record_size(F.col(text_col))).alias("bytes"), F.count(F.lit(1)).alias("rows")
        ),
        "shuffle-cells",
    )
    # Cells too large for a bucket: not more than half as many as buckets, 8 bytes each.
    hot = cells.where((F.col("bytes") > 2 * how.bucket_bytes) & (F.col("rows") > 1)).select(cell)
    total, n_hot = cells.agg(F.sum("bytes")).first()[0] or 0, hot.count()
    if n_hot:
        here, too_many = _range(F.col(hash_), how.cells), F.broadcast(hot)
        salted = _hash(F.lit(how.seed), F.col(hash_), F.monotonically_increasing_id())
        keyed = (
            keyed.join(too_many, here == F.col(cell), "left")
            .withColumn(hash_, F.when(F.col(cell).isNull(), F.col(hash_)).otherwise(salted))
            .drop(cell)
        )
    buckets = max(1, math.ceil(total / how.bucket_bytes))
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(buckets, max(shuffles, math.ceil(buckets / how.run)))
    scattered = (
        keyed.withColumn(bucket, _range(F.col(hash_), buckets))
        .withColumn(part, F.floor(F.col(bucket) * parts / buckets).cast("int"))
        .repartitionById(parts, F.col(part))
        .sortWithinPartitions(hash_, id_col, text_col)
        .drop(hash_)
    )
    schema = docs.withColumn(part, F.lit(0)).withColumn(at, F.lit(0).cast("long")).schema

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come bucket by bucket; one bucket is held at a time."""
        held: list[pa.RecordBatch] = []
        own, place = None, 0

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal held, place
            rows = pa.Table.from_batches(held).drop_columns([bucket])
            rows = rows.take(fisher_yates(len(rows), how.seed, own))
            rows = rows.append_column(at, pa.array(np.arange(place, place + len(rows)), pa.int64()))
            held, place = [], place + len(rows)
            yield from rows.to_batches(max_chunksize=4096)

        for batch in batches:
            which = batch.column(bucket).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(which)]
            for start, stop in zip(cuts, cuts[1:]):
                if stop > start and held and which[start] != own:
                    yield from finished()
                if stop > start:
                    own = int(which[start])
                    held.append(batch.slice(start, stop - start))
        if held:
            yield from finished()

    scattered.select(*[f"`{c}`" for c in docs.columns], part, bucket).mapInArrow(
        shuffle, schema
    ).write.parquet(path)
    return part, at


def read_shards(
    spark: SparkSession, path: str, columns: tuple[str, str], schema, shards: int
) -> DataFrame:
    """The shuffled table with each row's shard and its ``slot``, its place in the shard.

    The rows are cut into ``shards`` runs whose lengths differ by one at most.  What is shifted
    and broadcast is one number for each task that wrote.
    """
    part, at = columns
    table = spark.read.schema(schema).parquet(path)
    shard, slot, before, rows = free_names(table, "shard", "slot", "before", "rows")
    sizes = table.groupBy(part).agg(F.count(F.lit(1)).alias(rows))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    shift = sizes.select(
        part,
        F.coalesce(F.sum(rows).over(earlier), F.lit(0)).alias(before),
        F.sum(rows).over(all_rows).alias(rows),
    )
    place = f"(`{at}` + `{before}`)"
    return (
        table.join(F.broadcast(shift), part)
        .withColumn(shard, F.expr(f"CAST({place} * {shards} DIV `{rows}` AS INT)"))
        .withColumn(slot, F.expr(f"{place} - (`{shard}` * `{rows}` + {shards - 1}) DIV {shards}"))
        .drop(part, at, before, rows)
    )


def sharded(
    docs: DataFrame,
    shards: int = 40,
    how: Shuffle = Shuffle(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the shuffled table to a fresh shared folder; return its rows by shard.

    All columns of ``docs`` stay, ``shard`` and ``slot`` come after them, with underscores before
    the names where ``docs`` has these.  Counts of shards differ by one at most, so with fewer
    rows than shards some are empty.  Null ids and texts are values like others; repeated rows
    stay, each with a slot of its own; texts of any length are one row; an empty table gives
    none.  The order depends on ids, texts and the seed alone, but for copies of a row that
    would overflow a bucket.  ``docs`` has to be a stored table.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "shards")
    part, at = write_shuffled(docs, path, how, id_col=id_col, text_col=text_col)
    schema = docs.withColumn(part, F.lit(0)).withColumn(at, F.lit(0).cast("long")).schema
    return read_shards(spark, path, (part, at), schema, shards)
