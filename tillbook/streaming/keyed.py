"""Streams that load each key once, at a cost that does not grow with what is loaded.

Loaded keys are kept in hash buckets.  A bucket has a Bloom filter, cut into cells of 4 KB; a
key's bits all lie in the cell that its hash names.  A batch looks its keys up in the filters of
the buckets that it touches; only where all bits of a key are set it may be loaded already, and
only the keys of such buckets are read.

A bucket without a filter, be it new or its filter lost in a crash, counts as one that may hold
any key: its keys, if there are any, are read and the filter is built from them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup
from .loads import BATCH, STREAM, appended_rows

#: Bits of a cell: what one bitmap aggregate holds.
CELL = 32768
_BUCKET, _CELL, _BITS, _AT = "bucket", "cell", "bits", "__at"


@dataclass(frozen=True)
class Index:
    """Size of the key index; a cell is good for about 3,000 keys at one false match in a hundred.

    The filters of all buckets are ``buckets * cells`` times 4 KB: 16 MB for 12 million keys.
    Beyond that more buckets are read than need be; results stay right.
    """

    buckets: int = 64
    cells: int = 64
    probes: int = 4

    def placed(self, keys: DataFrame, key: str) -> DataFrame:
        """Add a key's bucket, its cell and the places of its bits there."""
        first, second = F.xxhash64(key), F.xxhash64(F.lit(1), key)
        cell = F.pmod(first, F.lit(self.buckets * self.cells)).cast("int")
        step = F.shiftrightunsigned(first, 32).bitwiseOR(F.lit(1))
        places = [F.pmod(second + F.lit(i) * step, F.lit(CELL)) for i in range(self.probes)]
        return keys.withColumns(
            {_CELL: cell, _BUCKET: (cell / self.cells).cast("int"), _AT: F.array(*places)}
        )

    def filters(self, placed: DataFrame) -> DataFrame:
        """The cells of the placed keys."""
        return (
            placed.select(_BUCKET, _CELL, F.explode(_AT).alias("at"))
            .groupBy(_BUCKET, _CELL)
            .agg(F.bitmap_construct_agg("at").alias(_BITS))
        )


def _set(place: Column) -> Column:
    """Whether the bit at ``place`` of the cell is set."""
    byte = F.substring(F.col(_BITS), (place / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (place % 8).cast("int")) == 1


def write_keyed(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    key: str,
    order: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    index: Index = Index(),
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Load rows whose key is not loaded, each micro-batch to a folder of its own.

    Of rows of a key within a batch the first by ``order``, then by the other columns, is
    loaded; of rows in several batches that of the first batch.  Rows without a key are all
    loaded.  A replayed batch replaces its first attempt.  Any number of streams, one at a time,
    may load into one target.  What a batch read is in ``loads``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        rows = transform(batch) if transform else batch
        rows = rows.persist()
        try:
            _load(spark, rows, stream_id, batch_id)
        finally:
            rows.unpersist()

    def _load(spark: SparkSession, rows: DataFrame, stream_id: str, batch_id: int) -> None:
        unique = dedup(rows.where(F.col(key).isNotNull()), [key], order)
        placed = index.placed(unique.select(key), key).persist()
        touched = _values(placed, _BUCKET)
        filters = _parts(spark, f"{path}/filters", touched)
        known = [] if filters is None else _values(filters, _BUCKET)
        may = F.lit(True)
        looked = placed
        if filters is not None:
            looked = placed.join(filters.select(_CELL, _BITS), _CELL, "left")
            hit = F.forall(_AT, _set)
            may = ~F.col(_BUCKET).isin(known) | F.coalesce(hit, F.lit(False))
        asked = _values(looked.where(may), _BUCKET)
        own = (F.col(STREAM) == stream_id) & (F.col(BATCH) == batch_id)
        loaded = _parts(spark, f"{path}/keys", asked)
        fresh = unique
        if loaded is not None:
            fresh = unique.join(loaded.where(~own).select(key), key, "left_anti").select(*rows.columns)
        folder = f"{path}/rows/{STREAM}={stream_id}/{BATCH}={batch_id}"
        fresh.unionByName(rows.where(F.col(key).isNull())).write.mode("overwrite").parquet(folder)

        # From here on the rows are loaded; a crash before the end has the batch run again.
        new = index.placed(
            spark.read.schema(rows.schema).parquet(folder).select(key).where(F.col(key).isNotNull()), key
        )
        new.select(
            key, F.lit(stream_id).alias(STREAM), F.lit(batch_id).cast("long").alias(BATCH), _BUCKET
        ).repartition(_BUCKET).write.mode("append").partitionBy(_BUCKET).parquet(f"{path}/keys")
        cells = index.filters(new)
        lost = [b for b in touched if b not in known]
        if loaded is not None and lost:
            held = loaded.where(F.col(_BUCKET).isin(lost)).select(key)
            cells = cells.unionByName(index.filters(index.placed(held, key)))
        if filters is not None:
            cells = cells.unionByName(filters)
        merged = cells.groupBy(_BUCKET, _CELL).agg(F.bitmap_or_agg(_BITS).alias(_BITS))
        merged.repartition(_BUCKET).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(_BUCKET).parquet(f"{path}/filters")
        placed.unpersist()

        read = F.lit(len(asked) if loaded is not None else 0)
        spark.range(1).select(
            F.lit(stream_id).alias(STREAM), F.lit(batch_id).alias(BATCH),
            F.lit(rows.count()).alias("rows"), F.lit(len(touched)).alias("buckets"),
            read.alias("buckets_read"),
        ).write.mode("append").json(f"{path}/loads")

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _values(df: DataFrame, column: str) -> list:
    """Its distinct values: buckets, whose number is a parameter."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _parts(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame | None:
    """The given buckets of a table; None if it has none yet."""
    if not buckets:
        return None
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return table.where(F.col(_BUCKET).isin(buckets))


def keyed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The loaded rows of all batches."""
    return appended_rows(spark, f"{path}/rows")


def load_log(spark: SparkSession, path: str) -> DataFrame:
    """Per batch its rows, the buckets of its keys and those whose keys it read."""
    return spark.read.schema(
        f"{STREAM} STRING, {BATCH} BIGINT, rows BIGINT, buckets INT, buckets_read INT"
    ).json(f"{path}/loads")
