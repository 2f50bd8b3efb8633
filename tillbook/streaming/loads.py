"""Incremental loads as streams.

Each stream runs with ``availableNow`` (drain what is there, then stop) unless given
another trigger, so it can be scheduled like the batch loads.  No stream holds state or a
watermark: a micro-batch is reduced by itself and written as its own folder, and readers
combine the batches.  Counts and sums add up and a latest time is the latest of latest ones,
so the result does not depend on how files arrive, in what order, or how late.

A batch folder is named by the query's own id and the batch number.  A batch replayed after a
failure replaces its first attempt, and a query with another checkpoint adds to the target.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.money import TOTAL
from ..operators.dedup import dedup
from ..operators.rollups import daily_activity

STREAM, BATCH = "stream_id", "batch_id"
ACTIVITY_KEYS = ("wallet", "terminal", "category", "day")


def file_stream(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: StructType | str,
    *,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Files of a folder as a stream; ``max_files`` bounds the size of a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def drop_stream(
    spark: SparkSession,
    fmt: str,
    path: str,
    archive: str,
    schema: StructType | str,
    *,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """A drop folder as a stream, each row with its file's path and time of change.

    A file is read once, also when it stays: the checkpoint knows it.  Files that are done move
    to ``archive``, a folder outside ``path``, so that the drop folder is not listed at length.
    """
    rows = file_stream(
        spark, fmt, path, schema, max_files=max_files,
        cleanSource="archive", sourceArchiveDir=archive, **options,
    )
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_time"),
    )


def latest_activity(activity: DataFrame) -> DataFrame:
    """Latest transaction and update time per terminal; of batches and of their results."""
    columns = {"transaction_time": "last_transaction_time", "updated_at": "last_connect_date"}
    return (
        activity.withColumnsRenamed(columns)
        .groupBy("terminal_id")
        .agg(*[F.max(c).alias(c) for c in columns.values()])
    )


def combined_daily(batches: DataFrame) -> DataFrame:
    """Daily activity from the daily activities of batches."""
    return batches.groupBy(*ACTIVITY_KEYS).agg(
        F.sum("volume").alias("volume"),
        F.sum("value").cast(TOTAL).alias("value"),
        F.max("updated_at").alias("updated_at"),
    )


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    key: str | None = None,
    partition_by: Sequence[str] = (),
    trigger: dict[str, object] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch to a folder of its own under ``path``.

    With ``key`` a row is loaded once: of repeats within the batch the least row stays, and rows
    whose key earlier batches hold are left out; rows without a key are all loaded.
    ``partition_by`` then names columns that a key determines, such as the quarter of its time:
    only partitions that the batch touches are read.  Where nothing of the kind is known,
    ``keyed.write_keyed`` reads no more than an index says.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Spark writes the query's id when it creates the checkpoint.
        stream_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        rows = transform(batch) if transform else batch
        if key:
            rows = _new_rows(rows, done_batches(spark, path), key, partition_by, stream_id, batch_id)
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/{STREAM}={stream_id}/{BATCH}={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if name is not None:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _new_rows(
    rows: DataFrame,
    loaded: DataFrame | None,
    key: str,
    partition_by: Sequence[str],
    stream_id: str,
    batch_id: int,
) -> DataFrame:
    keyed = dedup(rows.where(F.col(key).isNotNull()), [key])
    keyless = rows.where(F.col(key).isNull())
    if loaded is None:
        return keyed.unionByName(keyless)
    # A replay must not take its own first attempt for rows loaded before.
    own: Column = (F.col(STREAM) == stream_id) & (F.col(BATCH) == batch_id)
    loaded = loaded.where(~own)
    for column in partition_by:
        # One value per partition touched, a handful even in a large batch.
        touched = [r[0] for r in rows.select(column).distinct().collect()]
        known = [v for v in touched if v is not None]
        wanted = F.col(column).isin(known) if known else F.lit(False)
        loaded = loaded.where(wanted | F.col(column).isNull() if None in touched else wanted)
    fresh = keyed.join(loaded.select(key), key, "left_anti").select(*rows.columns)
    return fresh.unionByName(keyless)


def done_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """What is loaded, with the columns of the folders; None before the first batch."""
    try:
        return spark.read.option("basePath", path).parquet(f"{path}/{STREAM}=*")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def batch_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches with the stream and the number of their batch."""
    return spark.read.parquet(path)


def appended_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches."""
    return batch_rows(spark, path).drop(STREAM, BATCH)


def current_daily(spark: SparkSession, path: str) -> DataFrame:
    """Daily activity over all batches written with ``daily_activity``.

    The target grows by the days of every batch, and all are read; where they are many,
    ``compaction.compact`` folds them and ``compaction.compacted`` reads the result.
    """
    return combined_daily(appended_rows(spark, path))


def current_latest(spark: SparkSession, path: str) -> DataFrame:
    """Latest activity over all batches written with ``latest_activity``."""
    return latest_activity(appended_rows(spark, path))


__all__ = [
    "appended_rows", "batch_rows", "combined_daily", "current_daily", "current_latest",
    "daily_activity", "done_batches", "drop_stream", "file_stream", "latest_activity", "write_batches",
]
