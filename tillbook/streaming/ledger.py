"""Counts of every micro-batch, kept and compared with what the target holds.

``counted`` marks points of a stream's plan; the counts ride on the stream's own tasks, without
a pass of their own.  A ``Ledger`` hears them with each batch's progress and writes them to a
folder named like the batch's own, so a batch replayed after a failure replaces its counts as it
replaces its rows.  ``reconcile`` then holds them against the target, batch by batch.

Counts are taken where the batch runs.  They are exact while a batch is computed once, which
``write_batches`` without ``key`` does; a map stage computed again after a lost executor may
count rows twice, and the driver may die between a batch's commit and its counts.  Neither
passes unseen: such a batch does not agree, or has no counts.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .loads import BATCH, STREAM

TOTALS = "MAP<STRING, DECIMAL(38, 6)>"
ENTRIES = f"stage STRING, rows BIGINT, totals {TOTALS}"


def counted(stream: DataFrame, stage: str, *totals: str) -> DataFrame:
    """Rows that pass here, and the sums of exact columns ``totals``, with every micro-batch."""
    return stream.observe(
        stage,
        F.count(F.lit(1)).alias("rows"),
        F.lit(json.dumps(totals)).alias("columns"),
        *[F.sum(c).cast("decimal(38,6)").alias(f"total_{n}") for n, c in enumerate(totals)],
    )


class Ledger(StreamingQueryListener):
    """Keeps the counts of the streams named ``name`` under ``path``.

    Add it to a session before the stream starts; ``settle`` waits for a stream and its counts.
    """

    def __init__(self, spark: SparkSession, path: str, name: str) -> None:
        self.spark, self.path, self.name = spark, path, name
        self._ended: set[str] = set()
        self._failed: Exception | None = None
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name or not progress.observedMetrics:
            return
        try:
            self._write(str(progress.id), progress.batchId, progress.observedMetrics)
        except Exception as error:  # Spark only logs what a listener raises; settle raises it.
            with self._news:
                self._failed = error

    def _write(self, stream_id: str, batch_id: int, metrics: dict) -> None:
        entries = [(stage, row["rows"], _totals(row)) for stage, row in sorted(metrics.items())]
        self.spark.createDataFrame(entries, ENTRIES).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/{STREAM}={stream_id}/{BATCH}={batch_id}"
        )

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def settle(self, query: StreamingQuery, timeout: float = 300.0) -> None:
        """Wait until ``query`` is done and all its counts are written.

        Events come in order, so those of its batches lie before that of its end.
        """
        query.awaitTermination()
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError(f"no word of the end of {query.name} in {timeout} seconds")
            if self._failed is not None:
                raise self._failed


def _totals(row) -> dict[str, object]:
    return {c: row[f"total_{n}"] for n, c in enumerate(json.loads(row["columns"]))}


def ledger_rows(spark: SparkSession, path: str) -> DataFrame:
    """``stream_id, batch_id, stage, rows, totals`` of every counted batch; none before the first."""
    schema = f"{ENTRIES}, {STREAM} STRING, {BATCH} BIGINT"
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{STREAM}=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def reconcile(
    ledger: DataFrame, target: DataFrame, stage: str, totals: Sequence[str] = ()
) -> DataFrame:
    """One row per batch of either side: counts at ``stage``, rows in the target, ``agrees``.

    ``target`` holds the rows of all batches with the columns of their folders.  A batch without
    counts has a null ``rows_counted``, one without rows in the target 0 ``rows_stored``.
    ``agrees`` is never null; a sum over no row equals another such sum.
    """
    keys = [STREAM, BATCH]
    said = ledger.where(F.col("stage") == stage).select(
        F.col(STREAM).cast("string").alias(STREAM), F.col(BATCH).cast("bigint").alias(BATCH),
        F.col("rows").alias("rows_counted"), F.col("totals").alias("said"),
    )
    stored = target.groupBy(
        F.col(STREAM).cast("string").alias(STREAM), F.col(BATCH).cast("bigint").alias(BATCH)
    ).agg(
        F.count(F.lit(1)).alias("rows_stored"),
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in totals]).cast("array<string>"),
            F.array(*[F.sum(c).cast("decimal(38,6)") for c in totals]).cast("array<decimal(38,6)>"),
        ).alias("found"),
    )
    same = [F.col("said")[c].eqNullSafe(F.col("found")[c]) for c in totals]
    agrees = F.col("rows_counted").eqNullSafe(F.col("rows_stored"))
    for each in same:
        agrees = agrees & each
    return (
        said.join(stored, keys, "full")
        .withColumn("rows_stored", F.coalesce("rows_stored", F.lit(0).cast("bigint")))
        .withColumn("agrees", agrees)
        .select(*keys, "rows_counted", "rows_stored", "agrees")
    )
