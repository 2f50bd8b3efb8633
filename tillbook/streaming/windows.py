"""Event-time windows whose open ones live in the state store and whose late rows are kept.

A window closes when the watermark, the latest event time seen less ``delay``, passes its end:
it is then written once, for good, and leaves the state, which so holds the open windows only.
Spark drops what arrives for a closed window.  Here the same micro-batch puts those rows, and
rows without a time, into a side table, so that every row is in exactly one of three places:

* ``closed`` windows, in the batch folders under ``path``;
* ``open`` windows, in the state of the last batch, read from the checkpoint;
* ``late`` rows, in the batch folders, each in the shape of a window of one row.

``unique`` names columns that tell rows apart: of equal ones that come while the watermark has
not passed their time only the first is counted.  A repeat that comes later is a late row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from .loads import BATCH, STREAM

START, KIND = "window_start", "kind"
CLOSED, LATE = "closed", "late"
_TIME, _END = "__time", "__end"
_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Windows:
    """What a window is: its keys, its measures and when it closes.

    ``measures`` maps a name to ``sum``, ``max`` or ``min`` and the expression of a row that it
    is taken of; these combine, so a late row can still be added to its window.
    """

    keys: Sequence[str]
    measures: Mapping[str, tuple[str, Column]]
    event_time: str
    delay: str
    width: str = "1 day"
    unique: Sequence[str] = ()

    def _combined(self, names: Mapping[str, Column] | None = None) -> list[Column]:
        names = names or {m: F.col(m) for m in self.measures}
        return [_COMBINE[how](names[m]).alias(m) for m, (how, _) in self.measures.items()]

    def write(
        self,
        stream: DataFrame,
        path: str,
        checkpoint: str,
        trigger: dict[str, object] | None = None,
    ) -> StreamingQuery:
        """Write closed windows and late rows, a folder each micro-batch under ``path``.

        A batch replayed after a failure replaces its first attempt.
        """
        rows = stream.withColumn(_TIME, _instant(stream, self.event_time))
        on_time = rows.withWatermark(_TIME, self.delay)
        if self.unique:
            on_time = on_time.dropDuplicatesWithinWatermark(list(self.unique))
        window = F.window(_TIME, self.width)
        windows = on_time.groupBy(window.alias("window"), *self.keys).agg(
            *self._combined({m: value for m, (_, value) in self.measures.items()})
        )
        nothing = F.lit(None).cast("timestamp")
        closed = windows.select(
            F.lit(CLOSED).alias(KIND), F.col("window.start").alias(START), *self.keys,
            *self.measures, nothing.alias(_TIME), nothing.alias(_END),
        )
        # A row without a time has no window; the epoch stands in, so that the row stays.
        own = F.window(F.coalesce(_TIME, F.timestamp_micros(F.lit(0))), self.width)
        each = rows.withColumn("__window", own).select(
            F.lit(LATE).alias(KIND),
            F.when(F.col(_TIME).isNotNull(), F.col("__window.start")).alias(START),
            *self.keys,
            *[v.cast(windows.schema[m].dataType).alias(m) for m, (_, v) in self.measures.items()],
            _TIME,
            F.col(_TIME if self.unique else "__window.end").alias(_END),
        )

        def store(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            mark = F.timestamp_millis(F.lit(_late_watermark(spark, checkpoint, batch_id)))
            late = F.col(_TIME).isNull() | (F.col(_END) <= mark)
            stream_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
            kept = batch.where((F.col(KIND) == CLOSED) | late).drop(_TIME, _END)
            kept.write.mode("overwrite").partitionBy(KIND).parquet(
                f"{path}/{STREAM}={stream_id}/{BATCH}={batch_id}"
            )

        return (
            closed.unionByName(each)
            .writeStream.option("checkpointLocation", checkpoint)
            .outputMode("append")
            .foreachBatch(store)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def open(self, spark: SparkSession, checkpoint: str) -> DataFrame:
        """The windows that are still in the state after the last finished batch."""
        # Operators are numbered from the sink: the windows are the first.
        state = spark.read.format("statestore").option("operatorId", 0).load(checkpoint)
        buffers = iter(state.schema["value"].dataType.fields)
        fields, values = [], {}
        for name, (how, _) in self.measures.items():
            own = next(buffers)
            fields.append(StructField(name, own.dataType))
            values[name] = F.col(f"__v.{name}")
            if how == "sum" and isinstance(own.dataType, DecimalType):
                empty = f"{name}__empty"
                fields.append(StructField(empty, next(buffers).dataType))
                values[name] = F.when(~F.col(f"__v.{empty}"), values[name])
        named = state.select("key", F.col("value").cast(StructType(fields)).alias("__v"))
        return named.select(
            F.col("key.window.start").alias(START),
            *[F.col(f"key.{k}").alias(k) for k in self.keys],
            *[v.alias(m) for m, v in values.items()],
        )

    def closed(self, spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
        """The windows that are written for good, each once."""
        return self._written(spark, path, checkpoint).where(F.col(KIND) == CLOSED).drop(KIND, STREAM, BATCH)

    def late(self, spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
        """The late rows, as windows of one row, with the batch that they came in."""
        return self._written(spark, path, checkpoint).where(F.col(KIND) == LATE).drop(KIND)

    def _written(self, spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
        shape = self.open(spark, checkpoint).schema
        schema = StructType([*shape.fields])
        for name, kind in ((STREAM, StringType()), (BATCH, LongType()), (KIND, StringType())):
            schema = schema.add(name, kind)
        return spark.read.schema(schema).option("basePath", path).parquet(path)

    def late_counts(self, spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
        """How many rows came late in each batch that had any, and for how many windows."""
        return self.late(spark, path, checkpoint).groupBy(STREAM, BATCH).agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct(START).alias("windows")
        )

    def current(self, spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
        """All windows, late rows added to theirs.

        Windows of a time for which nothing came late are passed on as they were written.
        """
        windows = self.closed(spark, path, checkpoint).unionByName(self.open(spark, checkpoint))
        late = self.late(spark, path, checkpoint).drop(STREAM, BATCH)
        touched = late.select(START).distinct()
        again = windows.join(touched, START, "left_semi").unionByName(late)
        # Rows without a time may lack keys too; groupBy takes nulls as one value.
        return windows.join(touched, START, "left_anti").unionByName(
            again.groupBy(START, *self.keys).agg(*self._combined())
        )

    def totals(self, spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
        """The measures by key over all windows."""
        parts = [
            self.closed(spark, path, checkpoint),
            self.open(spark, checkpoint),
            self.late(spark, path, checkpoint).drop(STREAM, BATCH),
        ]
        return reduce(DataFrame.unionByName, parts).groupBy(*self.keys).agg(*self._combined())


def _instant(df: DataFrame, column: str) -> Column:
    """A time for watermarks; a time without a zone keeps its own day, whatever the session's zone."""
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        epoch = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
        return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {epoch}, `{column}`))")
    return F.col(column).cast("timestamp")


def _late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in milliseconds, below which stateful operators drop rows of a batch.

    It is the one that the batch before began with, or the batch's own where chains of stateful
    operators are switched off.  Spark writes it to the offsets of each batch before it runs.
    """
    chained = spark.conf.get("spark.sql.streaming.statefulOperator.allowMultiple", "true") == "true"
    number = batch_id - 1 if chained else batch_id
    if number < 0:
        return 0
    lines = spark.read.text(f"{checkpoint}/offsets/{number}", wholetext=True).first()[0].split("\n")
    return json.loads(lines[1])["batchWatermarkMs"]


def daily_windows(delay: str = "2 days", unique: Sequence[str] = ()) -> Windows:
    """Daily activity: volume, value and latest time by wallet, terminal, category and day.

    The stream has a ``day`` column, the day of ``updated_at``, which its window implies.
    """
    return Windows(
        keys=("wallet", "terminal", "category", "day"),
        measures={
            "volume": ("sum", F.lit(1)),
            "value": ("sum", F.col("amount")),
            "updated_at": ("max", F.col("updated_at")),
        },
        event_time="updated_at",
        delay=delay,
        unique=unique,
    )


def activity_windows(delay: str = "2 days", unique: Sequence[str] = ()) -> Windows:
    """Latest transaction and update time by terminal, a window a day: ``totals`` has the latest."""
    return Windows(
        keys=("terminal_id",),
        measures={
            "last_transaction_time": ("max", F.col("transaction_time")),
            "last_connect_date": ("max", F.col("updated_at")),
        },
        event_time="transaction_time",
        delay=delay,
        unique=unique,
    )


