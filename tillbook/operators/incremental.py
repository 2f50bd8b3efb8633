"""Incremental loads from a watermark that the committed target itself provides.

A watermark is one value, so the source scan filters on it like on any constant: a key
watermark is fetched when the plan is built (there may be none, and then no filter either),
a time watermark always exists and is a scalar subquery of the load.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import end_of_previous_month, timestamp


def high_watermark(target: DataFrame, key: str) -> DataFrame:
    """Largest loaded key; null when nothing is loaded.

    Only the key column is read.  Where keys grow with time, pass just the newest partition
    of a partitioned target.
    """
    return target.agg(F.max(key).alias("watermark"))


def time_watermark(target: DataFrame, ts: str, as_of: date) -> DataFrame:
    """Latest loaded time, or the end of the month before ``as_of``."""
    latest = F.max(F.col(ts).cast("timestamp_ntz"))
    return target.agg(
        F.coalesce(latest, timestamp(end_of_previous_month(as_of))).alias("watermark")
    )


def rows_after(
    source: DataFrame, target: DataFrame, key: str, inclusive: bool = False
) -> DataFrame:
    """Source rows whose key lies after the target's watermark, or all without one."""
    mark = high_watermark(target, key).first()["watermark"]
    if mark is None:
        return source
    column = F.col(key)
    return source.where(column >= F.lit(mark) if inclusive else column > F.lit(mark))


def rows_between(
    source: DataFrame,
    target: DataFrame,
    *,
    ts: str,
    key: str,
    as_of: datetime,
    target_ts: str | None = None,
) -> DataFrame:
    """Source rows from the time watermark up to ``as_of`` that are not loaded yet.

    The lower bound is inclusive: rows sharing the watermark's time may arrive late.  Only
    target rows at that very time can repeat, so the anti-join reads just those.
    """
    target_ts = target_ts or ts
    mark = time_watermark(target, target_ts, as_of).scalar()
    window = source.where((F.col(ts) >= mark) & (F.col(ts) <= timestamp(as_of)))
    boundary = target.where(F.col(target_ts) >= mark).select(key)
    return window.join(boundary, key, "left_anti")
