"""Aggregations.

Every rollup is a combinable aggregate: each task reduces its rows to one per key before
the shuffle, so a key with a third of all rows costs one row per task.  Buffers are
numbers or timestamps wherever possible, which keeps Spark on hash aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.money import FEE_RATE, TOTAL, total_fee
from ..functions.periods import day_of


def daily_activity(txns: DataFrame) -> DataFrame:
    """Volume, value and latest time by wallet, terminal, category and day."""
    return (
        txns.withColumn("day", day_of(F.col("updated_at")))
        .groupBy("wallet", "terminal", "category", "day")
        .agg(
            F.count(F.lit(1)).alias("volume"),
            F.sum("amount").cast(TOTAL).alias("value"),
            F.max("updated_at").alias("updated_at"),
        )
    )


def wallet_totals(txns: DataFrame, *extra_keys: str) -> DataFrame:
    """Volume and value per wallet: the reduced input of the state rollup."""
    return txns.groupBy("wallet", *extra_keys).agg(
        F.count(F.lit(1)).alias("volume"), F.sum("amount").cast(TOTAL).alias("value")
    )


def state_rollup(totals: DataFrame, *extra_keys: str) -> DataFrame:
    """Transactions, value and distinct wallets by state and region.

    ``totals`` holds ``wallet_totals`` rows with ``state`` and ``region`` attached;
    wallets without a state form the null group.
    """
    return totals.groupBy("state", "region", *extra_keys).agg(
        F.sum("volume").alias("volume_of_transactions"),
        F.sum("value").cast(TOTAL).alias("total_transaction_value"),
        F.count_distinct("wallet").alias("unique_wallets"),
    )


def terminal_summary(
    txns: DataFrame, *extra_keys: str, rate_scale: int, rate: Decimal = FEE_RATE
) -> DataFrame:
    """Volume, value, fee and a representative merchant per terminal.

    Volume counts non-null ids, so the null group shows 0.  The representative is the
    earliest transaction, then the smallest merchant id and name, nulls last.  Rows are
    first reduced per terminal *and* merchant with fixed-width buffers; only those few
    rows go through the struct minimum.
    """
    keys = ["terminal_id", *extra_keys]
    per_merchant = txns.groupBy(*keys, "merchant_id", "merchant").agg(
        F.count("terminal_id").alias("volume"),
        F.sum("amount").alias("value"),
        F.min("date").alias("date"),
    )
    first = F.min(nulls_last("date", "merchant_id", "merchant")).alias("first")
    per_terminal = per_merchant.groupBy(*keys).agg(
        F.sum("volume").alias("volume"), F.sum("value").cast(TOTAL).alias("value"), first
    )
    return per_terminal.select(
        *keys,
        "volume",
        "value",
        total_fee(F.col("value"), rate_scale, rate).alias("msc"),
        "first.merchant_id",
        "first.merchant",
        "first.date",
    )


def last_activity(journal: DataFrame, *extra_keys: str, key: str = "terminal_id") -> DataFrame:
    """Latest transaction and update time per terminal; ids must be cleaned already."""
    return journal.groupBy(key, *extra_keys).agg(
        F.max("transaction_time").alias("last_transaction_time"),
        F.max("updated_at").alias("last_connect_date"),
    )


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key."""
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def count_rows(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count the rows passing a point of the plan without a pass of its own.

    ``observation.get["rows"]`` is filled by the first action on the returned frame.
    """
    observation = Observation(stage)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def most_recent(df: DataFrame, ts: str, *ties: str) -> DataFrame:
    """Whole output ordered by time, newest first."""
    return df.orderBy(F.col(ts).desc(), *ties)


def top_recent(df: DataFrame, ts: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` newest rows; each task keeps only its own ``k``."""
    return most_recent(df, ts, *ties).limit(k)


def first_page(df: DataFrame, key: str, size: int, after: object | None = None) -> DataFrame:
    """The next ``size`` rows in key order, after a given key."""
    if after is not None:
        df = df.where(F.col(key) > F.lit(after))
    return df.orderBy(key).limit(size)


def nulls_last(*names: str) -> Column:
    """Struct whose natural order sorts by the named columns with nulls last."""
    parts: Sequence[Column] = [
        part for n in names for part in (F.col(n).isNull().alias(f"{n}_missing"), F.col(n))
    ]
    return F.struct(*parts)
