"""Terminal roster: registered terminals with status flags and last activity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import quarters_between, trailing_days
from ..functions.terminals import SUMMARY_WIDTH, clean_terminal_id, normalise_terminal_id
from ..operators.dedup import dedup, latest_per_key
from ..operators.lookup import add_last_activity, flag_membership
from ..operators.merge import merge_sync
from ..sources.columns import typed_times

KEY = "terminal_id"


def prepare_roster(
    roster: DataFrame, order: Sequence[str] = ("state",), width: int = SUMMARY_WIDTH
) -> DataFrame:
    """Terminal and state initials, one row per cleaned id."""
    cleaned = roster.select(
        clean_terminal_id(F.col(KEY).cast("string"), width).alias(KEY), "state"
    )
    return dedup(cleaned, [KEY], order).withColumnRenamed("state", "state_initials")


def recent_activity(
    journal: DataFrame,
    as_of: datetime,
    days: int = 120,
    width: int = SUMMARY_WIDTH,
    quarter_column: str | None = None,
) -> DataFrame:
    """Latest update per normalised terminal id among the last ``days`` days.

    The window covers every quarter it overlaps; ``quarter_column`` names the partition
    column holding the quarter key, so that the other quarters are not listed or read.
    """
    if quarter_column:
        quarters = quarters_between(as_of - timedelta(days=days), as_of)
        journal = journal.where(F.col(quarter_column).isin(*quarters))
    journal = typed_times(journal, "transactionTime", "updatedAt")
    recent = journal.where(trailing_days(F.col("transactionTime"), as_of, days)).select(
        normalise_terminal_id(F.col("terminalId"), width).alias(KEY),
        F.col("updatedAt").alias("last_transaction_time"),
    )
    return latest_per_key(recent, KEY, "last_transaction_time")


def terminal_roster(
    registered: DataFrame,
    connected: DataFrame | None = None,
    active: DataFrame | None = None,
    inactive: DataFrame | None = None,
    activity: DataFrame | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Registered terminals, one row each, with 0/1 flags and last transaction time.

    All inputs carry normalised ids.  Flags and times depend on the id alone, so repeated
    registrations are removed first: every input then is shuffled once, reduced to one row
    per id, and the joins line up on that partitioning.
    """
    out = dedup(registered, [KEY], order)
    for flag, members in (("connected", connected), ("active", active), ("inactive", inactive)):
        out = flag_membership(out, members, flag, KEY)
    return add_last_activity(out, activity, "last_transaction_time", KEY)


def sync_roster(target: DataFrame | None, roster: DataFrame) -> DataFrame:
    """The roster table after a load: replaced at first, then kept in step.

    The roster has one row per terminal; of a terminal with several loaded rows all stay.
    """
    return merge_sync(target, roster, KEY, source_unique=True, one_join=True)
