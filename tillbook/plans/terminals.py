"""Terminal summaries: daily with bank, state and region, and monthly with bank."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import DAILY_RATE_SCALE, MONTHLY_RATE_SCALE, to_amount
from ..functions.periods import day_of, lagged_day, month_of, month_start
from ..functions.terminals import SUMMARY_WIDTH, clean_terminal_id, round_terminal_id
from ..operators.lookup import add_bank, add_region, lookup, override_when
from ..operators.merge import merge_upsert
from ..operators.rollups import terminal_summary
from ..sources.columns import typed_times
from ..sources.scans import within
from .roster import prepare_roster

# Merchants with this prefix report under this bank.
OVERRIDE_PREFIX = "NOVA"
OVERRIDE_BANK = "NOVA BANK"

SUMMARY_COLUMNS = (
    "terminal_id", "volume", "value", "msc", "merchant_id", "merchant", "date", "bank",
)


def current_terminals(terminals: DataFrame | None, roster: DataFrame) -> DataFrame:
    """The terminal-to-state table after taking over the roster's states."""
    # The prepared roster has one row per id, so the merge need not check that again.
    return merge_upsert(
        terminals, prepare_roster(roster), "terminal_id", ["state_initials"], source_unique=True
    )


def add_current_initials(
    facts: DataFrame, terminals: DataFrame | None, roster: DataFrame
) -> DataFrame:
    """State initials as ``current_terminals`` would give them, without building it.

    Two lookups by terminal id replace the merge and the read of its result.  They line up
    with facts that were aggregated by terminal, so only the two tables are shuffled.
    """
    fresh = prepare_roster(roster).withColumn("listed", F.lit(True))
    key = F.col("terminal_id")
    joined = lookup(
        facts, fresh, key, "terminal_id", {"__listed": "listed", "state_initials": "state_initials"}
    )
    if terminals is None:
        return joined.drop("__listed")
    joined = lookup(joined, terminals, key, "terminal_id", {"__known": "state_initials"})
    initials = F.when(F.col("__listed"), F.col("state_initials")).otherwise(F.col("__known"))
    return joined.withColumn("state_initials", initials).drop("__listed", "__known")


def summarise_daily(
    txns: DataFrame,
    roster: DataFrame,
    terminals: DataFrame | None,
    banks: DataFrame,
    states: DataFrame,
    *extra_keys: str,
) -> DataFrame:
    """Terminal summary with state, region and bank; every lookup follows the aggregation."""
    cleaned = txns.withColumns(
        {
            "terminal_id": clean_terminal_id(F.col("terminal_id").cast("string"), SUMMARY_WIDTH),
            "amount": to_amount(F.col("amount")),
        }
    )
    summary = terminal_summary(cleaned, *extra_keys, rate_scale=DAILY_RATE_SCALE)
    located = add_region(add_current_initials(summary, terminals, roster), states)
    with_bank = override_when(
        add_bank(located, banks),
        "bank",
        F.col("merchant").startswith(OVERRIDE_PREFIX),
        OVERRIDE_BANK,
    )
    return with_bank.select(*extra_keys, *SUMMARY_COLUMNS, "state", "region")


def daily_terminal(
    txns: DataFrame,
    roster: DataFrame,
    terminals: DataFrame | None,
    banks: DataFrame,
    states: DataFrame,
    as_of: date,
    lag: int = 3,
    *,
    month_column: str | None = None,
) -> DataFrame:
    """Summary of the day ``lag`` days before ``as_of``.

    Write ``current_terminals`` next to it to keep the terminal table in step.
    ``month_column`` names a partition column with the month key: other months are not read.
    """
    day = within(txns, lagged_day(as_of, lag), "date", month_column)
    return summarise_daily(day, roster, terminals, banks, states)


def daily_terminal_history(
    txns: DataFrame,
    roster: DataFrame,
    terminals: DataFrame | None,
    banks: DataFrame,
    states: DataFrame,
) -> DataFrame:
    """Every day's summary in one pass, against the current terminals."""
    by_day = typed_times(txns, "date").withColumn("day", day_of(F.col("date")))
    return summarise_daily(by_day, roster, terminals, banks, states, "day")


def summarise_monthly(txns: DataFrame, banks: DataFrame, *extra_keys: str) -> DataFrame:
    """Terminal summary with bank, ids rounded to five places."""
    rounded = txns.withColumns(
        {
            "terminal_id": round_terminal_id(F.col("terminal_id")),
            "amount": to_amount(F.col("amount")),
        }
    )
    summary = terminal_summary(rounded, *extra_keys, rate_scale=MONTHLY_RATE_SCALE)
    renamed = summary.withColumnsRenamed({"value": "amount", "merchant": "merchant_name"})
    return add_bank(renamed, banks, dotted=5, plain=5).select(
        *extra_keys,
        "terminal_id", "volume", "amount", "msc", "merchant_id", "merchant_name", "date", "bank",
    )


def monthly_terminal(
    txns: DataFrame, banks: DataFrame, as_of: date, *, month_column: str | None = None
) -> DataFrame:
    """Summary of the month of ``as_of``."""
    return summarise_monthly(within(txns, month_of(as_of), "date", month_column), banks)


def monthly_terminal_history(txns: DataFrame, banks: DataFrame) -> DataFrame:
    """Every month's summary in one pass."""
    by_month = typed_times(txns, "date").withColumn("month", month_start(F.col("date")))
    return summarise_monthly(by_month, banks, "month")
