"""Agent reports: weekly activity, monthly state rollup, snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import parse_amount
from ..functions.periods import Period, day_of, previous_month, previous_week, week_of
from ..functions.text import first_non_empty
from ..operators.lookup import Join, add_agent, add_state_by_name, lookup, prepare_agent_states
from ..operators.rollups import daily_activity, state_rollup, wallet_totals
from ..sources.columns import typed_times
from ..sources.scans import within

ACTIVITY_COLUMNS = (
    "wallet", "updated_at", "category", "terminal", "bvn", "phone_number", "address",
    "volume", "value",
)


def parsed(txns: DataFrame) -> DataFrame:
    """Service transactions with typed time and amount."""
    return typed_times(txns, "updated_at").withColumn("amount", parse_amount(F.col("amount")))


def in_period(txns: DataFrame, period: Period, month_column: str | None = None) -> DataFrame:
    """Parsed transactions of a period; ``month_column`` prunes the other months."""
    return parsed(within(txns, period, "updated_at", month_column))


def fill_agent_columns(
    activity: DataFrame, agents: DataFrame, join: Join = lookup
) -> DataFrame:
    """Fill the empty identity columns of activity rows from their agent."""
    taken = {"__bvn": "bvn", "__nin": "nin", "__phone": "phone_number", "__address": "address"}
    joined = add_agent(activity, agents, taken, join)
    return joined.withColumns(
        {
            "bvn": first_non_empty(F.col("bvn"), F.col("__bvn"), F.col("__nin")),
            "phone_number": first_non_empty(F.col("phone_number"), F.col("__phone")),
            "address": first_non_empty(F.col("address"), F.col("__address")),
        }
    ).drop(*taken)


def weekly_agent_activity(
    txns: DataFrame,
    agents: DataFrame,
    as_of: date,
    join: Join = lookup,
    *,
    month_column: str | None = None,
) -> DataFrame:
    """Daily activity of the previous week, with agent identity and report date.

    Transactions are aggregated before the agent lookup, so the join sees one row per
    wallet, terminal, category and day.
    """
    period = previous_week(as_of)
    activity = daily_activity(in_period(txns, period, month_column))
    return _identified(activity, agents, join).select(
        *ACTIVITY_COLUMNS, F.lit(period.report_date).alias("report_date")
    )


def weekly_agent_activity_history(
    txns: DataFrame, agents: DataFrame, join: Join = lookup
) -> DataFrame:
    """Every week's report in one pass: a day decides its week, so grouping is the same."""
    sunday = F.date_add(week_of(F.col("day")), 6)
    return _identified(daily_activity(parsed(txns)), agents, join).select(
        *ACTIVITY_COLUMNS, sunday.cast("string").alias("report_date")
    )


def _identified(activity: DataFrame, agents: DataFrame, join: Join) -> DataFrame:
    empty = {"bvn": F.lit(""), "phone_number": F.lit(""), "address": F.lit("")}
    return fill_agent_columns(activity.withColumns(empty), agents, join)


def rollup_states(
    totals: DataFrame, agents: DataFrame, states: DataFrame, *extra_keys: str
) -> DataFrame:
    """Wallet totals through agent and state to the state rollup."""
    located = add_agent(totals, prepare_agent_states(agents), {"agent_state": "agent_state"})
    return state_rollup(add_state_by_name(located, states), *extra_keys)


def monthly_state(
    txns: DataFrame,
    agents: DataFrame,
    states: DataFrame,
    as_of: date,
    *,
    month_column: str | None = None,
) -> DataFrame:
    """State rollup of the previous month.

    Transactions shrink to one row per wallet before any lookup; counts and exact decimal
    sums add up to the same result as joining every transaction.
    """
    period = previous_month(as_of)
    totals = wallet_totals(in_period(txns, period, month_column))
    return rollup_states(totals, agents, states).withColumn(
        "report_date", F.lit(period.report_date)
    )


def monthly_state_history(
    txns: DataFrame, agents: DataFrame, states: DataFrame
) -> DataFrame:
    """Every month's state rollup in one pass."""
    by_month = parsed(txns).withColumn("month_end", F.last_day(day_of(F.col("updated_at"))))
    rolled = rollup_states(wallet_totals(by_month, "month_end"), agents, states, "month_end")
    return rolled.withColumn("report_date", F.col("month_end").cast("string")).drop("month_end")


def agent_snapshot(agents: DataFrame) -> DataFrame:
    """The agent table as it is, for a replacing write."""
    return agents
