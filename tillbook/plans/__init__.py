"""The reports.  Each is a pure plan over its inputs; the caller triggers it at a sink."""

from .activity import terminal_activity
from .agents import (
    agent_snapshot,
    monthly_state,
    monthly_state_history,
    weekly_agent_activity,
    weekly_agent_activity_history,
)
from .loads import merchant_dimension, purchase_increment, routed, service_increment
from .roster import prepare_roster, recent_activity, sync_roster, terminal_roster
from .settlement import clean_settlement
from .terminals import (
    current_terminals,
    daily_terminal,
    daily_terminal_history,
    monthly_terminal,
    monthly_terminal_history,
)

__all__ = [
    "agent_snapshot",
    "clean_settlement",
    "current_terminals",
    "daily_terminal",
    "daily_terminal_history",
    "merchant_dimension",
    "monthly_state",
    "monthly_state_history",
    "monthly_terminal",
    "monthly_terminal_history",
    "prepare_roster",
    "purchase_increment",
    "recent_activity",
    "routed",
    "service_increment",
    "sync_roster",
    "terminal_activity",
    "terminal_roster",
    "weekly_agent_activity",
    "weekly_agent_activity_history",
]
