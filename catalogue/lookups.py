"""Lookups, membership flags and match statistics."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import functions as F

from tillbook.functions.terminals import ACTIVITY_WIDTH, clean_terminal_id
from tillbook.operators.lookup import (
    add_agent,
    add_bank,
    add_device,
    add_last_activity,
    add_state_by_name,
    add_state_region,
    flag_membership,
    flag_memberships,
    heavy_keys,
    lookup,
    match_stats,
    prepare_agent_states,
    salted_lookup,
    without_match,
)
from tillbook.plans.activity import prepare_devices
from tillbook.plans.roster import prepare_roster, recent_activity

from . import sql
from .inputs import load, normalised, with_inputs
from .registry import register

AGENT_SQL = """SELECT txn_id, wallet, a.bvn AS bvn, a.nin AS nin, a.address AS address
               FROM service_txn LEFT JOIN agent a ON wallet = wallet_id"""


@register("join_agent", with_inputs("service_txn agent", AGENT_SQL))
def join_agent(spark, sf_dir):
    joined = add_agent(
        load(spark, sf_dir, "service_txn"), load(spark, sf_dir, "agent"),
        {"bvn": "bvn", "nin": "nin", "address": "address"},
    )
    return joined.select("txn_id", "wallet", "bvn", "nin", "address")


@register("join_agent_salted", with_inputs("service_txn agent", AGENT_SQL))
def join_agent_salted(spark, sf_dir):
    joined = add_agent(
        load(spark, sf_dir, "service_txn"), load(spark, sf_dir, "agent"),
        {"bvn": "bvn", "nin": "nin", "address": "address"}, join=salted_lookup,
    )
    return joined.select("txn_id", "wallet", "bvn", "nin", "address")


@register("join_agent_unique", with_inputs("service_txn agent", AGENT_SQL))
def join_agent_unique(spark, sf_dir):
    joined = lookup(
        load(spark, sf_dir, "service_txn"), load(spark, sf_dir, "agent"),
        F.col("wallet"), "wallet_id", {"bvn": "bvn", "nin": "nin", "address": "address"},
        unique=True,
    )
    return joined.select("txn_id", "wallet", "bvn", "nin", "address")


@register(
    "join_state_ci",
    with_inputs(
        "agent state_region",
        f"""SELECT wallet_id, {sql.state('state_of_residence')} AS agent_state, s.state AS state,
                   s.region AS region
            FROM agent LEFT JOIN state_region s
              ON upper({sql.state('state_of_residence')}) = upper(trim(s.state))""",
    ),
)
def join_state_ci(spark, sf_dir):
    agents = prepare_agent_states(load(spark, sf_dir, "agent")).select("wallet_id", "agent_state")
    return add_state_by_name(agents, load(spark, sf_dir, "state_region"))


@register(
    "join_state_region",
    with_inputs(
        "pos_txn registered state_region",
        f"""WITH terminal AS (
              SELECT {sql.clean('terminal_id')} AS terminal_id, min(state) AS state_initials
              FROM registered GROUP BY 1)
            SELECT retrieval_ref, t.terminal_id AS terminal_id, r.state_initials AS state_initials,
                   s.state AS state, s.region AS region
            FROM (SELECT retrieval_ref, {sql.clean('terminal_id')} AS terminal_id FROM pos_txn) t
            LEFT JOIN terminal r ON t.terminal_id = r.terminal_id
            LEFT JOIN state_region s ON r.state_initials = s.state_initials""",
    ),
)
def join_state_region(spark, sf_dir):
    txns = load(spark, sf_dir, "pos_txn").select(
        "retrieval_ref", clean_terminal_id(F.col("terminal_id")).alias("terminal_id")
    )
    terminals = prepare_roster(load(spark, sf_dir, "registered"))
    return add_state_region(txns, terminals, load(spark, sf_dir, "state_region"))


@register(
    "join_bank",
    with_inputs(
        "pos_txn bank_code",
        f"""SELECT retrieval_ref, terminal_id, b.bank AS bank
            FROM pos_txn LEFT JOIN bank_code b ON {sql.prefix('terminal_id')} = b.bank_code""",
    ),
)
def join_bank(spark, sf_dir):
    txns = load(spark, sf_dir, "pos_txn").select("retrieval_ref", "terminal_id")
    return add_bank(txns, load(spark, sf_dir, "bank_code"))


@register(
    "join_device",
    with_inputs(
        "journal terminal_device",
        f"""SELECT _id, j.terminal_id AS terminal_id, d.trm_serialno AS serial_number,
                   d.trm_model AS terminal_model
            FROM (SELECT _id, {sql.clean('terminalId', 9)} AS terminal_id FROM journal) j
            LEFT JOIN (SELECT {sql.clean('trm_termid', 9)} AS id, * FROM terminal_device) d
              ON j.terminal_id = d.id""",
    ),
)
def join_device(spark, sf_dir):
    journal = load(spark, sf_dir, "journal").select(
        "_id", clean_terminal_id(F.col("terminalId"), ACTIVITY_WIDTH).alias("terminal_id")
    )
    return add_device(
        journal, prepare_devices(load(spark, sf_dir, "terminal_device")),
        {"serial_number": "trm_serialno", "terminal_model": "trm_model"},
    )


def membership_sql(flag: str) -> str:
    ids = f"SELECT {sql.normalise('terminal_id')} FROM {flag}"
    return f"CASE WHEN r.terminal_id IN ({ids}) THEN 1 ELSE 0 END AS {flag}"


MEMBERSHIP_SQL = with_inputs(
    "registered connected active inactive",
    f"""SELECT terminal_id, merchant_name, {membership_sql('connected')},
               {membership_sql('active')}, {membership_sql('inactive')}
        FROM (SELECT {sql.normalise('terminal_id')} AS terminal_id, merchant_name FROM registered) r""",
)


def flagged(spark, sf_dir, out, join):
    for flag in ("connected", "active", "inactive"):
        out = flag_membership(out, normalised(spark, sf_dir, flag), flag, join=join)
    return out


@register("join_membership_flags", MEMBERSHIP_SQL)
def join_membership_flags(spark, sf_dir):
    terminals = normalised(spark, sf_dir, "registered").select("terminal_id", "merchant_name")
    return flagged(spark, sf_dir, terminals, lookup)


@register("join_membership_flags_once", MEMBERSHIP_SQL)
def join_membership_flags_once(spark, sf_dir):
    """All flags from one join."""
    terminals = normalised(spark, sf_dir, "registered").select("terminal_id", "merchant_name")
    sets = {name: normalised(spark, sf_dir, name) for name in ("connected", "active", "inactive")}
    return flag_memberships(terminals, sets)


@register("join_membership_flags_salted", MEMBERSHIP_SQL)
def join_membership_flags_salted(spark, sf_dir):
    terminals = normalised(spark, sf_dir, "registered").select("terminal_id", "merchant_name")
    hot = heavy_keys(terminals, F.col("terminal_id"))
    return flagged(spark, sf_dir, terminals, partial(salted_lookup, hot=hot))


@register(
    "join_last_activity",
    with_inputs(
        "registered journal",
        f"""WITH last AS (
              SELECT {sql.normalise('terminalId')} AS terminal_id, max(updatedAt) AS t
              FROM journal GROUP BY 1)
            SELECT r.terminal_id AS terminal_id, merchant_name, t AS last_transaction_time
            FROM (SELECT {sql.normalise('terminal_id')} AS terminal_id, merchant_name FROM registered) r
            LEFT JOIN last ON r.terminal_id = last.terminal_id""",
    ),
)
def join_last_activity(spark, sf_dir):
    registered = normalised(spark, sf_dir, "registered").select("terminal_id", "merchant_name")
    activity = recent_activity(load(spark, sf_dir, "journal"), datetime(2024, 2, 1))
    return add_last_activity(registered, activity)


@register(
    "join_anti",
    with_inputs(
        "roster_target registered",
        f"""SELECT {sql.normalise('terminal_id')} AS terminal_id, state_initials FROM roster_target t
            WHERE NOT EXISTS (SELECT 1 FROM registered r
              WHERE {sql.normalise('r.terminal_id')} = {sql.normalise('t.terminal_id')})""",
    ),
)
def join_anti(spark, sf_dir):
    target = normalised(spark, sf_dir, "roster_target").select("terminal_id", "state_initials")
    return without_match(target, normalised(spark, sf_dir, "registered"), "terminal_id")


@register(
    "match_stats",
    with_inputs(
        "pos_txn bank_code",
        f"""SELECT count(b.bank) AS matched, count(*) - count(b.bank) AS unmatched
            FROM pos_txn LEFT JOIN bank_code b ON {sql.prefix('terminal_id')} = b.bank_code""",
    ),
)
def match_stats_query(spark, sf_dir):
    banked = add_bank(load(spark, sf_dir, "pos_txn"), load(spark, sf_dir, "bank_code"))
    return match_stats(banked, "bank")


