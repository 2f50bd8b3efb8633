"""The reports end to end, for one period and over the whole history."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from tillbook import plans
from tillbook.operators.lookup import salted_lookup
from tillbook.plans.loads import PURCHASE_FIELDS, SERVICE_FIELDS
from tillbook.plans.settlement import FAILED_SHEET, LEFT_OUT, SKIPPED_FILES, SUCCESSFUL_SHEET
from tillbook.plans.settlement import HEADER as SETTLEMENT_HEADER
from tillbook.sources.buckets import write_bucketed
from tillbook.sources.documents import document_columns
from tillbook.sources.scans import read_csv, read_drop, read_sheets, read_typed_sheet
from tillbook.sources.sinks import shared_folder, write_csv, write_report

from . import sql
from .inputs import load, normalised, with_inputs
from .lookups import membership_sql
from .registry import register
from .rollups import (
    SETTLEMENT_ORDER,
    SETTLEMENT_ORDER_SQL,
    STATE_JOIN,
    STATE_VALUES,
    first_row_sql,
    summary_sql,
)
from .scans import MERCHANT_TYPES, MIXED_STATE, mixed_documents, write_sheet

WEEKLY_AS_OF = date(1998, 6, 10)
MONTHLY_AS_OF = date(1997, 2, 10)
DAILY_AS_OF = date(1996, 9, 26)
SUMMARY_MONTH = date(1998, 5, 15)
SERVICE_AS_OF = datetime(2024, 2, 1)
# 120 days before this cut through the events, all of January 2024.
ACTIVITY_AS_OF = datetime(2024, 5, 15)
ACTIVITY_WINDOW = "transactionTime BETWEEN TIMESTAMP '2024-01-16' AND TIMESTAMP '2024-05-15'"


def weekly_sql(where: str, report_date: str) -> str:
    return with_inputs(
        "service_txn agent",
        f"""
WITH daily AS (
  SELECT wallet, terminal, category, CAST(updated_at AS DATE) AS day, count(*) AS volume,
         CAST(sum({sql.amount('amount')}) AS DECIMAL(38,2)) AS value, max(updated_at) AS updated_at
  FROM service_txn WHERE {where} GROUP BY 1, 2, 3, 4)
SELECT wallet, updated_at, category, terminal,
       CASE WHEN NOT {sql.empty('a.bvn')} THEN a.bvn WHEN NOT {sql.empty('a.nin')} THEN a.nin
            ELSE '' END AS bvn,
       CASE WHEN {sql.empty('a.phone_number')} THEN '' ELSE a.phone_number END AS phone_number,
       CASE WHEN {sql.empty('a.address')} THEN '' ELSE a.address END AS address,
       volume, value, {report_date} AS report_date
FROM daily LEFT JOIN agent a ON wallet = wallet_id""",
    )


@register(
    "report_weekly_agent_activity",
    weekly_sql(
        "updated_at >= TIMESTAMP '1998-06-01' AND updated_at < TIMESTAMP '1998-06-08'", "'1998-06-07'"
    ),
)
def report_weekly_agent_activity(spark, sf_dir):
    return plans.weekly_agent_activity(
        load(spark, sf_dir, "service_txn"), load(spark, sf_dir, "agent"), WEEKLY_AS_OF
    )


@register(
    "report_weekly_agent_activity_all",
    weekly_sql("true", "strftime(date_trunc('week', updated_at) + INTERVAL 6 DAY, '%Y-%m-%d')"),
)
def report_weekly_agent_activity_all(spark, sf_dir):
    return plans.weekly_agent_activity_history(
        load(spark, sf_dir, "service_txn"), load(spark, sf_dir, "agent")
    )


@register(
    "report_weekly_agent_activity_salted",
    weekly_sql("true", "strftime(date_trunc('week', updated_at) + INTERVAL 6 DAY, '%Y-%m-%d')"),
)
def report_weekly_agent_activity_salted(spark, sf_dir):
    return plans.weekly_agent_activity_history(
        load(spark, sf_dir, "service_txn"), load(spark, sf_dir, "agent"), join=salted_lookup
    )


@register(
    "report_monthly_state",
    with_inputs(
        "service_txn agent state_region",
        f"""SELECT s.state AS state, s.region AS region, {STATE_VALUES}, '1997-01-31' AS report_date
            {STATE_JOIN}
            WHERE t.updated_at >= TIMESTAMP '1997-01-01' AND t.updated_at < TIMESTAMP '1997-02-01'
            GROUP BY s.state, s.region""",
    ),
)
def report_monthly_state(spark, sf_dir):
    return plans.monthly_state(
        load(spark, sf_dir, "service_txn"), load(spark, sf_dir, "agent"),
        load(spark, sf_dir, "state_region"), MONTHLY_AS_OF,
    )


@register(
    "report_monthly_state_all",
    with_inputs(
        "service_txn agent state_region",
        f"""SELECT s.state AS state, s.region AS region, {STATE_VALUES},
                   strftime(last_day(t.updated_at), '%Y-%m-%d') AS report_date
            {STATE_JOIN}
            GROUP BY s.state, s.region, strftime(last_day(t.updated_at), '%Y-%m-%d')""",
    ),
)
def report_monthly_state_all(spark, sf_dir):
    return plans.monthly_state_history(
        load(spark, sf_dir, "service_txn"), load(spark, sf_dir, "agent"),
        load(spark, sf_dir, "state_region"),
    )


TERMINAL_SQL = f"""
, source AS (SELECT {sql.clean('terminal_id')} AS terminal_id, min(state) AS state_initials
             FROM registered GROUP BY 1),
terminals AS (
  SELECT coalesce(t.terminal_id, s.terminal_id) AS terminal_id,
         CASE WHEN s.terminal_id IS NOT NULL THEN s.state_initials ELSE t.state_initials END AS state_initials
  FROM roster_target t FULL JOIN source s ON t.terminal_id = s.terminal_id)
"""


def daily_sql(where: str, key: str = "", of: str = "") -> str:
    keys = f", {key}" if key else ""
    return with_inputs(
        "pos_txn registered roster_target bank_code state_region",
        summary_sql("pos_txn", sql.clean("terminal_id"), "0.0013", 4, where, key, of)
        + TERMINAL_SQL
        + f"""
SELECT y.terminal_id AS terminal_id, volume, value, msc, merchant_id, merchant, date{keys},
       CASE WHEN starts_with(merchant, 'NOVA') THEN 'NOVA BANK' ELSE b.bank END AS bank,
       s.state AS state, s.region AS region
FROM summary y
LEFT JOIN bank_code b ON {sql.prefix('y.terminal_id')} = b.bank_code
LEFT JOIN terminals t ON y.terminal_id = t.terminal_id
LEFT JOIN state_region s ON t.state_initials = s.state_initials""",
    )


def daily_inputs(spark, sf_dir):
    names = ("pos_txn", "registered", "roster_target", "bank_code", "state_region")
    return [load(spark, sf_dir, name) for name in names]


@register("report_daily_terminal", daily_sql("CAST(date AS DATE) = DATE '1996-09-23'"))
def report_daily_terminal(spark, sf_dir):
    return plans.daily_terminal(*daily_inputs(spark, sf_dir), as_of=DAILY_AS_OF, lag=3)


@register("report_daily_terminal_all", daily_sql("true", "day", "CAST(date AS DATE)"))
def report_daily_terminal_all(spark, sf_dir):
    return plans.daily_terminal_history(*daily_inputs(spark, sf_dir))


@register(
    "report_monthly_terminal",
    with_inputs(
        "terminal_v1 bank_code",
        summary_sql(
            "terminal_v1", sql.rounded("terminal_id"), "0.00125", 6,
            "date >= TIMESTAMP '1998-05-01' AND date < TIMESTAMP '1998-06-01'",
        )
        + """SELECT terminal_id, volume, value AS amount, msc, merchant_id, merchant AS merchant_name,
                    date, b.bank AS bank
             FROM summary LEFT JOIN bank_code b ON substr(terminal_id, 1, 5) = b.bank_code""",
    ),
)
def report_monthly_terminal(spark, sf_dir):
    return plans.monthly_terminal(
        load(spark, sf_dir, "terminal_v1"), load(spark, sf_dir, "bank_code"), SUMMARY_MONTH
    )


@register(
    "report_monthly_terminal_all",
    with_inputs(
        "terminal_v1 bank_code",
        summary_sql(
            "terminal_v1", sql.rounded("terminal_id"), "0.00125", 6,
            key="month", of="CAST(date_trunc('month', date) AS DATE)",
        )
        + """SELECT month, terminal_id, volume, value AS amount, msc, merchant_id,
                    merchant AS merchant_name, date, b.bank AS bank
             FROM summary LEFT JOIN bank_code b ON substr(terminal_id, 1, 5) = b.bank_code""",
    ),
)
def report_monthly_terminal_all(spark, sf_dir):
    return plans.monthly_terminal_history(
        load(spark, sf_dir, "terminal_v1"), load(spark, sf_dir, "bank_code")
    )


# Roster


ROSTER_SQL = f"""
WITH reg AS (
  SELECT {sql.normalise('terminal_id')} AS terminal_id, state, merchant_name FROM registered),
one AS (
  SELECT terminal_id, state, merchant_name FROM (
    SELECT *, row_number() OVER (PARTITION BY terminal_id ORDER BY merchant_name, state) AS rn FROM reg)
  WHERE rn = 1),
last AS (
  SELECT {sql.normalise('terminalId')} AS terminal_id, max(updatedAt) AS t FROM journal
  WHERE {ACTIVITY_WINDOW} GROUP BY 1),
roster AS (
  SELECT r.terminal_id AS terminal_id, state, merchant_name, {membership_sql('connected')},
         {membership_sql('active')}, {membership_sql('inactive')}, t AS last_transaction_time
  FROM one r LEFT JOIN last ON r.terminal_id = last.terminal_id)
"""
ROSTER_INPUTS = "registered connected active inactive journal"


def roster(spark, sf_dir):
    sheets = [normalised(spark, sf_dir, n) for n in ("registered", "connected", "active", "inactive")]
    return plans.terminal_roster(
        *sheets,
        plans.recent_activity(load(spark, sf_dir, "journal"), ACTIVITY_AS_OF),
        order=["merchant_name", "state"],
    )


@register("report_roster", with_inputs(ROSTER_INPUTS, ROSTER_SQL + "SELECT * FROM roster"))
def report_roster(spark, sf_dir):
    return roster(spark, sf_dir)


@register("report_roster_bucketed", with_inputs(ROSTER_INPUTS, ROSTER_SQL + "SELECT * FROM roster"))
def report_roster_bucketed(spark, sf_dir):
    """The roster from catalog tables bucketed by terminal: no input is shuffled."""
    names = ("registered", "connected", "active", "inactive", "activity")
    activity = plans.recent_activity(load(spark, sf_dir, "journal"), ACTIVITY_AS_OF)
    tables = {}
    for name in names:
        tables[name] = f"{name}_{uuid.uuid4().hex}"
        rows = activity if name == "activity" else normalised(spark, sf_dir, name)
        write_bucketed(rows, tables[name], "terminal_id", 16, shared_folder(spark, name))
    return plans.terminal_roster(
        *[spark.table(tables[name]) for name in names], order=["merchant_name", "state"]
    )


@register("report_roster_sheets", with_inputs(ROSTER_INPUTS, ROSTER_SQL + "SELECT * FROM roster"))
def report_roster_sheets(spark, sf_dir):
    """The roster from the four sheets of its workbooks."""
    root = shared_folder(spark, "roster-books")
    names = ("registered", "connected", "active", "inactive")
    for name in names:
        write_sheet(load(spark, sf_dir, name), root, name, F.lit("book"))
    return plans.terminal_roster(
        *[read_sheets(spark, root, name) for name in names],
        plans.recent_activity(load(spark, sf_dir, "journal"), ACTIVITY_AS_OF),
        order=["merchant_name", "state"],
    )


@register(
    "report_roster_sync",
    with_inputs(
        ROSTER_INPUTS + " roster_target",
        ROSTER_SQL
        + f"""SELECT r.*, t.note AS note
              FROM roster r LEFT JOIN (
                SELECT {sql.normalise('terminal_id')} AS terminal_id, note FROM roster_target) t
                ON r.terminal_id = t.terminal_id""",
    ),
)
def report_roster_sync(spark, sf_dir):
    """Every loaded row of a terminal that the roster still has stays."""
    new = roster(spark, sf_dir)
    loaded = normalised(spark, sf_dir, "roster_target").withColumnsRenamed({"state_initials": "state"})
    missing = {f.name: F.lit(None).cast(f.dataType) for f in new.schema.fields if f.name not in loaded.columns}
    return plans.sync_roster(loaded.withColumns(missing), new)


@register(
    "report_terminal_activity",
    with_inputs(
        "journal terminal_device bank_code",
        f"""
WITH last AS (
  SELECT {sql.clean('terminalId', 9)} AS terminal_id, max(transactionTime) AS last_transaction_time,
         max(updatedAt) AS last_connect_date
  FROM journal WHERE transactionType = 'Purchase' GROUP BY 1),
device AS (SELECT {sql.clean('trm_termid', 9)} AS id, * FROM terminal_device)
SELECT terminal_id, last_transaction_time, last_connect_date, trm_serialno AS serial_number,
       trm_model AS terminal_model, trm_connectcount AS connect_count, bank AS bank_name
FROM last LEFT JOIN device ON terminal_id = id
LEFT JOIN bank_code b ON {sql.prefix('terminal_id')} = b.bank_code""",
    ),
)
def report_terminal_activity(spark, sf_dir):
    return plans.terminal_activity(
        load(spark, sf_dir, "journal"), load(spark, sf_dir, "terminal_device"),
        load(spark, sf_dir, "bank_code"),
    )


PER_JOURNAL_SQL = with_inputs(
    "journal terminal_device bank_code",
    f"""
WITH last AS (
  SELECT {sql.clean('terminalId', 9)} AS terminal_id, {sql.quarter_span('transactionTime')} AS journal,
         max(transactionTime) AS last_transaction_time, max(updatedAt) AS last_connect_date
  FROM journal WHERE transactionType = 'Purchase' GROUP BY 1, 2),
device AS (SELECT {sql.clean('trm_termid', 9)} AS id, * FROM terminal_device)
SELECT journal, terminal_id, last_transaction_time, last_connect_date, trm_serialno AS serial_number,
       trm_model AS terminal_model, trm_connectcount AS connect_count, bank AS bank_name
FROM last LEFT JOIN device ON terminal_id = id
LEFT JOIN bank_code b ON {sql.prefix('terminal_id')} = b.bank_code""",
)


@register("report_terminal_activity_per_journal", PER_JOURNAL_SQL)
def report_terminal_activity_per_journal(spark, sf_dir):
    return plans.terminal_activity(
        load(spark, sf_dir, "journal"), load(spark, sf_dir, "terminal_device"),
        load(spark, sf_dir, "bank_code"), per_journal=True,
    )


@register("report_terminal_activity_written", PER_JOURNAL_SQL)
def report_terminal_activity_written(spark, sf_dir):
    """Activity in one partition per quarter; a rerun replaces the quarters it covers."""
    path = shared_folder(spark, "activity")
    for _ in range(2):
        rows = report_terminal_activity_per_journal(spark, sf_dir)
        write_report(rows, path, mode="overwrite_partitions", partition_by=["journal"])
    return spark.read.parquet(path)


@register(
    "report_settlement_clean",
    with_inputs(
        "settlement",
        first_row_sql(
            "settlement", "RetrievalReferenceNo", SETTLEMENT_ORDER_SQL,
            "Merchant, TerminalID, merchant_id, Amount, Date, RetrievalReferenceNo",
        ),
    ),
)
def report_settlement_clean(spark, sf_dir):
    rows = load(spark, sf_dir, "settlement")
    parts = [rows.where("Tran_Status = 'FAILED'"), rows.where("Tran_Status <> 'FAILED'")]
    return plans.clean_settlement(parts, SETTLEMENT_ORDER, header=None, left_out=LEFT_OUT)


SETTLEMENT_COLUMNS = ["Merchant", "TerminalID", "merchant_id", "Amount", "Date", "RetrievalReferenceNo"]


@register(
    "report_settlement_files",
    with_inputs(
        "settlement",
        first_row_sql(
            "settlement", "RetrievalReferenceNo", SETTLEMENT_ORDER_SQL, ", ".join(SETTLEMENT_COLUMNS)
        ),
    ),
)
def report_settlement_files(spark, sf_dir):
    """Two sheets and a drop folder, with headers of their own, to one clean CSV."""
    rows = load(spark, sf_dir, "settlement")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    laid = rows.select(
        *[F.col(n) if n in kinds else F.lit("-").alias(n) for n in SETTLEMENT_HEADER]
    )
    layout = ", ".join(f"`{n}` {kinds.get(n, 'string')}" for n in SETTLEMENT_HEADER)
    root = shared_folder(spark, "settlement")
    failed, late = F.col("Tran_Status") == "FAILED", F.col("PTSP") == "O"
    write_sheet(laid.where(failed), f"{root}/books", FAILED_SHEET, F.lit("book"))
    write_sheet(laid.where(~failed & ~late), f"{root}/books", SUCCESSFUL_SHEET, F.lit("book"))
    other = laid.where(~failed & late).toDF(*[f"column {i}" for i in range(len(SETTLEMENT_HEADER))])
    write_csv(other, f"{root}/drop")
    parts = [
        read_typed_sheet(spark, f"{root}/books", sheet, schema=layout, positional=True)
        for sheet in (FAILED_SHEET, SUCCESSFUL_SHEET)
    ]
    parts.append(
        read_drop(spark, f"{root}/drop", skip=SKIPPED_FILES, schema=layout, positional=True)
    )
    write_csv(plans.clean_settlement(parts, SETTLEMENT_ORDER), f"{root}/clean")
    clean = ", ".join(f"`{n}` {kinds.get(n, 'string')}" for n in SETTLEMENT_HEADER if n not in LEFT_OUT)
    return read_csv(spark, f"{root}/clean", schema=clean).select(*SETTLEMENT_COLUMNS)


JOURNAL_COLUMNS = {
    "_id": "_id", "terminalId": "terminalId", "transactionTime": "transactionTime",
    "updatedAt": "updatedAt", "amount": sql.major("amount"),
    "customData": "replace(customData, chr(0), '')",
}


def loaded_sql(fields, more: str = "") -> str:
    """Every declared field of the journal; those it lacks are null text."""
    listed = [f"{JOURNAL_COLUMNS.get(f, 'CAST(NULL AS VARCHAR)')} AS {f.lower()}" for f in fields]
    return f"SELECT {', '.join(listed)}{more} FROM journal"


@register(
    "report_purchase_increment",
    with_inputs(
        "journal journal_target",
        loaded_sql(PURCHASE_FIELDS)
        + """ WHERE transactionType = 'Purchase'
              AND _id > (SELECT max(_id) FROM journal_target WHERE event_type = 'purchase')""",
    ),
)
def report_purchase_increment(spark, sf_dir):
    loaded = load(spark, sf_dir, "journal_target").where("event_type = 'purchase'")
    return plans.purchase_increment(load(spark, sf_dir, "journal"), loaded)


@register(
    "report_purchase_load",
    with_inputs(
        "journal journal_target",
        loaded_sql(
            PURCHASE_FIELDS,
            ", concat('purchases_', strftime(date_trunc('quarter', transactionTime), '%y_%m')) AS target",
        )
        + """ WHERE transactionType = 'Purchase'
              AND _id > (SELECT max(_id) FROM journal_target WHERE event_type = 'purchase')""",
    ),
)
def report_purchase_load(spark, sf_dir):
    """The increment appended to the tables of its quarters, then read back."""
    path = shared_folder(spark, "purchases")
    new = plans.routed(report_purchase_increment(spark, sf_dir))
    write_report(new, path, partition_by=["target"])
    return spark.read.parquet(path)


@register(
    "report_vas_increment",
    with_inputs(
        "journal journal_target",
        loaded_sql(SERVICE_FIELDS)
        + """ WHERE transactionType = 'VAS' AND transactionTime <= TIMESTAMP '2024-02-01'
              AND transactionTime >= (SELECT max(transactiontime) FROM journal_target WHERE event_type = 'signup')
              AND _id NOT IN (SELECT _id FROM journal_target WHERE event_type = 'signup')""",
    ),
)
def report_vas_increment(spark, sf_dir):
    loaded = load(spark, sf_dir, "journal_target").where("event_type = 'signup'")
    return plans.service_increment(load(spark, sf_dir, "journal"), loaded, SERVICE_AS_OF)


@register(
    "report_merchants",
    with_inputs(
        "merchant_doc",
        """SELECT merchant_id, replace(merchantName, chr(0), '') AS merchantname,
                  CAST(stateCode AS VARCHAR) AS statecode, CAST(balance AS VARCHAR) AS balance
           FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id
                                              ORDER BY CAST(_id AS VARCHAR)) AS rn FROM merchant_doc)
           WHERE rn = 1""",
    ),
)
def report_merchants(spark, sf_dir):
    return plans.merchant_dimension(load(spark, sf_dir, "merchant_doc"), ["_id"])


@register(
    "report_merchants_documents",
    with_inputs(
        "merchant_doc",
        f"""SELECT merchant_id, replace(merchantName, chr(0), '') AS merchantname,
                   {MIXED_STATE} AS statecode, CAST(balance AS VARCHAR) AS balance
            FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id
                                               ORDER BY CAST(_id AS VARCHAR)) AS rn FROM merchant_doc)
            WHERE rn = 1""",
    ),
)
def report_merchants_documents(spark, sf_dir):
    """Merchants from documents of mixed types, read once."""
    return plans.merchant_dimension(document_columns(mixed_documents(spark, sf_dir), MERCHANT_TYPES), ["_id"])


@register("report_agent_snapshot", with_inputs("agent", "SELECT * FROM agent"))
def report_agent_snapshot(spark, sf_dir):
    path = shared_folder(spark, "agents")
    write_report(plans.agent_snapshot(load(spark, sf_dir, "agent")), path, mode="overwrite")
    return spark.read.parquet(path)
