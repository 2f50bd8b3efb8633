"""Aggregations, deduplication, order and limits over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillbook.functions.money import DAILY_RATE_SCALE, MONTHLY_RATE_SCALE, parse_amount
from tillbook.functions.terminals import clean_terminal_id, round_terminal_id
from tillbook.operators.dedup import dedup, dedup_if_present, latest_per_key, union_distinct_rows
from tillbook.operators.lookup import add_agent
from tillbook.operators.rollups import (
    count_rows,
    daily_activity,
    distinct_ids,
    first_page,
    key_bounds,
    last_activity,
    most_recent,
    terminal_summary,
    top_recent,
    wallet_totals,
)
from tillbook.plans.activity import purchase_activity
from tillbook.plans.agents import rollup_states
from tillbook.plans.roster import prepare_roster
from tillbook.sources.columns import lower_columns, strip_nul

from . import sql
from .inputs import load, with_inputs
from .registry import register


def parsed_service(spark, sf_dir):
    txns = load(spark, sf_dir, "service_txn")
    return txns.withColumn("amount", parse_amount(F.col("amount")))


@register(
    "agg_daily_activity",
    with_inputs(
        "service_txn",
        f"""SELECT wallet, terminal, category, CAST(updated_at AS DATE) AS day, count(*) AS volume,
                   CAST(sum({sql.amount('amount')}) AS DECIMAL(38,2)) AS value,
                   max(updated_at) AS updated_at
            FROM service_txn GROUP BY wallet, terminal, category, CAST(updated_at AS DATE)""",
    ),
)
def agg_daily_activity(spark, sf_dir):
    return daily_activity(parsed_service(spark, sf_dir))


def summary_sql(
    source: str, tid: str, rate: str, scale: int, where: str = "true", key: str = "", of: str = ""
) -> str:
    """Row-wise restatement of the terminal summary, with a further key ``key`` made ``of`` the row."""
    keys = f", {key}" if key else ""
    made = f", {of} AS {key}" if key else ""
    return f"""
WITH src AS (
  SELECT {tid} AS terminal_id{made}, amount,
         amount * CAST({rate} AS DECIMAL(10,{scale})) AS fee, merchant_id, merchant, date
  FROM {source} WHERE {where}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY terminal_id{keys}
    ORDER BY date NULLS LAST, merchant_id NULLS LAST, merchant NULLS LAST) AS rn FROM src),
summary AS (
  SELECT terminal_id{keys}, count(terminal_id) AS volume, CAST(sum(amount) AS DECIMAL(38,2)) AS value,
         CAST(sum(fee) AS DECIMAL(38,{scale + 2})) AS msc,
         max(CASE WHEN rn = 1 THEN merchant_id END) AS merchant_id,
         max(CASE WHEN rn = 1 THEN merchant END) AS merchant,
         max(CASE WHEN rn = 1 THEN date END) AS date
  FROM ranked GROUP BY terminal_id{keys})
"""


@register(
    "agg_terminal",
    with_inputs(
        "pos_txn",
        summary_sql("pos_txn", sql.clean("terminal_id"), "0.0013", 4) + "SELECT * FROM summary",
    ),
)
def agg_terminal(spark, sf_dir):
    txns = load(spark, sf_dir, "pos_txn").withColumn(
        "terminal_id", clean_terminal_id(F.col("terminal_id"))
    )
    return terminal_summary(txns, rate_scale=DAILY_RATE_SCALE)


@register(
    "agg_terminal_v1",
    with_inputs(
        "terminal_v1",
        summary_sql("terminal_v1", sql.rounded("terminal_id"), "0.00125", 6) + "SELECT * FROM summary",
    ),
)
def agg_terminal_v1(spark, sf_dir):
    txns = load(spark, sf_dir, "terminal_v1").withColumn(
        "terminal_id", round_terminal_id(F.col("terminal_id"))
    )
    return terminal_summary(txns, rate_scale=MONTHLY_RATE_SCALE)


STATE_JOIN = f"""
FROM service_txn t
LEFT JOIN agent a ON t.wallet = a.wallet_id
LEFT JOIN state_region s ON upper({sql.state('a.state_of_residence')}) = upper(trim(s.state))"""
STATE_VALUES = f"""count(*) AS volume_of_transactions,
       CAST(sum({sql.amount('t.amount')}) AS DECIMAL(38,2)) AS total_transaction_value,
       count(DISTINCT t.wallet) AS unique_wallets"""


@register(
    "agg_state",
    with_inputs(
        "service_txn agent state_region",
        f"""SELECT s.state AS state, s.region AS region, {STATE_VALUES}
            {STATE_JOIN} GROUP BY s.state, s.region""",
    ),
)
def agg_state(spark, sf_dir):
    return rollup_states(
        wallet_totals(parsed_service(spark, sf_dir)),
        load(spark, sf_dir, "agent"),
        load(spark, sf_dir, "state_region"),
    )


@register(
    "agg_last_activity",
    with_inputs(
        "journal",
        f"""SELECT {sql.clean('terminalId', 9)} AS terminal_id,
                   max(transactionTime) AS last_transaction_time, max(updatedAt) AS last_connect_date
            FROM journal WHERE transactionType = 'Purchase' GROUP BY 1""",
    ),
)
def agg_last_activity(spark, sf_dir):
    return last_activity(purchase_activity(load(spark, sf_dir, "journal")))


@register(
    "agg_key_bounds",
    with_inputs(
        "journal",
        """SELECT min(_id) AS min_key, max(_id) AS max_key FROM journal
           WHERE transactionType = 'Purchase'""",
    ),
)
def agg_key_bounds(spark, sf_dir):
    return key_bounds(load(spark, sf_dir, "journal").where("transactionType = 'Purchase'"), "_id")


@register(
    "distinct_ids",
    with_inputs("pos_txn", "SELECT DISTINCT terminal_id FROM pos_txn"),
)
def distinct_ids_query(spark, sf_dir):
    return distinct_ids(load(spark, sf_dir, "pos_txn"), "terminal_id")


@register(
    "stage_counts",
    with_inputs(
        "service_txn agent",
        f"""SELECT 'extracted' AS stage, count(*) AS row_count FROM service_txn
            UNION ALL SELECT 'parsed', count(*) FROM service_txn WHERE {sql.amount('amount')} IS NOT NULL
            UNION ALL SELECT 'enriched', count(*) FROM service_txn LEFT JOIN agent ON wallet = wallet_id
              WHERE {sql.amount('amount')} IS NOT NULL""",
    ),
)
def stage_counts(spark, sf_dir):
    rows, extracted = count_rows(parsed_service(spark, sf_dir), "extracted")
    rows, parsed = count_rows(rows.where(F.col("amount").isNotNull()), "parsed")
    rows = add_agent(rows, load(spark, sf_dir, "agent"), {"bvn": "bvn"})
    rows, enriched = count_rows(rows, "enriched")
    rows.write.format("noop").mode("overwrite").save()
    counts = [
        (name, seen.get["rows"])
        for name, seen in (("extracted", extracted), ("parsed", parsed), ("enriched", enriched))
    ]
    return spark.createDataFrame(counts, "stage STRING, row_count BIGINT")


# Deduplication


def first_row_sql(source: str, key: str, order: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (
                 SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source})
               WHERE rn = 1"""


SETTLEMENT_ORDER = ["Tran_Status", "Amount", "Date", "Merchant"]
SETTLEMENT_ORDER_SQL = (
    "Tran_Status NULLS FIRST, Amount NULLS FIRST, Date NULLS FIRST, Merchant NULLS FIRST, "
    "TerminalID NULLS FIRST, merchant_id NULLS FIRST, PTSP NULLS FIRST"
)
SETTLEMENT_COLUMNS = (
    "Merchant, TerminalID, merchant_id, Amount, Date, RetrievalReferenceNo, Tran_Status, PTSP"
)


@register(
    "dedup_reference",
    with_inputs(
        "settlement",
        first_row_sql(
            "settlement", "RetrievalReferenceNo", SETTLEMENT_ORDER_SQL, SETTLEMENT_COLUMNS
        ),
    ),
)
def dedup_reference(spark, sf_dir):
    rows = load(spark, sf_dir, "settlement")
    return dedup(rows, ["RetrievalReferenceNo"], SETTLEMENT_ORDER)


@register(
    "dedup_union_reference",
    with_inputs(
        "settlement",
        first_row_sql(
            "settlement", "RetrievalReferenceNo", SETTLEMENT_ORDER_SQL, SETTLEMENT_COLUMNS
        ),
    ),
)
def dedup_union_reference(spark, sf_dir):
    rows = load(spark, sf_dir, "settlement")
    parts = [rows.where("Tran_Status = 'FAILED'"), rows.where("Tran_Status <> 'FAILED'")]
    return union_distinct_rows(parts, ["RetrievalReferenceNo"], SETTLEMENT_ORDER)


@register(
    "dedup_latest_activity",
    with_inputs(
        "journal",
        f"""SELECT {sql.clean('terminalId')} AS terminal_id, max(updatedAt) AS last_transaction_time
            FROM journal GROUP BY 1""",
    ),
)
def dedup_latest_activity(spark, sf_dir):
    journal = load(spark, sf_dir, "journal").select(
        clean_terminal_id(F.col("terminalId")).alias("terminal_id"),
        F.col("updatedAt").alias("last_transaction_time"),
    )
    return latest_per_key(journal, "terminal_id", "last_transaction_time")


@register(
    "roster_prepare",
    with_inputs(
        "registered",
        f"""SELECT {sql.clean('terminal_id')} AS terminal_id, min(state) AS state_initials
            FROM registered GROUP BY 1""",
    ),
)
def roster_prepare(spark, sf_dir):
    return prepare_roster(load(spark, sf_dir, "registered"))


@register(
    "dedup_merchant",
    with_inputs(
        "merchant_doc",
        first_row_sql(
            "merchant_doc", "merchant_id", "_id",
            "_id, merchant_id, replace(merchantName, chr(0), '') AS merchantname, "
            "stateCode AS statecode, balance",
        ),
    ),
)
def dedup_merchant(spark, sf_dir):
    documents = strip_nul(lower_columns(load(spark, sf_dir, "merchant_doc")))
    return dedup_if_present(documents, "merchant_id", ["_id"])


# Order and limits


@register(
    "sort_recent",
    with_inputs(
        "journal",
        f"""SELECT {sql.clean('terminalId')} AS terminal_id, max(updatedAt) AS last_transaction_time
            FROM journal GROUP BY 1 ORDER BY 2 DESC, 1""",
    ),
)
def sort_recent(spark, sf_dir):
    return most_recent(dedup_latest_activity(spark, sf_dir), "last_transaction_time", "terminal_id")


@register(
    "topk_recent",
    with_inputs(
        "journal",
        """SELECT _id, terminalId AS terminal_id, transactionTime AS transaction_time FROM journal
           ORDER BY transactionTime DESC, _id LIMIT 25""",
    ),
)
def topk_recent(spark, sf_dir):
    journal = load(spark, sf_dir, "journal").select(
        "_id", F.col("terminalId").alias("terminal_id"),
        F.col("transactionTime").alias("transaction_time"),
    )
    return top_recent(journal, "transaction_time", 25, "_id")


@register(
    "page_by_key",
    with_inputs(
        "journal",
        """SELECT _id, terminalId AS terminal_id FROM journal
           WHERE transactionType = 'Purchase' AND _id > 100 ORDER BY _id LIMIT 50""",
    ),
)
def page_by_key(spark, sf_dir):
    journal = load(spark, sf_dir, "journal").where("transactionType = 'Purchase'")
    return first_page(
        journal.select("_id", F.col("terminalId").alias("terminal_id")), "_id", 50, after=100
    )
