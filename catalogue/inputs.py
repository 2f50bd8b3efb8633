"""Operator inputs derived from the driver tables.

Each derivation is one SQL text in the subset Spark and DuckDB share.  ``{orders}`` and the
like name driver tables; Spark binds them to frames, the SQL checks to the tables
themselves.  Derivations keep every row of their tables, and make unmatched keys, nulls, damaged
ids and malformed amounts by rewriting values, but for these: ``connected`` and ``active`` hold
the orders of one status and priority, ``inactive`` the customers in debt, as a membership list
must leave some ids out, and ``journal_target`` the events before a day, as what is loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.terminals import clean_terminal_id, normalise_terminal_id

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")


def tid(k: str) -> str:
    """Terminal id in one of four raw shapes, from an integer expression."""
    return f"""CASE ({k}) % 4
  WHEN 0 THEN concat('2.0', lpad(concat('', ({k}) % 30), 2, '0'), lpad(concat('', {k}), 4, '0'), 'E+07')
  WHEN 1 THEN concat('0', lpad(concat('', {k}), 7, '0'))
  WHEN 2 THEN concat(' 20', lpad(concat('', ({k}) % 30), 2, '0'), ' ', lpad(concat('', {k}), 4, '0'))
  ELSE concat('20', lpad(concat('', ({k}) % 30), 2, '0'), 'AB', lpad(concat('', {k}), 4, '0')) END"""


INPUTS: dict[str, str] = {
    "service_txn": f"""
SELECT o_orderkey AS txn_id, concat('W', o_custkey) AS wallet, {tid('o_custkey')} AS terminal,
       o_orderpriority AS category,
       CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
            ELSE concat('', CAST(o_totalprice AS DECIMAL(18,2))) END AS amount,
       o_orderdate AS updated_at
FROM {{orders}}""",
    "agent": """
SELECT concat(CASE WHEN c_custkey % 7 = 0 THEN 'X' ELSE 'W' END, c_custkey) AS wallet_id,
       CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN NULL
            ELSE concat('B', c_custkey) END AS bvn,
       CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN concat('N', c_custkey) ELSE '0' END AS nin,
       CASE WHEN c_custkey % 6 = 0 THEN '0' ELSE concat('+', c_custkey) END AS phone_number,
       CASE WHEN c_custkey % 8 = 0 THEN '' ELSE c_name END AS address,
       c_acctbal > 0 AS is_active,
       CASE WHEN c_nationkey = 0 THEN ' Federal Capital Territory '
            ELSE concat(' ', lower(concat('NATION_', c_nationkey)), ' ') END AS state_of_residence
FROM {customer}""",
    "state_region": """
SELECT CASE WHEN n_nationkey = 0 THEN 'Abuja' WHEN n_nationkey < 23 THEN n_name
            ELSE concat('ELSEWHERE_', n_nationkey) END AS state,
       concat(CASE WHEN n_nationkey < 23 THEN 'S' ELSE 'T' END, n_nationkey) AS state_initials,
       r_name AS region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "pos_txn": f"""
SELECT concat(concat('', l_orderkey), '-', concat('', l_linenumber)) AS retrieval_ref,
       {tid('l_suppkey')} AS terminal_id, concat('M', l_suppkey) AS merchant_id,
       CASE WHEN l_suppkey % 9 = 0 THEN concat('NOVA ', l_suppkey)
            ELSE concat('SHOP ', l_suppkey) END AS merchant,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_shipdate AS date,
       CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESSFUL' END AS status
FROM {{lineitem}}""",
    "terminal_v1": """
SELECT CASE WHEN l_suppkey % 2 = 0
            THEN concat('2.0', lpad(concat('', l_suppkey % 30), 2, '0'), lpad(concat('', l_suppkey), 4, '0'))
            ELSE concat('20', lpad(concat('', l_suppkey % 30), 2, '0'), 'AB',
                        lpad(concat('', l_suppkey), 4, '0')) END AS terminal_id,
       concat('M', l_suppkey) AS merchant_id,
       CASE WHEN l_suppkey % 9 = 0 THEN concat('NOVA ', l_suppkey)
            ELSE concat('SHOP ', l_suppkey) END AS merchant,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_shipdate AS date
FROM {lineitem}""",
    "bank_code": """
SELECT concat('20', lpad(concat('', n_nationkey), 2, '0')) AS bank_code,
       concat('BANK_', n_nationkey) AS bank FROM {nation}
UNION ALL
SELECT concat('2.0', lpad(concat('', n_nationkey), 2, '0')), concat('BANK_', n_nationkey) FROM {nation}""",
    "journal": f"""
SELECT event_id AS _id,
       replace({tid('user_id')}, 'E+07', CASE WHEN event_id % 2 = 0 THEN 'E+07' ELSE 'E7' END) AS terminalId,
       CASE event_type WHEN 'purchase' THEN 'Purchase' WHEN 'signup' THEN 'VAS' ELSE 'Other' END
         AS transactionType,
       ts AS transactionTime, ts AS updatedAt,
       concat('', CAST(round(value * 100) AS BIGINT)) AS amount, concat(props, chr(0)) AS customData
FROM {{events}}""",
    "journal_target": """
SELECT event_id AS _id, ts AS transactiontime, event_type
FROM {events} WHERE ts < CAST('2024-01-20 00:00:00' AS TIMESTAMP)""",
    "terminal_device": f"""
SELECT {tid('s_suppkey')} AS trm_termid, concat('SN', s_suppkey) AS trm_serialno,
       CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS trm_model,
       s_nationkey AS trm_connectcount
FROM {{supplier}}""",
    "registered": f"""
SELECT {tid('c_custkey')} AS terminal_id, concat('S', c_nationkey) AS state, c_name AS merchant_name
FROM {{customer}}
UNION ALL
SELECT {tid('c_custkey')}, 'S9', concat(c_name, ' copy') FROM {{customer}}""",
    "connected": f"""
SELECT {tid('o_custkey')} AS terminal_id FROM {{orders}}
WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'""",
    "active": f"""
SELECT {tid('o_custkey')} AS terminal_id FROM {{orders}}
WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'""",
    "inactive": f"SELECT {tid('c_custkey')} AS terminal_id FROM {{customer}} WHERE c_acctbal < 0",
    "roster_target": f"""
SELECT CASE c_custkey % 3 WHEN 0 THEN concat('Z', c_custkey) ELSE {tid('c_custkey')} END AS terminal_id,
       concat('S', (c_nationkey + 1) % 25) AS state_initials,
       CASE c_custkey % 3 WHEN 0 THEN 'gone' ELSE 'old' END AS note
FROM {{customer}}
UNION ALL SELECT NULL, 'S1', 'nullkey' FROM {{region}}""",
    "merchant_doc": """
SELECT s_suppkey AS _id, concat('M', s_suppkey % 7) AS merchant_id,
       concat(s_name, chr(0)) AS merchantName, s_nationkey AS stateCode,
       CAST(s_acctbal AS DECIMAL(18,2)) AS balance
FROM {supplier}""",
    "settlement": f"""
SELECT concat('SHOP ', l_suppkey) AS Merchant, {tid('l_suppkey')} AS TerminalID,
       concat('M', l_suppkey) AS merchant_id,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS Amount, l_shipdate AS Date,
       CASE WHEN l_orderkey % 500 = 0 THEN NULL
            ELSE concat(concat('', l_orderkey), '-', concat('', l_linenumber)) END AS RetrievalReferenceNo,
       CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESSFUL' END AS Tran_Status,
       l_linestatus AS PTSP
FROM {{lineitem}}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    """A derivation over given frames, batch or streaming."""
    return spark.sql(INPUTS[name], **tables)


# Table folder -> folder holding its derived inputs, where ``store`` has written them.
_STORED: dict[str, str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input over the driver tables."""
    if sf_dir in _STORED:
        return spark.read.parquet(f"{_STORED[sf_dir]}/{name}")
    used = [t for t in TABLES if "{" + t + "}" in INPUTS[name]]
    return derive(spark, name, **{t: table(spark, sf_dir, t) for t in used})


def store(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write every derived input once, and let ``load`` read it as the stored table it is."""
    for name in INPUTS:
        load(spark, sf_dir, name).write.parquet(f"{path}/{name}")
    _STORED[sf_dir] = path


def normalised(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input with its terminal id normalised, as a sheet is read."""
    return load(spark, sf_dir, name).withColumn(
        "terminal_id", normalise_terminal_id(F.col("terminal_id"))
    )


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input with its terminal id cleaned, as the terminal table holds it."""
    return load(spark, sf_dir, name).withColumn(
        "terminal_id", clean_terminal_id(F.col("terminal_id"))
    )


def with_inputs(names: str, query: str) -> str:
    """SQL for the checker: ``query`` after the named derivations as CTEs."""
    plain = {t: t for t in TABLES}
    ctes = [f"{n} AS ({INPUTS[n].format(**plain).strip()})" for n in names.split()]
    if "WITH " == query.strip()[:5]:
        query = ", " + query.strip()[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + query.strip()


# The timestamp columns of every driver table carry no zone.
EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
ORDERS_SCHEMA = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
