"""Scans, header rules, projections and filters."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.periods import (
    Period,
    lagged_day,
    month_key,
    ordinal_suffix,
    previous_month,
    previous_week,
    quarter_span_key,
    quarter_start_key,
    quarters_between,
    trailing_days,
)
from tillbook.operators.dedup import union_all
from tillbook.plans.settlement import FAILED_SHEET, SUCCESSFUL_SHEET
from tillbook.sources.columns import (
    add_constants,
    all_to_string,
    conform_header,
    drop_columns,
    lower_columns,
    rename_positional,
    snake_columns,
)
from tillbook.sources.documents import document_columns, read_documents
from tillbook.sources.pages import read_page, write_pages
from tillbook.sources.scans import (
    for_day,
    read_csv,
    read_drop,
    read_sheets,
    read_table,
    read_typed_sheet,
    scan,
)
from tillbook.sources.sinks import shared_folder, write_csv
from tillbook.streaming.loads import appended_rows, drop_stream, write_batches

from . import sql
from .inputs import load, table, with_inputs
from .registry import register

WEEK = Period(datetime(1998, 6, 1), datetime(1998, 6, 8))
SHEET_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_sheet(df, root: str, sheet: str, workbook) -> None:
    """Lay a frame out as one CSV sheet per workbook."""
    (
        df.withColumns({"workbook": workbook, "sheet": F.lit(sheet)})
        .write.mode("append").options(**SHEET_OPTIONS).partitionBy("workbook", "sheet").csv(root)
    )


@register(
    "scan_filtered_projected",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-06-08'""",
)
def scan_filtered_projected(spark, sf_dir):
    return scan(
        spark, "parquet", f"{sf_dir}/orders.parquet",
        where=WEEK.contains(F.col("o_orderdate")),
        columns=["o_orderkey", "o_custkey", "o_orderdate"],
    )


@register(
    "scan_inferred",
    with_inputs(
        "merchant_doc",
        """SELECT _id, merchant_id, replace(merchantName, chr(0), '') AS merchant_name,
                  CAST(stateCode AS BIGINT) AS state_code, CAST(balance AS DOUBLE) AS balance
           FROM merchant_doc""",
    ),
)
def scan_inferred(spark, sf_dir):
    path = shared_folder(spark, "merchants")
    load(spark, sf_dir, "merchant_doc").write.json(path)
    return scan(spark, "json", path).select(
        "_id", "merchant_id",
        F.replace("merchantName", F.lit("\x00"), F.lit("")).alias("merchant_name"),
        F.col("stateCode").alias("state_code"), "balance",
    )


#: Every second document has its state code as text.
MIXED_STATE = "CASE WHEN _id % 2 = 0 THEN CAST(stateCode AS VARCHAR) ELSE concat('S', stateCode) END"


def mixed_documents(spark, sf_dir):
    """Merchant documents in which the state code is a number here and text there."""
    path = shared_folder(spark, "documents")
    docs = load(spark, sf_dir, "merchant_doc")
    fields = [F.col(c) for c in docs.columns if c != "stateCode"]
    number = F.to_json(F.struct(*fields, "stateCode"))
    text = F.to_json(F.struct(*fields, F.concat(F.lit("S"), "stateCode").alias("stateCode")))
    docs.select(F.when(F.col("_id") % 2 == 0, number).otherwise(text)).write.text(path)
    return read_documents(spark, path)


MERCHANT_TYPES = {
    "_id": "bigint", "merchant_id": "string", "merchantName": "string", "stateCode": "string",
    "balance": "decimal(18,2)",
}


@register(
    "scan_variant",
    with_inputs(
        "merchant_doc",
        f"""SELECT _id, merchant_id, replace(merchantName, chr(0), '') AS merchant_name,
                   {MIXED_STATE} AS state_code, balance FROM merchant_doc""",
    ),
)
def scan_variant(spark, sf_dir):
    return document_columns(mixed_documents(spark, sf_dir), MERCHANT_TYPES).select(
        "_id", "merchant_id",
        F.replace("merchantName", F.lit("\x00"), F.lit("")).alias("merchant_name"),
        F.col("stateCode").alias("state_code"), "balance",
    )


@register(
    "scan_drop_once",
    with_inputs("merchant_doc", "SELECT _id, merchant_id, 'in' AS folder FROM merchant_doc"),
)
def scan_drop_once(spark, sf_dir):
    """A drop folder drained twice; the second time there is nothing new."""
    path = shared_folder(spark, "drop")
    docs = load(spark, sf_dir, "merchant_doc").select("_id", "merchant_id")
    docs.repartition(4).write.json(f"{path}/in")
    for _ in range(2):
        rows = drop_stream(spark, "json", f"{path}/in", f"{path}/done", docs.schema, max_files=2)
        write_batches(rows, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    folder = F.element_at(F.split("source_file", "/"), -2)
    return appended_rows(spark, f"{path}/rows").select("_id", "merchant_id", folder.alias("folder"))


@register(
    "page_by_layout",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM (
         SELECT *, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders)
       WHERE place BETWEEN 501 AND 1000""",
)
def page_by_layout(spark, sf_dir):
    """The third page of 250 rows and the one after it, from the files that hold them."""
    path = shared_folder(spark, "pages")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    write_pages(orders, path, "o_orderkey", 16)
    pages, after = [], None
    for _ in range(4):
        page = read_page(spark, path, "o_orderkey", after, 250)
        if page is None:
            break
        pages.append(page)
        after = page.agg(F.max("o_orderkey")).first()[0]
    return reduce(DataFrame.unionByName, pages[2:] or [pages[0].limit(0)])


@register("scan_table", "SELECT * FROM customer")
def scan_table(spark, sf_dir):
    return read_table(spark, "parquet", f"{sf_dir}/customer.parquet")


@register("scan_pruned", "SELECT c_custkey, c_nationkey FROM customer")
def scan_pruned(spark, sf_dir):
    return read_table(
        spark, "parquet", f"{sf_dir}/customer.parquet", columns=["c_custkey", "c_nationkey"]
    )


@register(
    "scan_one_day",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
       WHERE CAST(l_shipdate AS DATE) = DATE '1996-09-23'""",
)
def scan_one_day(spark, sf_dir):
    day = for_day(table(spark, sf_dir, "lineitem"), "l_shipdate", date(1996, 9, 23))
    return day.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")


@register(
    "scan_sheet",
    with_inputs(
        "registered",
        f"SELECT {sql.normalise('terminal_id')} AS terminal_id, state AS state_code, "
        "merchant_name FROM registered",
    ),
)
def scan_sheet(spark, sf_dir):
    root = shared_folder(spark, "sheets")
    sheet = load(spark, sf_dir, "registered").select(
        F.col("terminal_id").alias("Terminal ID"),
        F.col("state").alias("State-Code"),
        F.col("merchant_name").alias("merchantName"),
    )
    write_sheet(sheet, root, "REGISTERED TERMINALS", F.concat(F.lit("book_"), F.col("`State-Code`")))
    return read_sheets(spark, root, "REGISTERED TERMINALS")


@register(
    "scan_sheet_typed",
    with_inputs(
        "settlement",
        """SELECT Merchant, merchant_id, CAST(Amount AS DOUBLE) AS amount, CAST(Date AS DATE) AS day,
                  RetrievalReferenceNo AS reference,
                  CASE WHEN Tran_Status = 'FAILED' THEN 'POS_FAILED' ELSE 'POS_SUCCESSFULL' END AS sheet
           FROM settlement""",
    ),
)
def scan_sheet_typed(spark, sf_dir):
    root = shared_folder(spark, "typed-sheets")
    rows = load(spark, sf_dir, "settlement")
    failed = F.col("Tran_Status") == "FAILED"
    sheets = []
    for name, wanted in ((FAILED_SHEET, failed), (SUCCESSFUL_SHEET, ~failed)):
        write_sheet(rows.where(wanted), root, name, F.concat(F.lit("book_"), "PTSP"))
        sheet = read_typed_sheet(spark, root, name).select(
            "Merchant", "merchant_id", F.col("Amount").alias("amount"),
            F.col("Date").cast("date").alias("day"),
            F.col("RetrievalReferenceNo").alias("reference"), F.lit(name).alias("sheet"),
        )
        sheets.append(sheet)
    return sheets[0].unionByName(sheets[1])


@register(
    "scan_csv",
    with_inputs("bank_code", "SELECT bank_code, bank FROM bank_code"),
)
def scan_csv(spark, sf_dir):
    path = shared_folder(spark, "banks")
    write_csv(load(spark, sf_dir, "bank_code"), path)
    return read_csv(spark, path, schema="bank_code STRING, bank STRING")


@register(
    "scan_directory",
    with_inputs(
        "pos_txn",
        "SELECT retrieval_ref, terminal_id, CAST(amount AS DOUBLE) AS amount, status FROM pos_txn",
    ),
)
def scan_directory(spark, sf_dir):
    path = shared_folder(spark, "drop")
    columns = ["retrieval_ref", "terminal_id", "amount", "status"]
    rows = load(spark, sf_dir, "pos_txn").select(*columns)
    # Files of another shape that the read must not look at; Spark names a write's files alike.
    write_csv(spark.range(5).selectExpr("id AS a", "id AS b"), path)
    name = spark.read.text(path).inputFiles()[0].rsplit("/", 1)[1]
    write_csv(rows.where("status = 'FAILED'"), path, mode="append")
    write_csv(rows.where("status <> 'FAILED'"), path, mode="append")
    return read_drop(spark, path, pattern="*.csv", skip="-".join(name.split("-")[2:7]))


@register(
    "union_journals",
    with_inputs(
        "service_txn",
        f"SELECT txn_id, wallet, updated_at, {sql.quarter_span('updated_at')} AS journal FROM service_txn",
    ),
)
def union_journals(spark, sf_dir):
    path = shared_folder(spark, "journals")
    (
        load(spark, sf_dir, "service_txn")
        .withColumn("journal", quarter_span_key(F.col("updated_at")))
        .write.partitionBy("journal").parquet(path)
    )
    wanted = quarters_between(date(1995, 1, 1), date(2001, 12, 31))
    return scan(
        spark, "parquet", path,
        where=F.col("journal").isin(*wanted),
        columns=["txn_id", "wallet", "updated_at", "journal"],
    )


# Periods


@register(
    "period_quarter_span",
    with_inputs(
        "service_txn",
        f"SELECT txn_id, {sql.quarter_span('updated_at')} AS journal FROM service_txn",
    ),
)
def period_quarter_span(spark, sf_dir):
    return load(spark, sf_dir, "service_txn").select(
        "txn_id", quarter_span_key(F.col("updated_at")).alias("journal")
    )


@register(
    "period_quarter_start",
    with_inputs(
        "service_txn",
        "SELECT txn_id, concat('purchases_', strftime(date_trunc('quarter', updated_at), '%y_%m')) "
        "AS target FROM service_txn",
    ),
)
def period_quarter_start(spark, sf_dir):
    return load(spark, sf_dir, "service_txn").select(
        "txn_id", quarter_start_key(F.col("updated_at")).alias("target")
    )


@register(
    "period_month_key",
    with_inputs(
        "pos_txn",
        "SELECT retrieval_ref, concat('daily_transactions_', strftime(date, '%Y_%m')) AS source FROM pos_txn",
    ),
)
def period_month_key(spark, sf_dir):
    return load(spark, sf_dir, "pos_txn").select(
        "retrieval_ref", month_key(F.col("date")).alias("source")
    )


@register(
    "period_previous_week",
    with_inputs(
        "service_txn",
        """SELECT txn_id, updated_at, '1998-06-07' AS report_date FROM service_txn
           WHERE date_trunc('week', updated_at) = DATE '1998-06-01'""",
    ),
)
def period_previous_week(spark, sf_dir):
    period = previous_week(date(1998, 6, 10))
    return (
        load(spark, sf_dir, "service_txn")
        .where(period.contains(F.col("updated_at")))
        .select("txn_id", "updated_at", F.lit(period.report_date).alias("report_date"))
    )


@register(
    "period_previous_month",
    with_inputs(
        "service_txn",
        """SELECT txn_id, updated_at, '1997-01-31' AS report_date FROM service_txn
           WHERE year(updated_at) = 1997 AND month(updated_at) = 1""",
    ),
)
def period_previous_month(spark, sf_dir):
    period = previous_month(date(1997, 2, 10))
    return (
        load(spark, sf_dir, "service_txn")
        .where(period.contains(F.col("updated_at")))
        .select("txn_id", "updated_at", F.lit(period.report_date).alias("report_date"))
    )


@register(
    "period_trailing_days",
    with_inputs(
        "service_txn",
        """SELECT txn_id, updated_at FROM service_txn
           WHERE updated_at BETWEEN TIMESTAMP '1998-06-10' - INTERVAL 120 DAY AND TIMESTAMP '1998-06-10'""",
    ),
)
def period_trailing_days(spark, sf_dir):
    recent = trailing_days(F.col("updated_at"), datetime(1998, 6, 10), 120)
    return load(spark, sf_dir, "service_txn").where(recent).select("txn_id", "updated_at")


@register(
    "date_ordinal_suffix",
    with_inputs(
        "service_txn",
        """SELECT txn_id, CASE WHEN day(updated_at) IN (1, 21, 31) THEN 'ST'
                               WHEN day(updated_at) IN (2, 22) THEN 'ND'
                               WHEN day(updated_at) IN (3, 23) THEN 'RD' ELSE 'TH' END AS suffix
           FROM service_txn""",
    ),
)
def date_ordinal_suffix(spark, sf_dir):
    return load(spark, sf_dir, "service_txn").select(
        "txn_id", ordinal_suffix(F.dayofmonth("updated_at")).alias("suffix")
    )


# Header rules and projections


@register(
    "project_layout",
    with_inputs(
        "pos_txn",
        "SELECT terminal_id AS terminal, amount AS value, date AS updated_at, merchant FROM pos_txn",
    ),
)
def project_layout(spark, sf_dir):
    return load(spark, sf_dir, "pos_txn").select(
        F.col("terminal_id").alias("terminal"), F.col("amount").alias("value"),
        F.col("date").alias("updated_at"), "merchant",
    )


@register(
    "rename_positional",
    with_inputs(
        "terminal_device",
        "SELECT trm_termid AS terminal_id, trm_serialno AS serial, trm_model AS model, "
        "trm_connectcount AS connects FROM terminal_device",
    ),
)
def rename_positional_query(spark, sf_dir):
    devices = load(spark, sf_dir, "terminal_device")
    return rename_positional(devices, ["terminal_id", "serial", "model", "connects"])


@register(
    "rename_lower",
    with_inputs(
        "journal",
        "SELECT _id, terminalId AS terminalid, transactionType AS transactiontype, amount FROM journal",
    ),
)
def rename_lower(spark, sf_dir):
    journal = load(spark, sf_dir, "journal")
    return lower_columns(journal.select("_id", "terminalId", "transactionType", "amount"))


@register(
    "rename_snake",
    with_inputs(
        "registered",
        "SELECT terminal_id, state AS state_code, merchant_name FROM registered",
    ),
)
def rename_snake(spark, sf_dir):
    sheet = load(spark, sf_dir, "registered").toDF("Terminal ID", "State-Code", "merchantName")
    return snake_columns(sheet)


@register(
    "conform_header",
    with_inputs(
        "settlement",
        "SELECT Merchant AS shop, TerminalID AS terminal, merchant_id, Amount, Date, "
        "RetrievalReferenceNo, Tran_Status, PTSP FROM settlement",
    ),
)
def conform_header_query(spark, sf_dir):
    return conform_header(load(spark, sf_dir, "settlement"), ["shop", "terminal", "merchant_id"])


@register(
    "drop_optional",
    with_inputs(
        "settlement",
        "SELECT Merchant, TerminalID, merchant_id, Amount, Date, RetrievalReferenceNo FROM settlement",
    ),
)
def drop_optional(spark, sf_dir):
    return drop_columns(
        load(spark, sf_dir, "settlement"), ["Acquirer_name", "Tran_Status", "PTSP"]
    )


@register(
    "add_constants",
    with_inputs(
        "registered",
        """SELECT terminal_id, '' AS bvn, 0 AS connected, CAST(NULL AS VARCHAR) AS last_transaction_time,
                  '1998-06-07' AS report_date FROM registered""",
    ),
)
def add_constants_query(spark, sf_dir):
    return add_constants(
        load(spark, sf_dir, "registered").select("terminal_id"),
        {
            "bvn": "", "connected": 0, "last_transaction_time": F.lit(None).cast("string"),
            "report_date": "1998-06-07",
        },
    )


@register(
    "cast_all_string",
    with_inputs(
        "merchant_doc",
        """SELECT CAST(_id AS VARCHAR) AS _id, merchant_id, CAST(stateCode AS VARCHAR) AS "stateCode",
                  CAST(balance AS VARCHAR) AS balance FROM merchant_doc""",
    ),
)
def cast_all_string(spark, sf_dir):
    documents = load(spark, sf_dir, "merchant_doc")
    return all_to_string(documents.drop("merchantName"))


# Filters


@register(
    "filter_type",
    with_inputs(
        "journal",
        "SELECT _id, terminalId AS terminal_id FROM journal WHERE transactionType = 'Purchase'",
    ),
)
def filter_type(spark, sf_dir):
    journal = load(spark, sf_dir, "journal")
    return journal.where(F.col("transactionType") == "Purchase").select(
        "_id", F.col("terminalId").alias("terminal_id")
    )


@register(
    "filter_period",
    with_inputs(
        "pos_txn",
        """SELECT retrieval_ref, date FROM pos_txn
           WHERE date BETWEEN TIMESTAMP '1996-09-23' AND TIMESTAMP '1996-09-23 23:59:59.999999'""",
    ),
)
def filter_period(spark, sf_dir):
    day = lagged_day(date(1996, 9, 26), 3)
    return (
        load(spark, sf_dir, "pos_txn")
        .where(day.contains(F.col("date")))
        .select("retrieval_ref", "date")
    )


@register(
    "filter_prefix",
    with_inputs(
        "pos_txn", "SELECT retrieval_ref, merchant FROM pos_txn WHERE starts_with(merchant, 'NOVA')"
    ),
)
def filter_prefix(spark, sf_dir):
    txns = load(spark, sf_dir, "pos_txn")
    return txns.where(F.col("merchant").startswith("NOVA")).select("retrieval_ref", "merchant")


@register(
    "filter_pattern",
    with_inputs(
        "settlement",
        r"""SELECT TerminalID AS terminal_id, RetrievalReferenceNo AS reference FROM settlement
            WHERE RetrievalReferenceNo IS NOT NULL AND contains(TerminalID, '.')
              AND regexp_matches(TerminalID, '\.\d+')""",
    ),
)
def filter_pattern(spark, sf_dir):
    rows = load(spark, sf_dir, "settlement")
    wanted = (
        F.col("RetrievalReferenceNo").isNotNull()
        & F.col("TerminalID").contains(".")
        & F.col("TerminalID").rlike(r"\.\d+")
    )
    return rows.where(wanted).select(
        F.col("TerminalID").alias("terminal_id"), F.col("RetrievalReferenceNo").alias("reference")
    )


@register(
    "union_by_name",
    with_inputs(
        "settlement",
        "SELECT Merchant, Amount, RetrievalReferenceNo, Tran_Status FROM settlement",
    ),
)
def union_by_name(spark, sf_dir):
    rows = load(spark, sf_dir, "settlement")
    failed = rows.where("Tran_Status = 'FAILED'").select(
        "Tran_Status", "Amount", "Merchant", "RetrievalReferenceNo"
    )
    successful = rows.where("Tran_Status <> 'FAILED'").select(
        "Merchant", "Amount", "RetrievalReferenceNo", "Tran_Status"
    )
    return union_all([failed, successful])
