"""Merges, incremental loads, streams and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tillbook.functions.money import parse_amount
from tillbook.functions.periods import day_of, quarter_span_key
from tillbook.operators.incremental import (
    high_watermark,
    rows_after,
    rows_between,
    time_watermark,
)
from tillbook.operators.merge import merge_sync, merge_upsert
from tillbook.plans.activity import purchase_activity
from tillbook.plans.loads import load_layout, routed
from tillbook.plans.roster import prepare_roster
from tillbook.sources.buckets import KeyedTable
from tillbook.sources.scans import read_csv
from tillbook.sources.sinks import (
    read_version,
    shared_folder,
    write_csv,
    write_report,
    write_version,
)
from tillbook.streaming.compaction import compact, compacted
from tillbook.streaming.keyed import Index, keyed_rows, write_keyed
from tillbook.streaming.ledger import Ledger, counted, ledger_rows, reconcile
from tillbook.streaming.loads import (
    appended_rows,
    batch_rows,
    combined_daily,
    current_daily,
    current_latest,
    daily_activity,
    file_stream,
    latest_activity,
    write_batches,
)
from tillbook.streaming.windows import activity_windows, daily_windows

from . import sql
from .inputs import EVENTS_SCHEMA, ORDERS_SCHEMA, cleaned, derive, load, with_inputs
from .registry import register

AS_OF = datetime(2024, 2, 1)

# Merges


MERGE_CTES = f"""
WITH target AS (SELECT {sql.clean('terminal_id')} AS terminal_id, state_initials, note FROM roster_target),
source AS (SELECT {sql.clean('terminal_id')} AS terminal_id, min(state) AS state_initials
           FROM registered GROUP BY 1)
"""
MERGED = """
SELECT coalesce(t.terminal_id, s.terminal_id) AS terminal_id,
       CASE WHEN s.terminal_id IS NOT NULL THEN s.state_initials ELSE t.state_initials END AS state_initials,
       t.note AS note
FROM target t FULL JOIN source s ON t.terminal_id = s.terminal_id"""


@register("merge_upsert", with_inputs("roster_target registered", MERGE_CTES + MERGED))
def merge_upsert_query(spark, sf_dir):
    source = prepare_roster(load(spark, sf_dir, "registered"))
    return merge_upsert(cleaned(spark, sf_dir, "roster_target"), source, "terminal_id", ["state_initials"])


ALL_CTES = f"""
WITH target AS (SELECT {sql.clean('terminal_id')} AS terminal_id, state_initials, note FROM roster_target),
source AS (SELECT {sql.clean('terminal_id')} AS terminal_id, min(state) AS state_initials,
                  CAST(NULL AS VARCHAR) AS note FROM registered GROUP BY 1)
"""


@register(
    "merge_upsert_all",
    with_inputs(
        "roster_target registered",
        ALL_CTES
        + """SELECT coalesce(t.terminal_id, s.terminal_id) AS terminal_id,
                    CASE WHEN s.terminal_id IS NOT NULL THEN s.state_initials ELSE t.state_initials END
                      AS state_initials,
                    CASE WHEN s.terminal_id IS NOT NULL THEN s.note ELSE t.note END AS note
             FROM target t FULL JOIN source s ON t.terminal_id = s.terminal_id""",
    ),
)
def merge_upsert_all(spark, sf_dir):
    source = prepare_roster(load(spark, sf_dir, "registered")).withColumn(
        "note", F.lit(None).cast("string")
    )
    return merge_upsert(cleaned(spark, sf_dir, "roster_target"), source, "terminal_id")


@register(
    "merge_sync",
    with_inputs(
        "roster_target registered",
        MERGE_CTES + "SELECT * FROM (" + MERGED + ") WHERE terminal_id IN (SELECT terminal_id FROM source)",
    ),
)
def merge_sync_query(spark, sf_dir):
    source = prepare_roster(load(spark, sf_dir, "registered"))
    return merge_sync(cleaned(spark, sf_dir, "roster_target"), source, "terminal_id")


@register(
    "merge_by_version",
    with_inputs(
        "roster_target registered",
        MERGE_CTES + "SELECT * FROM (" + MERGED + ") WHERE terminal_id IN (SELECT terminal_id FROM source)",
    ),
)
def merge_by_version(spark, sf_dir):
    """First load replaces, the second syncs with what the first one wrote."""
    root = shared_folder(spark, "versions")
    loads = (
        cleaned(spark, sf_dir, "roster_target"),
        prepare_roster(load(spark, sf_dir, "registered")),
    )
    for number, source in enumerate(loads, start=1):
        write_version(merge_sync(read_version(spark, root), source, "terminal_id"), root, f"{number:04d}")
    return read_version(spark, root)


@register("merge_by_bucket", with_inputs("roster_target registered", MERGE_CTES + MERGED))
def merge_by_bucket(spark, sf_dir):
    """First load replaces, the second merges the buckets that it touches."""
    table = KeyedTable(shared_folder(spark, "keyed"), "terminal_id", 16)
    table.upsert(cleaned(spark, sf_dir, "roster_target"), "0001")
    table.upsert(prepare_roster(load(spark, sf_dir, "registered")), "0002", ["state_initials"])
    return table.read(spark)


# Incremental loads


@register(
    "watermark_key",
    with_inputs("journal_target", "SELECT max(_id) AS watermark FROM journal_target"),
)
def watermark_key(spark, sf_dir):
    return high_watermark(load(spark, sf_dir, "journal_target"), "_id")


@register(
    "watermark_time",
    with_inputs(
        "journal_target",
        """SELECT event_type, max(transactiontime) AS watermark FROM journal_target
           WHERE event_type = 'signup' GROUP BY 1
           UNION ALL SELECT 'none yet', TIMESTAMP '2024-01-31 23:59:59.999'""",
    ),
)
def watermark_time(spark, sf_dir):
    loaded = load(spark, sf_dir, "journal_target")
    rows = [
        time_watermark(part, "transactiontime", AS_OF).select(F.lit(name).alias("event_type"), "watermark")
        for name, part in (
            ("signup", loaded.where("event_type = 'signup'")),
            ("none yet", loaded.where("event_type = 'none yet'")),
        )
    ]
    return rows[0].unionByName(rows[1])


@register(
    "incremental_by_key",
    with_inputs(
        "journal journal_target",
        """SELECT _id, terminalId AS terminal_id, transactionTime AS transaction_time FROM journal
           WHERE transactionType = 'Purchase'
             AND _id > (SELECT max(_id) FROM journal_target WHERE event_type = 'purchase')""",
    ),
)
def incremental_by_key(spark, sf_dir):
    journal = load(spark, sf_dir, "journal").where("transactionType = 'Purchase'")
    loaded = load(spark, sf_dir, "journal_target").where("event_type = 'purchase'")
    return rows_after(journal, loaded, "_id").select(
        "_id", F.col("terminalId").alias("terminal_id"),
        F.col("transactionTime").alias("transaction_time"),
    )


@register(
    "incremental_by_time",
    with_inputs(
        "journal journal_target",
        """SELECT _id, terminalId AS terminal_id, transactionTime AS transaction_time FROM journal
           WHERE transactionType = 'VAS' AND transactionTime <= TIMESTAMP '2024-02-01'
             AND transactionTime >= (SELECT max(transactiontime) FROM journal_target WHERE event_type = 'signup')
             AND _id NOT IN (SELECT _id FROM journal_target WHERE event_type = 'signup')""",
    ),
)
def incremental_by_time(spark, sf_dir):
    journal = load(spark, sf_dir, "journal").where("transactionType = 'VAS'")
    loaded = load(spark, sf_dir, "journal_target").where("event_type = 'signup'")
    new = rows_between(
        journal, loaded, ts="transactionTime", target_ts="transactiontime", key="_id", as_of=AS_OF
    )
    return new.select(
        "_id", F.col("terminalId").alias("terminal_id"),
        F.col("transactionTime").alias("transaction_time"),
    )


# Streams


def drain(spark, stream, purpose, **options):
    """Run a stream over what is there, in several micro-batches."""
    path = shared_folder(spark, purpose)
    write_batches(stream, f"{path}/rows", f"{path}/checkpoint", **options).awaitTermination()
    return f"{path}/rows"


FILES = 6


def table_stream(spark, sf_dir, name, schema):
    """A driver table as a stream of files in no order of time, two to a micro-batch."""
    path = shared_folder(spark, f"stream-{name}")
    spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet").repartition(FILES).write.parquet(path)
    return file_stream(spark, "parquet", path, schema, max_files=2)


def journal_stream(spark, sf_dir):
    events = table_stream(spark, sf_dir, "events", EVENTS_SCHEMA)
    return derive(spark, "journal", events=events)


@register(
    "stream_incremental",
    with_inputs(
        "journal",
        f"""SELECT _id, terminalId AS terminalid, transactionTime AS transactiontime,
                   {sql.major('amount')} AS amount, replace(customData, chr(0), '') AS customdata
            FROM journal WHERE transactionType = 'Purchase'""",
    ),
)
def stream_incremental(spark, sf_dir):
    purchases = journal_stream(spark, sf_dir).where("transactionType = 'Purchase'")
    fields = ["_id", "terminalId", "transactionTime", "amount", "customData"]
    rows = drain(
        spark, purchases, "stream-load", key="_id", partition_by=["target"],
        transform=lambda batch: routed(load_layout(batch, fields)),
    )
    return appended_rows(spark, rows).drop("target")


LAST_ACTIVITY_SQL = with_inputs(
    "journal",
    f"""SELECT {sql.clean('terminalId', 9)} AS terminal_id,
               max(transactionTime) AS last_transaction_time, max(updatedAt) AS last_connect_date
        FROM journal WHERE transactionType = 'Purchase' GROUP BY 1""",
)


@register("stream_last_activity", LAST_ACTIVITY_SQL)
def stream_last_activity(spark, sf_dir):
    activity = purchase_activity(journal_stream(spark, sf_dir))
    return current_latest(spark, drain(spark, activity, "stream-activity", transform=latest_activity))


DAILY_ACTIVITY_SQL = with_inputs(
    "service_txn",
    f"""SELECT wallet, terminal, category, CAST(updated_at AS DATE) AS day, count(*) AS volume,
               CAST(sum({sql.amount('amount')}) AS DECIMAL(38,2)) AS value,
               max(updated_at) AS updated_at
        FROM service_txn GROUP BY wallet, terminal, category, CAST(updated_at AS DATE)""",
)


def txn_stream(spark, sf_dir):
    orders = table_stream(spark, sf_dir, "orders", ORDERS_SCHEMA)
    return derive(spark, "service_txn", orders=orders).withColumn(
        "amount", parse_amount(F.col("amount"))
    )


@register("stream_daily_activity", DAILY_ACTIVITY_SQL)
def stream_daily_activity(spark, sf_dir):
    txns = txn_stream(spark, sf_dir)
    return current_daily(spark, drain(spark, txns, "stream-daily", transform=daily_activity))


@register("stream_daily_compacted", DAILY_ACTIVITY_SQL)
def stream_daily_compacted(spark, sf_dir):
    """All but the newest batch read from the table they were folded into."""
    place = shared_folder(spark, "stream-compacted")
    rows = drain(spark, txn_stream(spark, sf_dir), "stream-daily", transform=daily_activity)
    compact(spark, rows, place, combined_daily)
    return compacted(spark, rows, place, combined_daily)


@register(
    "stream_reconciled",
    with_inputs(
        "service_txn",
        f"""SELECT 'rows read' AS measure, CAST(count(*) AS DECIMAL(38,2)) AS amount FROM service_txn
            UNION ALL SELECT 'rows kept', count({sql.amount('amount')}) FROM service_txn
            UNION ALL SELECT 'amount kept', sum({sql.amount('amount')}) FROM service_txn
            UNION ALL SELECT 'rows stored', count({sql.amount('amount')}) FROM service_txn
            UNION ALL SELECT 'batches that differ', 0""",
    ),
)
def stream_reconciled(spark, sf_dir):
    """Rows counted on their way through a stream, and held against the rows it wrote."""
    place = shared_folder(spark, "stream-ledger")
    ledger = Ledger(spark, f"{place}/ledger", place.rsplit("/", 1)[-1])
    spark.streams.addListener(ledger)
    try:
        read = counted(txn_stream(spark, sf_dir), "read")
        kept = counted(read.where("amount IS NOT NULL"), "kept", "amount")
        ledger.settle(
            write_batches(kept, f"{place}/rows", f"{place}/checkpoint", name=ledger.name)
        )
    finally:
        spark.streams.removeListener(ledger)
    entries = ledger_rows(spark, ledger.path)
    batches = reconcile(entries, batch_rows(spark, f"{place}/rows"), "kept", ["amount"])
    at_stage = {stage: F.when(F.col("stage") == stage, F.col("rows")) for stage in ("read", "kept")}
    said = entries.agg(
        *[F.sum(rows).alias(f"rows {stage}") for stage, rows in at_stage.items()],
        F.sum(F.when(F.col("stage") == "kept", F.col("totals")["amount"])).alias("amount kept"),
    )
    found = batches.agg(
        F.sum("rows_stored").alias("rows stored"), F.count_if(~F.col("agrees")).alias("batches that differ")
    )
    return long_form(said).unionByName(long_form(found))


def long_form(one_row):
    """A row of measures as one row each."""
    pairs = [
        F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").cast("decimal(38,2)").alias("amount"))
        for c in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*pairs)))


# Streams with state


def drain_windows(spark, windows, stream, purpose):
    path = shared_folder(spark, purpose)
    place = f"{path}/rows", f"{path}/checkpoint"
    windows.write(stream, *place).awaitTermination()
    return place


@register("stream_daily_windows", DAILY_ACTIVITY_SQL)
def stream_daily_windows(spark, sf_dir):
    """Windows that close 400 days behind the latest order; the files are in no order of time."""
    txns = txn_stream(spark, sf_dir).withColumn("day", day_of(F.col("updated_at")))
    windows = daily_windows("400 days")
    place = drain_windows(spark, windows, txns, "stream-windows")
    rows = windows.current(spark, *place).drop("window_start")
    return rows.withColumn("value", F.col("value").cast("decimal(38,2)"))


@register(
    "stream_keyed",
    with_inputs(
        "journal",
        f"""SELECT _id, terminalId AS terminalid, transactionTime AS transactiontime,
                   {sql.major('amount')} AS amount, replace(customData, chr(0), '') AS customdata
            FROM journal WHERE transactionType = 'Purchase'""",
    ),
)
def stream_keyed(spark, sf_dir):
    """The journal twice, each time by a stream of its own into the same target."""
    path = shared_folder(spark, "stream-keyed")
    fields = ["_id", "terminalId", "transactionTime", "amount", "customData"]
    for name in ("first", "second"):
        purchases = journal_stream(spark, sf_dir).where("transactionType = 'Purchase'")
        write_keyed(
            purchases, path, f"{path}/checkpoint-{name}", key="_id", order=["transactiontime"],
            transform=lambda batch: load_layout(batch, fields), index=Index(16, 16),
        ).awaitTermination()
    return keyed_rows(spark, path)


@register("stream_last_windows", LAST_ACTIVITY_SQL)
def stream_last_windows(spark, sf_dir):
    """Every journal row comes twice; windows of a day close a week behind."""
    twice = journal_stream(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    activity = purchase_activity(twice, keep=["_id"])
    windows = activity_windows("7 days", unique=("_id",))
    place = drain_windows(spark, windows, activity, "stream-last")
    return windows.totals(spark, *place)


# Sinks: written, then read back


@register(
    "sink_append",
    with_inputs("pos_txn", "SELECT retrieval_ref, merchant_id, amount, date, status FROM pos_txn"),
)
def sink_append(spark, sf_dir):
    path = shared_folder(spark, "append")
    rows = load(spark, sf_dir, "pos_txn").select(
        "retrieval_ref", "merchant_id", "amount", "date", "status"
    )
    write_report(rows.where("status = 'FAILED'"), path)
    write_report(rows.where("status <> 'FAILED'"), path)
    return spark.read.parquet(path)


@register(
    "sink_overwrite",
    with_inputs("agent", "SELECT wallet_id, bvn, state_of_residence FROM agent"),
)
def sink_overwrite(spark, sf_dir):
    path = shared_folder(spark, "overwrite")
    rows = load(spark, sf_dir, "agent").select("wallet_id", "bvn", "state_of_residence")
    write_report(rows.withColumn("bvn", F.lit("old")), path)
    write_report(rows, path, mode="overwrite")
    return spark.read.parquet(path)


@register(
    "sink_unless_empty",
    with_inputs("agent", "SELECT wallet_id, bvn, state_of_residence FROM agent"),
)
def sink_unless_empty(spark, sf_dir):
    """A load whose input has no row leaves the target as it is."""
    path = shared_folder(spark, "unless-empty")
    rows = load(spark, sf_dir, "agent").select("wallet_id", "bvn", "state_of_residence")
    for scan in (rows, rows.where("wallet_id IS NULL")):
        write_report(scan, path, mode="overwrite", unless_empty=scan)
    return spark.read.parquet(path)


@register(
    "sink_partition_overwrite",
    with_inputs(
        "service_txn",
        f"""SELECT txn_id, wallet, {sql.quarter_span('updated_at')} AS journal,
                   CASE WHEN year(updated_at) = 1997 THEN 'second' ELSE 'first' END AS load
            FROM service_txn""",
    ),
)
def sink_partition_overwrite(spark, sf_dir):
    path = shared_folder(spark, "by-quarter")
    rows = load(spark, sf_dir, "service_txn").withColumn(
        "journal", quarter_span_key(F.col("updated_at"))
    )
    first = rows.select("txn_id", "wallet", "journal", F.lit("first").alias("load"))
    second = rows.where(F.year("updated_at") == 1997).select(
        "txn_id", "wallet", "journal", F.lit("second").alias("load")
    )
    for part in (first, second):
        write_report(part, path, mode="overwrite_partitions", partition_by=["journal"], rebalance=True)
    return spark.read.parquet(path)


@register(
    "sink_csv",
    with_inputs("settlement", "SELECT TerminalID, Amount, RetrievalReferenceNo FROM settlement"),
)
def sink_csv(spark, sf_dir):
    path = shared_folder(spark, "csv")
    rows = load(spark, sf_dir, "settlement").select("TerminalID", "Amount", "RetrievalReferenceNo")
    write_csv(rows, path)
    return read_csv(
        spark, path,
        schema="TerminalID STRING, Amount DECIMAL(18,2), RetrievalReferenceNo STRING",
    )
