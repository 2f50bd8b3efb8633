"""Incremental loads of purchases and services, and the merchant dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import minor_to_major
from ..functions.periods import day_of, quarter_start_key
from ..operators.dedup import dedup_if_present
from ..operators.incremental import rows_after, rows_between
from ..sources.columns import (
    all_to_string,
    declared_columns,
    drop_columns,
    lower_columns,
    strip_nul,
    typed_times,
)

PURCHASE = "Purchase"
SERVICE = "VAS"

# Journal fields loaded for purchases.
PURCHASE_FIELDS = (
    "_id", "customData", "posEntryMode", "posDataCode", "profiledIntlTid", "prrn",
    "deliveryStatus", "receipt", "receiptSent", "printedReceiptData", "rrn", "onlinePin",
    "merchantName", "merchantAddress", "merchantId", "terminalId", "STAN", "transactionTime",
    "merchantCategoryCode", "handlerName", "MTI", "maskedPan", "processingCode", "amount",
    "currencyCode", "messageReason", "originalDataElements", "customerRef", "cardExpiry",
    "handlerUsed", "cardName", "isContactless", "tvr", "crim", "createdAt", "updatedAt", "__v",
    "fiic", "authCode", "failOverRrn", "handlerResponseTime", "interSwitchResponse",
    "oldResCode", "responseCode", "script", "tamsBatchNo", "tamsMessage", "tamsRrn",
    "tamsStatus", "tamsTransNo", "upslTerminalIdUsed", "write2pos", "timeFromNibss",
    "timeToNibss", "timeToPos", "totalTrnxTime", "pfmNotified", "ejournalData", "notified",
    "isNotified", "customTransactionId",
)

# Journal fields loaded for services.
SERVICE_FIELDS = (
    "_id", "vasData", "receipt", "receiptSent", "ejournalData", "customData", "prrn", "rrn",
    "onlinePin", "merchantName", "merchantAddress", "merchantId", "terminalId", "STAN",
    "transactionTime", "merchantCategoryCode", "handlerName", "MTI", "maskedPan",
    "processingCode", "amount", "currencyCode", "messageReason", "originalDataElements",
    "customerRef", "cardExpiry", "isVasComplete", "handlerUsed", "tvr", "crim", "__v", "fiic",
    "authCode", "failOverRrn", "handlerResponseTime", "interSwitchResponse", "oldResCode",
    "responseCode", "script", "tamsBatchNo", "tamsMessage", "tamsRrn", "tamsStatus",
    "tamsTransNo", "upslTerminalIdUsed", "write2pos", "notified", "pfmNotified",
    "posEntryMode", "isContactless", "cardName", "updatedAt", "createdAt", "posDataCode",
    "isNotified", "customTransactionId", "virtualMerchantName", "virtualTid",
    "profiledIntlTid", "medussaRequestMid", "medussaRequestTid", "medussaResponse",
    "medussaRequestMerchantName", "timeFromNibss", "timeToNibss", "deliveryStatus",
    "totalTrnxTime", "printedReceiptData", "timeToPos",
)


def load_layout(journal: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """Journal rows as loaded: chosen fields, lower-case names, major units, no NULs."""
    rows = declared_columns(journal, fields) if fields else journal
    rows = lower_columns(rows)
    return strip_nul(rows.withColumn("amount", minor_to_major(F.col("amount"))))


def routed(rows: DataFrame, ts: str = "transactiontime", prefix: str = "purchases") -> DataFrame:
    """Rows with the quarter table they belong to, as a partition column for the sink."""
    return rows.withColumn("target", quarter_start_key(day_of(F.col(ts)), prefix))


def purchase_increment(
    journal: DataFrame,
    target: DataFrame,
    fields: Sequence[str] | None = PURCHASE_FIELDS,
    *,
    quarter_column: str | None = None,
    quarters: Sequence[str] = (),
) -> DataFrame:
    """Purchases after the last loaded ``_id``, in one pass.

    ``quarter_column`` names a partition column and ``quarters`` its values to read
    (``quarters_between`` lists them): those that may hold rows after the last load.
    """
    if quarter_column:
        journal = journal.where(F.col(quarter_column).isin(*quarters))
    new = rows_after(journal.where(F.col("transactionType") == PURCHASE), target, "_id")
    return load_layout(new, fields)


def service_increment(
    journal: DataFrame,
    target: DataFrame,
    as_of: datetime,
    fields: Sequence[str] | None = SERVICE_FIELDS,
    *,
    quarter_column: str | None = None,
    quarters: Sequence[str] = (),
) -> DataFrame:
    """Service rows from the last loaded time up to ``as_of`` that are not loaded yet.

    ``quarter_column`` and ``quarters`` prune as in ``purchase_increment``.
    """
    if quarter_column:
        journal = journal.where(F.col(quarter_column).isin(*quarters))
    new = rows_between(
        typed_times(journal, "transactionTime").where(F.col("transactionType") == SERVICE),
        typed_times(target, "transactiontime"),
        ts="transactionTime",
        target_ts="transactiontime",
        key="_id",
        as_of=as_of,
    )
    return load_layout(new, fields)


def merchant_dimension(documents: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Merchant documents as text, one per ``merchant_id`` where that column exists.

    ``order`` names lower-case columns; a dropped ``_id`` may decide which row stays.
    """
    rows = lower_columns(all_to_string(documents))
    return strip_nul(drop_columns(dedup_if_present(rows, "merchant_id", order), ["_id"]))
