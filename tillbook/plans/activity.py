"""Terminal activity: last transaction, device and bank per terminal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import quarter_span_key
from ..functions.terminals import ACTIVITY_WIDTH, clean_terminal_id
from ..operators.lookup import add_bank, add_device
from ..operators.rollups import last_activity
from ..sources.columns import typed_times

PURCHASE = "Purchase"

# Output name and inventory column.
DEVICE_COLUMNS = {
    "serial_number": "trm_serialno",
    "terminal_model": "trm_model",
    "terminal_version": "trm_version",
    "q_version": "q__version",
    "connect_count": "trm_connectcount",
    "terminal_session": "trm_session",
    "longitude": "trm_geolong",
    "latitude": "trm_geolat",
}


def purchase_activity(
    journal: DataFrame, width: int = ACTIVITY_WIDTH, keep: Sequence[str] = ()
) -> DataFrame:
    """Purchases with cleaned id, transaction time and update time, and the columns to keep."""
    typed = typed_times(journal, "transactionTime", "updatedAt")
    return typed.where(F.col("transactionType") == PURCHASE).select(
        clean_terminal_id(F.col("terminalId").cast("string"), width).alias("terminal_id"),
        F.col("transactionTime").alias("transaction_time"),
        F.col("updatedAt").alias("updated_at"),
        *keep,
    )


def prepare_devices(devices: DataFrame, width: int = ACTIVITY_WIDTH) -> DataFrame:
    """Device inventory with cleaned ids."""
    return devices.withColumn("trm_termid", clean_terminal_id(F.col("trm_termid"), width))


def terminal_activity(
    journal: DataFrame,
    devices: DataFrame,
    banks: DataFrame,
    per_journal: bool = False,
    *,
    quarter_column: str | None = None,
    quarters: Sequence[str] = (),
) -> DataFrame:
    """One row per terminal over all journals (or per terminal and quarter).

    Ids are cleaned before the one aggregation, so two spellings of an id share a row.
    Inventory columns the device frame lacks are left out.  ``quarter_column`` names a
    partition column and ``quarters`` the journals to read, as in a rerun of some of them.
    """
    if quarter_column:
        journal = journal.where(F.col(quarter_column).isin(*quarters))
    purchases = purchase_activity(journal)
    extra = []
    if per_journal:
        purchases = purchases.withColumn("journal", quarter_span_key(F.col("transaction_time")))
        extra = ["journal"]
    latest = last_activity(purchases, *extra)
    taken = {out: src for out, src in DEVICE_COLUMNS.items() if src in devices.columns}
    with_device = add_device(latest, prepare_devices(devices), taken)
    return add_bank(with_device, banks, output="bank_name").select(
        *extra, "terminal_id", "last_transaction_time", "last_connect_date", *taken, "bank_name"
    )
