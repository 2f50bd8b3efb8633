"""Settlement cleanup: conform, drop and deduplicate settlement rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.dedup import dedup, union_all
from ..sources.columns import conform_header, drop_columns

# The settlement header and the columns left out of the clean file.
HEADER = (
    "Merchant", "TerminalID", "IssuingBank", "AcquiringBank", "BIN", "PAN",
    "Date", "merchant_id", "Amount", "ResponseCode", "System Trace Number",
    "RetrievalReferenceNo", "Acquirer_name", "Tran_Status", "Acquirer_Processor", "PTSP",
)
LEFT_OUT = ("Acquirer_name", "Tran_Status", "PTSP")
REFERENCE = "RetrievalReferenceNo"
FAILED_SHEET = "POS_FAILED"
SUCCESSFUL_SHEET = "POS_SUCCESSFULL"
SKIPPED_FILES = "RCA"


def clean_settlement(
    parts: Sequence[DataFrame],
    order: Sequence[str],
    *,
    header: Sequence[str] | None = HEADER,
    left_out: Sequence[str] = LEFT_OUT,
) -> DataFrame:
    """All parts as one frame, one row per retrieval reference.

    ``order`` picks the row kept; it may name left-out columns, which are dropped last.
    Rows without a reference collapse to one.
    """
    rows = union_all([conform_header(p, header) if header else p for p in parts])
    return drop_columns(dedup(rows, [REFERENCE], order), left_out)
