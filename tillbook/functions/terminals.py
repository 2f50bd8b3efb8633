"""Terminal-identifier expressions.

Identifiers arrive as spreadsheet text, so a plain id, an id in scientific
notation (``2.035123456E+10``), a zero-padded id and an id with stray spaces may
all name the same terminal.  Every function here is a column expression: null in,
null out, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier widths used by the summary/roster and activity reports.
SUMMARY_WIDTH = 8
ACTIVITY_WIDTH = 9


def clean_terminal_id(tid: Column, width: int = SUMMARY_WIDTH) -> Column:
    """Keep the mantissa of a dotted id, padded with ``0`` (or cut) to ``width``."""
    return F.when(tid.contains("."), _mantissa(tid, width)).otherwise(tid)


def normalise_terminal_id(
    tid: Column, width: int = SUMMARY_WIDTH, drop_fraction: bool = False
) -> Column:
    """Drop spaces and leading zeros of a whole-number id, and clean a dotted one.

    Text that is not a whole number (or overflows a bigint) is kept untrimmed.
    ``drop_fraction`` also treats ``2035.12`` as the whole number ``2035``.
    """
    text = tid.cast("string")
    digits = F.replace(text, F.lit(" "), F.lit(""))
    # Only digit strings reach the cast: a failed one costs an exception per row.
    if drop_fraction:
        whole = F.regexp_extract(digits, r"^([+-]?[0-9]+)(\.[0-9]*)?$", 1)
        number = F.when(whole != "", whole.try_cast("bigint").cast("string"))
        return F.coalesce(number, clean_terminal_id(text, width))
    number = F.when(digits.rlike("^[+-]?[0-9]+$"), digits.try_cast("bigint").cast("string"))
    # A dotted id is never a whole number, so the cheap test comes first.
    return F.when(text.contains("."), _mantissa(text, width)).otherwise(F.coalesce(number, text))


def _mantissa(text: Column, width: int) -> Column:
    return F.rpad(F.substring_index(text, "E", 1), width, "0")


def round_terminal_id(tid: Column, places: int = 5) -> Column:
    """Round an id with a decimal part to ``places``; malformed numbers become null."""
    text = tid.cast("string")
    rounded = F.round(text.try_cast("double"), places).cast("string")
    return F.when(text.rlike(r"\.\d+"), rounded).otherwise(text)


def bank_prefix(tid: Column, dotted: int = 5, plain: int = 4) -> Column:
    """Leading characters of an id that name its bank."""
    if dotted == plain:
        return F.substring(tid, 1, plain)
    return F.when(tid.contains("."), F.substring(tid, 1, dotted)).otherwise(
        F.substring(tid, 1, plain)
    )
