"""Amount and fee expressions in exact decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

AMOUNT = DecimalType(18, 2)
TOTAL = DecimalType(38, 2)

# The fee rate and the scale each report rounds it to.  Scale 4 makes
# the effective rate 0.0013, scale 6 keeps 0.001250.
FEE_RATE = Decimal("0.00125")
DAILY_RATE_SCALE = 4
MONTHLY_RATE_SCALE = 6


# Every spelling of a number the cast accepts.
_NUMBER = r"^[\x00-\x20]*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[\x00-\x20]*$"


def to_amount(value: Column) -> Column:
    """A numeric column as ``decimal(18,2)``; what does not fit becomes null."""
    return value.try_cast(AMOUNT)


def parse_amount(text: Column) -> Column:
    """Text as ``decimal(18,2)``; malformed text becomes null instead of an error.

    The pattern keeps malformed text away from the cast, which throws once per bad row.
    """
    return F.when(text.rlike(_NUMBER), to_amount(text))


def minor_to_major(text: Column) -> Column:
    """Minor units (cents) to major units as ``decimal(20,4)``."""
    return (parse_amount(text) * F.lit(Decimal("0.01"))).cast(DecimalType(20, 4))


def fee_rate(scale: int, rate: Decimal = FEE_RATE, precision: int = 18) -> Column:
    """The rate as a decimal of the given scale (rounded half up)."""
    return F.lit(str(rate)).cast(DecimalType(precision, scale))


def fee(amount: Column, scale: int, rate: Decimal = FEE_RATE) -> Column:
    """Fee on one amount: ``decimal(18,2)`` times the rate rounded to ``scale``."""
    return to_amount(amount) * fee_rate(scale, rate)


def total_fee(total: Column, scale: int, rate: Decimal = FEE_RATE) -> Column:
    """Fee on a sum of amounts.

    Decimals are exact, so the rate times the sum equals the sum of the row fees, at
    the price of one multiplication per group instead of one wide sum per row.
    """
    product = total.cast(DecimalType(28, 2)) * fee_rate(scale, rate, precision=scale + 1)
    return product.cast(DecimalType(38, scale + 2))
