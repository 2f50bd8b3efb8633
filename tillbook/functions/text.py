"""Text expressions: emptiness, fallbacks and join keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that count as empty, and the state with two names.
EMPTY_TEXTS = ("", "0")
CAPITAL_LONG_NAME = "FEDERAL CAPITAL TERRITORY"
CAPITAL_SHORT_NAME = "Abuja"


def is_blankish(text: Column) -> Column:
    """True for null, ``""`` and ``"0"``; a blank ``" "`` is not empty."""
    return text.isNull() | text.isin(*EMPTY_TEXTS)


def first_non_empty(own: Column, *others: Column) -> Column:
    """First text that is not empty, else ``own`` as it is."""
    candidates = [F.when(~is_blankish(c), c) for c in (own, *others)]
    return F.coalesce(*candidates, own)


def canonical_state(state: Column) -> Column:
    """Trimmed state name, with the capital territory under its short name."""
    trimmed = F.trim(state)
    return F.when(F.upper(trimmed) == CAPITAL_LONG_NAME, CAPITAL_SHORT_NAME).otherwise(trimmed)


def match_key(text: Column) -> Column:
    """Case- and space-insensitive join key."""
    return F.upper(F.trim(text))


def without_nul(text: Column) -> Column:
    """Text without NUL characters."""
    return F.replace(text, F.lit("\x00"), F.lit(""))
