"""Header and whole-row column rules.  Each is one projection, whatever the width."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import without_nul


def string_schema(names: Sequence[str]) -> StructType:
    """All-text schema, one nullable field per name."""
    return StructType([StructField(name, StringType(), True) for name in names])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return _renamed(df, list(names))


def lower_columns(df: DataFrame) -> DataFrame:
    return _renamed(df, [name.lower() for name in df.columns])


def snake_case(header: str) -> str:
    """``merchantName``, ``Terminal ID``, ``State-Code`` to snake_case.

    A word ends at white space or hyphens, of which a run counts once, and where a capital
    follows a small letter or a digit.
    """
    out: list[str] = []
    last = ""
    for char in header:
        gap = char.isspace() or char == "-"
        if gap and out and out[-1] == "_" and last == "gap":
            continue
        if gap:
            out.append("_")
        elif char.isascii() and char.isupper() and last == "small":
            out.append("_" + char.lower())
        else:
            out.append(char.lower())
        small = char.isascii() and (char.islower() or char.isdigit())
        last = "gap" if gap else "small" if small else ""
    return "".join(out)


def snake_columns(df: DataFrame) -> DataFrame:
    return _renamed(df, [snake_case(name) for name in df.columns])


def conform_header(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name the leading columns by position; further columns keep their own name."""
    kept = df.columns[len(names):]
    return _renamed(df, [*names[: len(df.columns)], *kept])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns that exist; absent names are ignored."""
    return df.drop(*names)


def add_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Add literal columns; a ``Column`` (such as a typed null) is taken as it is."""
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in constants.items()}
    )


def all_to_string(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(_quoted(name)).cast("string").alias(name) for name in df.columns])


def strip_nul(df: DataFrame) -> DataFrame:
    """Remove NUL characters from every text column."""
    return df.select(
        *[
            without_nul(F.col(_quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(_quoted(f.name))
            for f in df.schema.fields
        ]
    )


def declared_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project to ``names``; a field the source lacks becomes a null text column."""
    present = set(df.columns)
    return df.select(
        *[
            F.col(_quoted(n)) if n in present else F.lit(None).cast("string").alias(n)
            for n in names
        ]
    )


def typed_times(df: DataFrame, *names: str) -> DataFrame:
    """Text timestamps as timestamps, malformed ones as null; typed columns stay as they are.

    Document stores are read with an all-text schema.  ``2025-01-02T03:04:05.678Z`` keeps its
    wall clock.
    """
    text = [n for n in names if isinstance(df.schema[n].dataType, StringType)]
    return df.withColumns({n: F.col(n).try_cast("timestamp_ntz") for n in text}) if text else df


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    clashes = sorted({n for n in names if [m.lower() for m in names].count(n.lower()) > 1})
    if clashes:
        raise ValueError(f"renaming makes columns collide: {clashes}")
    return df.toDF(*names)
