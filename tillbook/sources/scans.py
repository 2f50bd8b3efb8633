"""Scans.  Filters and projections are plain ``where``/``select``: Catalyst pushes them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.periods import Period, single_day
from ..functions.terminals import SUMMARY_WIDTH, normalise_terminal_id
from .columns import snake_columns, typed_times


@dataclass(frozen=True)
class Split:
    """How a relational table is read in parallel: ``parts`` ranges of ``column``.

    ``lower`` and ``upper`` only place the cuts; rows outside them are still read.
    """

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def scan(
    spark: SparkSession,
    fmt: str,
    path: str | Sequence[str] | None = None,
    *,
    schema: StructType | str | None = None,
    where: Column | None = None,
    columns: Sequence[str | Column] | None = None,
    **options: str,
) -> DataFrame:
    """Read any source; without ``schema`` the source's own or an inferred one is used."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path is not None else reader.load()
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns is not None else df


def table_options(split: Split | None = None, **options: str) -> dict[str, str]:
    """Reader options of a relational scan; the connection comes from the caller."""
    if split is not None and "query" in options:
        raise ValueError("a split read needs dbtable (a subquery is allowed), not query")
    return {"fetchsize": "10000", **options, **(split.options() if split else {})}


def read_table(
    spark: SparkSession,
    fmt: str = "jdbc",
    path: str | None = None,
    *,
    where: Column | None = None,
    columns: Sequence[str | Column] | None = None,
    split: Split | None = None,
    **options: str,
) -> DataFrame:
    """Read a table as its catalog describes it, relational ones in parallel ranges."""
    if fmt == "jdbc":
        options = table_options(split, **options)
    return scan(spark, fmt, path, where=where, columns=columns, **options)


def table_if_exists(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or None before its first load (the merges take None as target)."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def for_day(df: DataFrame, ts: str, day: date) -> DataFrame:
    """Rows of one calendar day, as a range on the raw column."""
    return df.where(single_day(day).contains(F.col(ts)))


def within(
    df: DataFrame, period: Period, ts: str, month_column: str | None = None
) -> DataFrame:
    """Rows of a period, the time typed first where it is text.

    ``month_column`` names a partition column with the month key; months outside the period
    are then pruned, also where the time is text and the range cannot reach the footers.
    """
    if month_column:
        df = df.where(F.col(month_column).isin(*period.months()))
    return typed_times(df, ts).where(period.contains(F.col(ts)))


def read_sheets(
    spark: SparkSession,
    root: str,
    sheet: str,
    *,
    id_column: str = "terminal_id",
    width: int = SUMMARY_WIDTH,
) -> DataFrame:
    """One sheet of every workbook under ``root/workbook=*/sheet=*/*.csv``.

    Headers become snake_case, everything stays text, and the id column is normalised.
    A workbook whose header differs from the others fails the read instead of shifting
    columns.
    """
    df = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("basePath", root)
        .csv(f"{root}/workbook=*/sheet={sheet}")
        .drop("workbook", "sheet")
    )
    df = snake_columns(df)
    if id_column in df.columns:
        df = df.withColumn(id_column, normalise_terminal_id(F.col(id_column), width))
    return df


def read_typed_sheet(
    spark: SparkSession,
    root: str,
    sheet: str,
    *,
    schema: StructType | str | None = None,
    positional: bool = False,
) -> DataFrame:
    """One sheet of every workbook with typed columns; empty cells are null.

    With ``schema`` the files are read once; without it a first pass infers the types.  A
    workbook whose header differs fails the read, unless ``positional`` says that columns go
    by their place.
    """
    reader = _csv(spark, schema, positional).option("nullValue", "").option("basePath", root)
    return reader.csv(f"{root}/workbook=*/sheet={sheet}").drop("workbook", "sheet")


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType | str | None = None,
    positional: bool = False,
) -> DataFrame:
    """CSV with a header; declare ``schema`` on large files to save the inference pass.

    Files whose headers differ fail the read, unless ``positional``.
    """
    return _csv(spark, schema, positional).csv(path)


def read_drop(
    spark: SparkSession,
    root: str,
    *,
    pattern: str = "*.csv",
    skip: str | None = None,
    schema: StructType | str | None = None,
    source_column: str | None = None,
    positional: bool = False,
) -> DataFrame:
    """Every matching file of a directory as one frame.

    Files whose name contains ``skip`` are left out before anything is read, so neither the
    header nor the inferred types come from them; the names are those Spark lists anyway.
    Files whose headers differ fail the read, unless ``positional``.  With ``source_column``
    each row keeps the name of its file.
    """
    paths: str | list[str] = root
    if skip:
        files = spark.read.option("pathGlobFilter", pattern).text(root).inputFiles()
        paths = [f for f in files if skip not in unquote(f.rsplit("/", 1)[1])]
        if not paths:
            raise FileNotFoundError(f"no file of {root} matches {pattern} without {skip}")
        paths = [unquote(f) for f in paths]
    df = _csv(spark, schema, positional).option("pathGlobFilter", pattern).csv(paths)
    if source_column:
        return df.select(*df.columns, F.col("_metadata.file_name").alias(source_column))
    return df


def _csv(
    spark: SparkSession, schema: StructType | str | None, positional: bool
) -> DataFrameReader:
    reader = spark.read.option("header", True).option("enforceSchema", positional)
    return reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
