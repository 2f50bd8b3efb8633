"""Helpers shared by the training-text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.sinks import ensure_local_root, shared_folder

#: A word is a run of anything but ASCII white space; ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` lacks: the stems, with underscores before them as needed."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in stems:
        while name.lower() in taken:
            name = f"_{name}"
        names.append(name)
    return names


def steps(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs ``[start, stop)`` of rows whose sizes come to about ``most``, a row at least."""
    upto = np.cumsum(sizes)
    start = done = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(upto, done + most, "right")))
        yield start, stop
        start, done = stop, int(upto[stop - 1])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as remainder -1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % divisor, F.lit(-1))


def with_running(
    df: DataFrame, order: list[Column], value: str, rank: str, before: str, purpose: str
) -> DataFrame:
    """Add the 0-based position in ``order`` and the sum of ``value`` over all earlier rows.

    Rows are sorted into ranges; each range is numbered on its own and shifted by the totals
    of the ranges before it, one row per range.  The sorted table is stored in between, as a
    second range shuffle could cut elsewhere.
    """
    keys = {f"__k{i}": c for i, c in enumerate(order)}
    cut = df.withColumns(keys).repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
    cut = stored(cut.withColumn("__range", F.spark_partition_id()), purpose)
    inside = Window.partitionBy("__range").orderBy(
        *[F.col(k).asc_nulls_first() for k in keys]
    )
    sums = cut.groupBy("__range").agg(
        F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__v")
    )
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select(
        "__range",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n0"),
        F.coalesce(F.sum("__v").over(earlier), F.lit(0)).alias("__v0"),
    )
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumns(
            {
                rank: F.row_number().over(inside) - 1,
                before: F.coalesce(F.sum(value).over(upto), F.lit(0)),
            }
        )
        .join(F.broadcast(shift), "__range")
        .withColumns({rank: F.col(rank) + F.col("__n0"), before: F.col(before) + F.col("__v0")})
        .drop("__range", "__n0", "__v0", *keys)
    )


def importable(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let Python workers of this session import the library from where the driver has it.

    A cluster whose machines do not share that path needs the library installed or shipped
    with ``--py-files``, like any other.  A session of one machine gets a folder for the
    tables that operators store, unless it has one.
    """

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        ensure_local_root(spark)
        home = str(Path(__file__).resolve().parents[2])
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if home not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
                [p for p in paths if p] + [home]
            )
        return query(spark, *args)

    return run
