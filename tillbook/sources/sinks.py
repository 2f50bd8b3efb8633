"""Sinks.

A report is written by as many tasks as it has partitions; nothing is gathered into one
file.  ``rebalance`` evens out the files of a target with many partition values: adaptive
execution splits a hot partition over several tasks and packs small ones.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(
    df: DataFrame,
    path: str | None = None,
    *,
    table: str | None = None,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    unless_empty: DataFrame | None = None,
    **options: str,
) -> bool:
    """Append to or replace a target, given as a path, a catalog table or sink options.

    ``mode="overwrite"`` replaces everything; ``mode="overwrite_partitions"`` replaces
    only the partitions present in ``df``, so a rerun of a period is idempotent.
    ``rebalance`` costs a shuffle of the output; it pays when many tasks hold rows of many
    partition values, as in a backfill.

    ``unless_empty`` names the input without which there is nothing to write: when it has no
    row the target is left as it is and the result is False.  Give a scan rather than the
    report itself, so that the check reads one row instead of computing the report.
    """
    if unless_empty is not None and unless_empty.isEmpty():
        return False
    if mode == "overwrite_partitions":
        if not partition_by:
            raise ValueError("overwrite_partitions needs partition_by")
        mode, options = "overwrite", {**options, "partitionOverwriteMode": "dynamic"}
    if rebalance and partition_by and _adaptive(df.sparkSession):
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is not None:
        writer.saveAsTable(table)
    elif path is not None:
        writer.save(path)
    else:
        writer.save()
    return True


def _adaptive(spark: SparkSession) -> bool:
    # Without adaptive execution the hint is a plain hash shuffle and a hot value one task.
    return spark.conf.get("spark.sql.adaptive.enabled", "true") == "true"


def write_version(df: DataFrame, root: str, version: str) -> None:
    """Write a table as a new version next to the ones before it.

    A merge reads the current version, so its result must not replace those files.  The rows
    go to a folder of their own; one pointer row, written last, makes them the current
    version.  A write that died leaves no pointer, so it can be run again under its name; a
    name that has a pointer is never written again.
    """
    spark = df.sparkSession
    pointers = _pointers(spark, root)
    number = 1
    if pointers is not None:
        row = pointers.agg(
            F.max("number").alias("last"), F.count_if(F.col("version") == version).alias("same")
        ).first()
        if row["same"]:
            raise ValueError(f"version {version} exists already")
        number = row["last"] + 1
    folder = f"{root}/versions/{number}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    pointer = spark.createDataFrame([(number, version, folder)], POINTER)
    pointer.coalesce(1).write.mode("append").json(f"{root}/pointers")


POINTER = "number BIGINT, version STRING, folder STRING"


def _pointers(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per finished version; a small file each."""
    try:
        return spark.read.schema(POINTER).json(f"{root}/pointers")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_version(spark: SparkSession, root: str) -> DataFrame | None:
    """The version written last, or None before the first one."""
    pointers = _pointers(spark, root)
    if pointers is None:
        return None
    folder = pointers.agg(F.max_by("folder", "number")).first()[0]
    return None if folder is None else spark.read.parquet(folder)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The name of the version written last, or None before the first one."""
    pointers = _pointers(spark, root)
    return None if pointers is None else pointers.agg(F.max_by("version", "number")).first()[0]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in every part file; outer spaces of values are kept.

    CSV cannot tell empty text from null: both read back as null.
    """
    df.write.mode(mode).options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the session's checkpoint folder, which every executor can reach."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ensure_local_root(spark: SparkSession) -> None:
    """Give a session of one machine without a checkpoint folder one; others are left alone."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known and spark.sparkContext.master.split("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillbook-"))
