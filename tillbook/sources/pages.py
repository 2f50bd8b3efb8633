"""A table laid out for reading in pages by key.

Rows are cut into ranges of the key, a sorted file each, and an index keeps what every file
holds.  A page is found in the index, so it opens the files it lies in and no others, however
far into the table it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST, LAST, ROWS, FILE = "first", "last", "rows", "file"


def write_pages(df: DataFrame, path: str, key: str, files: int) -> None:
    """Write ``df`` as ``files`` sorted ranges of ``key`` with their index.

    Rows without a key are in no page and are left out.  Equal keys lie in one file.
    """
    spark = df.sparkSession
    keyed = df.where(F.col(key).isNotNull())
    keyed.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(f"{path}/rows")
    # Footers hold the bounds, so only the key column is read; a row a file.
    spark.read.schema(df.schema).parquet(f"{path}/rows").groupBy(F.col("_metadata.file_path").alias(FILE)).agg(
        F.min(key).alias(FIRST), F.max(key).alias(LAST), F.count(F.lit(1)).alias(ROWS)
    ).coalesce(1).write.parquet(f"{path}/index")


def page_files(spark: SparkSession, path: str, after: object | None, size: int) -> list[str]:
    """The files that hold the ``size`` rows after a key, in order.

    The first may hold the key itself, so that some of its rows come before the page.
    """
    index = spark.read.parquet(f"{path}/index")
    if after is not None:
        index = index.where(F.col(LAST) > F.lit(after))
    found, rows = [], 0
    for row in index.orderBy(FIRST).toLocalIterator():
        found.append(row[FILE])
        # Of the first file it is not known how many rows lie after the key: one at least.
        rows += row[ROWS] if after is None or row[FIRST] > after else 1
        if rows >= size:
            break
    return found


def read_page(
    spark: SparkSession, path: str, key: str, after: object | None, size: int
) -> DataFrame | None:
    """The ``size`` rows after a key in ascending order, ties cut as they come; None at the end."""
    files = page_files(spark, path, after, size)
    if not files:
        return None
    rows = spark.read.parquet(*files)
    if after is not None:
        rows = rows.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(size)
