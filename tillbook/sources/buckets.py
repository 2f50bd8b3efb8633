"""Tables cut by a hash of their key.

``KeyedTable`` is a table of files whose versions share what did not change: an upsert reads,
joins and writes the buckets that its source touches and no others.  ``write_bucketed`` makes a
catalog table bucketed and sorted by its key, so that joins and aggregations by it need no
shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import merge_upsert

MANIFEST = "number BIGINT, version STRING, bucket INT, folder STRING"
_BUCKET = "__bucket"
#: Rows without a key match nothing, so they have a bucket of their own that is only added to.
KEYLESS = -1


@dataclass(frozen=True)
class KeyedTable:
    """A table under ``root`` in ``buckets`` parts by the hash of ``key``.

    A version is a list of folders, one or, for rows without a key, several to a bucket.  The
    list is written last, in one file, so a load that died leaves no trace, and a lost executor
    costs no more than its tasks.  A version's name is used once.
    """

    root: str
    key: str
    buckets: int = 64

    def _bucket(self) -> Column:
        hashed = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        return F.when(F.col(self.key).isNull(), KEYLESS).otherwise(hashed)

    def _manifest(self, spark: SparkSession, new: str | None = None) -> list:
        """The rows of the latest version, one a bucket and so few; none before the first."""
        try:
            rows = spark.read.schema(MANIFEST).json(f"{self.root}/manifests")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        if new is not None and not rows.where(F.col("version") == new).isEmpty():
            raise ValueError(f"version {new} exists already")
        return rows.where(F.col("number") == rows.agg(F.max("number")).scalar()).collect()

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The latest version, or None before the first one."""
        held = self._manifest(spark)
        return self._parts(spark, held) if held else None

    def _parts(self, spark: SparkSession, rows: Sequence) -> DataFrame:
        schema = self._schema(spark)
        paths = [
            f"{self.root}/data/{r['folder']}/{_BUCKET}={r['bucket']}"
            for r in rows
            if r["bucket"] is not None
        ]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*paths)

    def _schema(self, spark: SparkSession):
        # The first load writes an empty file of its columns, whatever rows it has.
        return spark.read.parquet(f"{self.root}/schema").schema

    def _write(self, rows: DataFrame, folder: str) -> list[int]:
        """Write the buckets of some rows, a file each; return which."""
        placed = rows.withColumn(_BUCKET, self._bucket())
        # Keyless rows may be many: they stay in the tasks that they are in.
        keyed = placed.where(F.col(_BUCKET) != KEYLESS).repartition(_BUCKET)
        path = f"{self.root}/data/{folder}"
        keyed.unionByName(placed.where(F.col(_BUCKET) == KEYLESS)).write.partitionBy(_BUCKET).parquet(path)
        spark = rows.sparkSession
        try:
            written = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return []  # no rows, no files
        return [r[0] for r in written.select(_BUCKET).distinct().collect()]

    def _commit(self, spark: SparkSession, number: int, version: str, parts: list) -> None:
        rows = [(number, version, bucket, folder) for bucket, folder in parts]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifests")

    def upsert(
        self,
        source: DataFrame,
        version: str,
        update: Sequence[str] | None = None,
        *,
        source_unique: bool = False,
    ) -> list[int]:
        """Merge as ``merge_upsert`` does; return the buckets that were written anew.

        The first load replaces: it is the source itself.
        """
        spark = source.sparkSession
        held = self._manifest(spark, version)
        number = held[0]["number"] + 1 if held else 1
        folder = f"{number}-{uuid.uuid4().hex}"
        if not held:
            source.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/schema")
            written = self._write(source, folder)
            # An empty first load is a version all the same.
            self._commit(spark, number, version, [(b, folder) for b in written] or [(None, folder)])
            return written
        touched = {r[0] for r in source.select(self._bucket()).distinct().collect()}
        parts = [r for r in held if r["bucket"] in touched and r["bucket"] != KEYLESS]
        merged = merge_upsert(
            self._parts(spark, parts), source, self.key, update,
            source_unique=source_unique, one_join=True,
        )
        written = self._write(merged, folder)
        rest = [
            (r["bucket"], r["folder"])
            for r in held
            if r["bucket"] is not None and (r["bucket"] not in touched or r["bucket"] == KEYLESS)
        ]
        self._commit(spark, number, version, rest + [(b, folder) for b in written] or [(None, folder)])
        return sorted(written)


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int = 64, path: str | None = None
) -> None:
    """Replace a catalog table by ``df``, bucketed and sorted by ``key``, a file a bucket.

    Its files are under ``path``, or in the warehouse.

    Tables of the same number of buckets join and aggregate by the key without a shuffle.  Take
    enough buckets that one, with its hottest key, fits a task.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
