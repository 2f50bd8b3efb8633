"""Documents without a schema, read in one pass: a line of JSON is a VARIANT.

Nothing is inferred, so no job reads the documents before the query does, and a field that is a
number in one document and text in another keeps both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOC, DAMAGED = "doc", "damaged"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each line as ``doc``; one that is no JSON has a null there and its text in ``damaged``."""
    parsed = spark.read.text(path).select("value", F.try_parse_json("value").alias(DOC))
    broken = F.col(DOC).isNull() & (F.trim("value") != "")
    return parsed.select(DOC, F.when(broken, F.col("value")).alias(DAMAGED)).where(
        F.col(DOC).isNotNull() | F.col(DAMAGED).isNotNull()
    )


def field(name: str, as_type: str = "string", doc: str = DOC) -> Column:
    """A field of a document; null where it is missing or does not fit the type.

    As ``string`` every value fits: numbers as they print, objects and lists as JSON.
    """
    mark = '"' if "'" in name else "'"
    return F.try_variant_get(F.col(doc), f"$[{mark}{name}{mark}]", as_type).alias(name)


def document_columns(documents: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The documents as columns; damaged lines are left out."""
    held = documents.where(F.col(DOC).isNotNull())
    return held.select(*[field(name, as_type) for name, as_type in types.items()])


def described(documents: DataFrame) -> str:
    """The fields of all documents with their types, in one aggregate; mixed ones are VARIANT."""
    return documents.agg(F.schema_of_variant_agg(DOC)).first()[0]
