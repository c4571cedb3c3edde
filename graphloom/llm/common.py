"""Reading tables and sizing jobs for the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graphloom.session import materialise, shared_folder

__all__ = ["ambiguous", "materialise", "numbered", "parts_for", "remainder", "shared_folder", "table", "text_bytes"]

#: Character class of words that are split at white space only.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``: the fold of a document."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")),
                  F.lit(by))


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text)).cast("long")), F.lit(0))).first()[0]


def ambiguous(docs: DataFrame, doc_id: str) -> bool:
    """Whether ids repeat or are missing, so that they do not tell rows apart."""
    many = docs.groupBy(F.col(doc_id).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return not many.where((F.col("n") > 1) | F.col("id").isNull()).isEmpty()


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs``, written, with a number of each row that stays the same however often it is read."""
    return materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")


def parts_for(spark: SparkSession, size: int, part: int) -> int:
    """As many partitions as keep each at about ``part`` bytes, and no fewer than the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / part))
