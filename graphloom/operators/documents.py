"""JSON documents as rows of (pointer, value), and their comparison as sets of such rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.session import materialise


def _step(name: Column) -> Column:
    """A member's name as a part of a JSON pointer."""
    return F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def pointer_rows(df: DataFrame, json: str, keep: Sequence[str] = (), ignore: Sequence[str] = ()) -> DataFrame:
    """(*keep, pointer, value) for each scalar and each empty container of the documents in a column of JSON texts.

    ``value`` is JSON text, so that 1 and "1" differ; a pointer names members and positions from the top, and is empty for
    a document that is a scalar. Members named in ``ignore`` are left out at any depth. Documents are opened level by level,
    all of them at once, so it runs as many jobs as they are deep; a NULL document has no rows, and text that is no JSON
    is fatal.
    """
    spark = df.sparkSession
    kept = list(keep)
    todo = df.where(F.col(json).isNotNull()).select(*kept, F.lit("").alias("pointer"), F.parse_json(json).alias("v"))
    found = None
    while True:
        text = F.to_json("v")
        kind = F.schema_of_variant("v")
        container = (kind.startswith("OBJECT") | kind.startswith("ARRAY")) & ~text.isin("{}", "[]")
        level = materialise(todo.select(*kept, "pointer", F.when(container, F.col("v")).alias("v"),
                                        F.when(~container, text).alias("value")), "documents")
        leaves = level.where("v is null").select(*kept, "pointer", "value")
        found = leaves if found is None else found.unionByName(leaves)
        opened = level.where("v is not null")
        if opened.isEmpty():
            return found
        inside = opened.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).toDF("at", "member", "inner"))
        shown = F.coalesce(_step(F.col("member")), F.col("at").cast("string"))
        todo = inside.where(~F.coalesce(F.col("member").isin(*ignore), F.lit(False)) if ignore else F.lit(True)).select(
            *kept, F.concat("pointer", F.lit("/"), shown).alias("pointer"), F.col("inner").alias("v"))


def document_differences(left: DataFrame, right: DataFrame, json: str, ignore: Sequence[str] = ("$id",)) -> DataFrame:
    """(pointer, value, side) of what the documents of only one side hold; no rows mean that both say the same."""
    sides = [pointer_rows(df, json, ignore=ignore).distinct().withColumn(name, F.lit(True)) for df, name in ((left, "_l"), (right, "_r"))]
    both = sides[0].join(sides[1], ["pointer", "value"], "full")
    side = F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right")
    return both.select("pointer", "value", side.alias("side")).where("side is not null")
