"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis and Spirakis).

A document's key is an exponential variate divided by its quality weight, made from a digest of its id, so reruns
agree. Within a source documents are taken by ascending key until the token budget is reached; budgets beyond a
source's size take whole epochs first and sample only the rest.

The prefix sum over a source needs no sorted source: keys fall into fine bins in key order, bins are summed, and
only the one bin of each source in which the budget ends is sorted. A source with most of the rows has as many
bins as any, so no task gets a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from graphloom.llm.common import PLAIN_WORD, ambiguous, materialise, numbered

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"
ROWS_PER_BIN = 2000


def quality_weight(text: Column) -> Column:
    """1 for plain text, less the more of its characters are symbols."""
    size = F.length(text).cast("double")
    symbols = size - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.when(size > 0, size / (size + 20 * symbols)).otherwise(F.lit(1.0))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    digest = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary")), 1, 12)
    uniform = (F.conv(digest, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))
    return -F.log(uniform) / weight


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) -> with target: shares by weight, stopped at ``most`` sizes, the excess reshared.

    Filling to a level: with sources in order of limit / weight, those whose limit lies below the level that the
    rest would get are full, and the others share what is left by weight. One row a source.
    """
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") % len(weights) + 1)
    ranked = (sizes.withColumn("rank", (F.row_number().over(
        everything.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int"))
        .withColumn("weight", weight).withColumn("limit", (most * F.col("source_size")).cast("double")))
    by_ratio = everything.orderBy(F.col("limit") / F.col("weight"), "rank")
    level = ((F.lit(share) * F.sum("source_size").over(everything)
              - F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    filled = ranked.withColumn("level", level).withColumn("open", F.col("limit") > F.col("level") * F.col("weight"))
    first = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "rank", "level"))).over(everything)
    return (filled.withColumn("level", first["level"])
            .withColumn("target", F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.col("limit")))
            .select("source", "source_size", "target"))


def plan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         whole: bool = False, seed: str = SEED, weight: Column | None = None, weights: tuple = WEIGHTS,
         share: float = SHARE, most: int = MOST, row: str | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies) per document row, and its column ``row`` if asked for.

    ``taken`` counts words, repeats included. The document in which a budget ends gives its first words, or with
    ``whole`` all of them if at least half of them fit. ``copies`` is the number of times a document occurs, cut
    or not. Null texts have size 0 and are taken with no words; a null source is a source of its own, the last;
    rows with equal ids have equal keys and are taken one after the other; an empty table gives an empty plan.
    """
    weight = quality_weight(F.col(text)) if weight is None else weight
    key = sampling_key(F.col(doc_id), weight, seed)
    bins = max(64, documents.count() // ROWS_PER_BIN)
    rows = materialise(documents.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(PLAIN_WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"), *([row] if row else []),
    ).withColumn("bin", F.floor(F.col("key") / (F.col("key") + 1) * bins).cast("long")), "mix-rows")

    by_bin = rows.groupBy("source", "bin").agg(F.sum("size").alias("s"))
    wanted = (targets(by_bin.groupBy("source").agg(F.sum("s").alias("source_size")), weights, share, most)
              .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                          .otherwise(F.lit(0)).cast("long"))
              .withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size")))
    before = F.coalesce(F.sum("s").over(Window.partitionBy("source").orderBy("bin")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    budget = wanted.select("source", "source_size", "target", "epochs", "left")
    summed = by_bin.withColumn("before", before)
    ends = _join(summed, budget.select("source", "left")).where(
        (F.col("before") < F.col("left")) & (F.col("left") <= F.col("before") + F.col("s"))
    ).select("source", F.col("bin").alias("end_bin"), "before")
    budget = materialise(_join(budget, ends, "left"), "mix-budget")

    known = _join(rows, budget)
    inside = known.where(F.col("bin") == F.col("end_bin"))
    outside = known.where(~F.col("bin").eqNullSafe(F.col("end_bin")))
    order = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size", *([row] if row else []))
    prior = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = F.col("left") - F.col("before") - prior
    part = (F.when(room >= F.col("size") / 2, F.col("size")).otherwise(F.lit(0)) if whole
            else F.greatest(F.lit(0), F.least(F.floor(room), F.col("size"))))
    inside = inside.withColumn("part", part.cast("long"))
    outside = outside.withColumn("part", F.when(F.col("bin") < F.col("end_bin"), F.col("size")).otherwise(F.lit(0)).cast("long"))
    return inside.unionByName(outside).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
        (F.col("epochs") + (F.col("part") > 0).cast("long")).alias("copies"), *([row] if row else []))


def _join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Equal sources, null equal to null."""
    right = right.withColumnRenamed("source", "__source")
    return left.join(right, left["source"].eqNullSafe(right["__source"]), how).drop("__source")


def mix(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed documents: each row as often as its own plan says, all of its columns; rows not taken are left out."""
    if ambiguous(documents, doc_id):
        rows = numbered(documents, "__row")
        copies = plan(rows, doc_id, text, source, whole=True, row="__row", **options).where("copies > 0").select(
            "__row", F.col("copies").alias("__copies"))
        return rows.join(copies, "__row").withColumn(
            "__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(documents.columns)
    counts = (plan(documents, doc_id, text, source, whole=True, **options)
              .groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"))
              .agg(F.max("copies").alias("__copies")))
    counts = counts.where(F.col("__copies") > 0)
    joined = documents.join(counts, documents[doc_id].eqNullSafe(counts["__id"])
                            & documents[source].eqNullSafe(counts["__source"]))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(
        *[documents[c] for c in documents.columns])
