"""Revision diffs and the application of change records to current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.functions import ids
from graphloom.operators.sequence import latest_by_key, merged, packed_ids


def missing_from(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    return left.join(merged(right.select(*on)), list(on), "left_anti")


def stale_rows(previous: DataFrame, current: DataFrame, touched: DataFrame, group: str, key: str) -> DataFrame:
    """Rows of ``previous`` that their group no longer has, for the ``touched`` groups only.

    Groups that are not part of this batch keep all their rows.
    """
    in_batch = previous.join(merged(touched.select(group)), group, "left_semi")
    return missing_from(in_batch, current, [group, key])


def set_digests(df: DataFrame, group: str, key: str, out: str) -> DataFrame:
    """One text per group that depends on its set of keys alone: their number, and the sum and the exclusive or of
    64-bit hashes of them. All three are fixed in width and combined before the shuffle. Keys must not repeat in a group."""
    digest = F.concat_ws("-", F.count(key), F.bit_xor(F.xxhash64(key)), F.sum(F.shiftrightunsigned(F.xxhash64(F.lit("second"), key), 24)))
    return df.groupBy(group).agg(digest.alias(out))


def unchanged_groups(previous: DataFrame, current: DataFrame, group: str, key: str) -> DataFrame:
    """Groups that have the same set of keys on both sides, by their digests; no keys are joined."""
    return set_digests(previous, group, key, "digest").join(
        set_digests(current, group, key, "digest"), [group, "digest"]).select(group)


def compare_sets(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys that are missing from ``actual`` or stale in it; one outer join of distinct keys."""
    left = expected.select(key).distinct().withColumn("_expected", F.lit(True))
    right = actual.select(key).distinct().withColumn("_actual", F.lit(True))
    return (
        left.join(right, key, "full")
        .withColumn("difference", F.when(F.col("_actual").isNull(), "missing")
                    .when(F.col("_expected").isNull(), "stale"))
        .filter("difference is not null").select(key, "difference")
    )


def apply_changes(log: DataFrame, key: str, order: Sequence[str], deleted: Column) -> DataFrame:
    """Current rows: the last change of each key, unless it is a delete."""
    marked = log.withColumn("_deleted", F.coalesce(deleted, F.lit(False)))
    return latest_by_key(marked, [key], order).filter("not _deleted").drop("_deleted")


def last_deletes(log: DataFrame, key: str, order: str, deleted: Column) -> DataFrame:
    """When each key was last deleted, for keys that ever were."""
    return log.filter(deleted).groupBy(key).agg(F.max(order).alias("deleted_at"))


def detach(edges: DataFrame, deletes: DataFrame, key: str, source: str, target: str, order: str) -> DataFrame:
    """Drop edges that touch a deleted node, except those written after the delete."""
    for end in (source, target):
        gone = deletes.select(F.col(key).alias(end), F.col("deleted_at").alias("_gone_at"))
        edges = edges.join(gone, end, "left").filter(
            F.col("_gone_at").isNull() | (F.col(order) >= F.col("_gone_at"))).drop("_gone_at")
    return edges


def placeholders(nodes: DataFrame, edges: DataFrame, key: str, source: str, target: str) -> DataFrame:
    """Endpoints of ``edges`` that are no known node. Each side is made distinct before the shuffle
    that joins them, so an endpoint with very many edges costs one row per task."""
    ends = edges.select(F.col(source).alias(key)).unionByName(
        edges.select(F.col(target).alias(key))).filter(F.col(key).isNotNull()).distinct()
    return missing_from(ends, nodes, [key])


def with_placeholders(nodes: DataFrame, edges: DataFrame, key: str, source: str, target: str) -> DataFrame:
    """``nodes`` plus a row with only the key set for each endpoint that is still unknown."""
    return nodes.unionByName(placeholders(nodes, edges, key, source, target), allowMissingColumns=True)


def graph_in_files(nodes: DataFrame, edges: DataFrame, order: Sequence[str]) -> DataFrame:
    """(file_id, kind, id) of the current nodes and edges, kind ``node`` or ``edge``, and of the placeholders, with that
    kind and without a file: what ``apply_changes``, ``detach`` and ``with_placeholders`` give, if edges stay in their file
    and an id belongs to one file.

    ``nodes`` and ``edges`` are changes: file_id, own_id, deleted, changed_at and the columns of ``order``; edges also have
    source_id and target_id. Everything is dealt out once, by file, with packed ids. In a file the last change of each id
    counts; then the ends of its edges are sorted behind the node they name.
    """
    rows = nodes.withColumn("kind", F.lit("node")).unionByName(edges.withColumn("kind", F.lit("edge")), allowMissingColumns=True)
    deleted = F.coalesce("deleted", F.lit(False))
    last = packed_ids(rows).repartition("file_id").groupBy("file_id", "kind", "own_id").agg(
        F.max_by(F.struct(deleted.alias("deleted"), "source_id", "target_id", "changed_at"), F.struct(*order)).alias("_last"),
        F.max(F.when(deleted, F.col("changed_at"))).alias("gone_at")).select("file_id", "kind", "own_id", "_last.*", "gone_at")
    is_node, own = F.col("kind") == "node", F.col("own_id")
    end = lambda node: F.struct(node.alias("node_id"), own.alias("own_id"))
    touched = last.filter(is_node | ~F.col("deleted")).withColumn(
        "_ends", F.when(is_node, F.array(end(own))).otherwise(F.array(end(F.col("source_id")), end(F.col("target_id")))))
    ends = touched.select("file_id", "kind", "deleted", "gone_at", "changed_at", F.inline("_ends"))
    # a node comes before the ends that name it
    window = Window.partitionBy("file_id").orderBy("node_id", F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    node = F.last(F.when(is_node, F.struct("node_id", "deleted", "gone_at")), ignorenulls=True).over(window)
    named = F.coalesce(F.col("_node.node_id") == F.col("node_id"), F.lit(False))
    alive = named & ~F.col("_node.deleted")
    gone_at = F.when(named, F.col("_node.gone_at"))
    stays = F.when(is_node, alive).otherwise(F.coalesce(gone_at.isNull() | (F.col("changed_at") >= gone_at), F.lit(False)))
    found = ends.withColumn("_node", node).groupBy("file_id", "kind", "own_id").agg(
        F.bool_and(stays).alias("_stays"), F.collect_set(F.when(~is_node & ~alive, F.col("node_id"))).alias("_unknown"))
    entry = lambda kind, id, placeholder: F.struct(kind.alias("kind"), id.alias("own_id"), F.lit(placeholder).alias("placeholder"))
    view = found.filter("_stays").select("file_id", F.inline(F.concat(
        F.array(entry(F.col("kind"), own, False)), F.transform("_unknown", lambda id: entry(F.lit("node"), id, True))))).distinct()
    return view.select(F.when(~F.col("placeholder"), F.col("file_id")).alias("file_id"), "kind", ids.unpacked(own).alias("id"))


def retain(log: DataFrame, time: str, now: Column, days: int = C.ERROR_RETENTION_DAYS) -> DataFrame:
    """Records not older than ``days``."""
    return log.filter(F.col(time) >= now - F.expr(f"interval {days} days"))
