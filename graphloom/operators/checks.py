"""Integrity, reconciliation and replay checks as aggregates that give report rows.

Integrity reports tag the ids of all their tables, group them by id once and read every figure off that; comparisons
are anti or outer joins of distinct keys, and verdicts are one row; lists in a report hold differences, whose number is also given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.operators.changes import compare_sets


# --- fixed values: texts of the mismatches in a report -------------------------------
DIFFERS = "%s: expected %s, got %s"
DUPLICATES = "duplicate %s values detected"
EDGES_OF_TYPE = "%s edges"
OTHER_ID = "_id != file_id for %s documents"
MISSING_FILES = "%s manifest files are missing"
UNEXPECTED_DOCUMENTS = "%s unexpected documents exist"
ABSENT_FIELD = "%s is absent in %s documents"
# -------------------------------------------------------------------------------------


def totals(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Rows, and distinct keys. Grouping by key first leaves no task with a whole duplicate group."""
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias(f"{prefix}_total"),
        F.count(key).alias(f"{prefix}_distinct"))


def breakdown(df: DataFrame, kind: Column, placeholder: str = C.PLACEHOLDER) -> DataFrame:
    """Rows per kind, most frequent first; NULL kinds count under the placeholder."""
    return (
        df.groupBy(F.coalesce(kind, F.lit(placeholder)).alias("kind")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "kind")
    )


def duplicates(df: DataFrame, key: str, limit: int | None = 10) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    found = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return found.orderBy(F.desc("n"), key).limit(limit) if limit else found


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    return duplicates(df, key, None).agg(F.count("*").alias("duplicate_ids"))


def top_groups(df: DataFrame, group: str, limit: int = 20) -> DataFrame:
    """Largest groups, with the group itself breaking ties."""
    counted = df.groupBy(group).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), group).limit(limit)


def missing_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows that lack each of the fields, one report row per field; one pass over the data."""
    counted = df.agg(*(F.count_if(F.col(f).isNull()).alias(f) for f in fields))
    entries = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("missing")) for f in fields))
    return counted.select(F.inline(entries))


def one_row(*reports: DataFrame) -> DataFrame:
    """Side by side columns of one-row reports: their union, reduced to the values present."""
    merged = reports[0]
    for report in reports[1:]:
        merged = merged.unionByName(report, allowMissingColumns=True)
    return merged.agg(*(F.max(name).alias(name) for name in merged.columns))


def tagged_ids(df: DataFrame, tags: Sequence[tuple[str, str, int]], flags: Mapping[str, Column] | None = None) -> DataFrame:
    """(space, id, mask) for each row of ``df`` and each (space, column, mask) of ``tags``; the first tag's rows also
    count the ``flags`` of their row. Ids are compared within their space only. One scan."""
    flags = flags or {}
    none = F.lit(0)
    entry = lambda i, space, column, mask: F.struct(
        F.lit(space).alias("space"), F.col(column).cast("string").alias("id"), F.lit(mask).alias("mask"),
        *(F.coalesce(flag.cast("int"), none).alias(name) if i == 0 else none.alias(name) for name, flag in flags.items()))
    return df.select(F.inline(F.array(*(entry(i, *tag) for i, tag in enumerate(tags)))))


def census(*parts: DataFrame) -> DataFrame:
    """One row per (space, id) of tagged ids: how often it comes with each bit of its masks (``n1``, ``n2``, ``n4``), and
    its flags. A partial aggregate: an id with very many rows is one row a task before the only shuffle."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    flags = [c for c in rows.columns if c not in ("space", "id", "mask")]
    bits = [F.count_if(F.col("mask") == bit).alias(f"n{bit}") for bit in (1, 2, 4)]
    return rows.groupBy("space", "id").agg(*bits, *(F.sum(f).alias(f) for f in flags))


def _in(space: str, condition: str = "true") -> Column:
    return F.count_if((F.col("space") == space) & F.expr(condition))


def _rows_in(space: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("space") == space, F.col("n1"))), F.lit(0))


def _total_and_distinct(space: str, total: str, distinct: str) -> list[Column]:
    return [_rows_in(space).alias(total), _in(space, "n1 > 0 and id is not null").alias(distinct)]


def _graph_ids(nodes: DataFrame, edges: DataFrame, node_flags: Mapping[str, Column] | None = None,
               edge_flags: Mapping[str, Column] | None = None) -> list[DataFrame]:
    """Ids of nodes (mask 1) and of the ends of edges (2 and 4) in one space, ids of edges in another."""
    return [
        tagged_ids(nodes, [("node", "node_id", 1)], node_flags),
        tagged_ids(edges, [("edge", "edge_id", 1), ("node", "source_id", 2), ("node", "target_id", 4)], edge_flags),
    ]


def corpus_integrity(nodes: DataFrame, edges: DataFrame, metadata: DataFrame, errors: DataFrame,
                     expected_files: int) -> DataFrame:
    """Unique ids, complete endpoints, all files present and no errors: PASS or FAIL. One scan of each table and one
    shuffle, by id."""
    found = census(
        *_graph_ids(nodes, edges), tagged_ids(metadata, [("file", "file_id", 1)]),
        tagged_ids(errors.select(F.lit("").alias("any")), [("error", "any", 1)]))
    missing = "n1 = 0 and id is not null and {} > 0".format
    report = found.agg(
        *_total_and_distinct("node", "node_events", "distinct_node_ids"),
        *_total_and_distinct("edge", "edge_events", "distinct_edge_ids"),
        *_total_and_distinct("file", "metadata_events", "distinct_metadata_file_ids"),
        _rows_in("error").alias("error_events"),
        _in("node", missing("n2")).alias("missing_edge_sources"), _in("node", missing("n4")).alias("missing_edge_targets"))
    good = F.expr(
        "node_events = distinct_node_ids and edge_events = distinct_edge_ids and error_events = 0 "
        "and missing_edge_sources = 0 and missing_edge_targets = 0"
    ) & (F.col("metadata_events") == expected_files) & (
        F.col("distinct_metadata_file_ids") == expected_files)
    return report.withColumn("status", F.when(good, "PASS").otherwise("FAIL"))


def graph_snapshot(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Counts of a stored graph: totals, distinct ids, placeholders, edges by type. One scan of each table, one shuffle."""
    kinds = {k: F.col("edge_type") == k for k in C.EDGE_TYPES}
    found = census(
        tagged_ids(nodes, [("node", "node_id", 1)], {"placeholder_nodes": F.col("node_type").isNull()}),
        tagged_ids(edges, [("edge", "edge_id", 1)], kinds))
    flag = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return found.agg(
        *_total_and_distinct("node", "total_nodes", "distinct_node_ids"),
        *_total_and_distinct("edge", "total_edges", "distinct_edge_ids"),
        flag("placeholder_nodes"), *(flag(k) for k in kinds))


def file_counts(nodes: DataFrame, edges: DataFrame, file_id: str) -> DataFrame:
    """Nodes and edges of one file."""
    of_file = lambda df, name: df.filter(F.col("file_id") == file_id).agg(F.count("*").alias(name))
    return one_row(of_file(nodes, "file_nodes"), of_file(edges, "file_edges"))


def times_of_file(nodes: DataFrame, file_id: str) -> DataFrame:
    """Nodes of one file per event time, newest first."""
    return (
        nodes.filter(F.col("file_id") == file_id).groupBy("event_time").agg(F.count("*").alias("n"))
        .orderBy(F.desc("event_time"))
    )


def times_by_file(nodes: DataFrame, file: str = "file_id", time: str = "event_time") -> DataFrame:
    """Nodes per file and event time, newest first within a file."""
    return nodes.groupBy(file, time).agg(F.count("*").alias("n")).orderBy(file, F.desc(time))


def counts_by_file(nodes: DataFrame, edges: DataFrame, file: str = "file_id") -> DataFrame:
    """Nodes and edges of every file that has any."""
    per_file = lambda df, name: df.groupBy(file).agg(F.count("*").alias(name))
    none = F.lit(0).cast("long")
    return per_file(nodes, "file_nodes").join(per_file(edges, "file_edges"), file, "full").select(
        file, F.coalesce("file_nodes", none).alias("file_nodes"),
        F.coalesce("file_edges", none).alias("file_edges"))


def rollup(files: DataFrame, by: Sequence[str], failed: Column, sums: Mapping[str, str]) -> DataFrame:
    """Files, failed files and summed counters per group."""
    return files.groupBy(*by).agg(
        F.count("*").alias("files"), F.count_if(failed).alias("error_files"),
        *(F.coalesce(F.sum(column), F.lit(0)).alias(name) for name, column in sums.items()))


def write_report(report: DataFrame, target: str) -> None:
    """Write a one-row report as a single JSON document."""
    report.coalesce(1).write.mode("overwrite").json(target)


def verdict(report: DataFrame, problems: Sequence[Column]) -> DataFrame:
    """Add ``mismatches`` (the problems that are not NULL) and ``status``."""
    found = F.array_compact(F.array(*problems)) if problems else F.array().cast("array<string>")
    return report.withColumn("mismatches", found).withColumn(
        "status", F.when(F.size("mismatches") == 0, "PASS").otherwise("FAIL"))


def expected_value(name: str, expected: object, shown: str | None = None) -> Column:
    """A problem text when a column differs from its expected value."""
    differs = F.coalesce(F.col(name) != F.lit(expected), F.lit(True))
    return F.when(differs, F.format_string(
        DIFFERS, F.lit(shown or name), F.lit(str(expected)), F.coalesce(F.col(name).cast("string"), F.lit("null"))))


def problem(condition: Column, message: str | Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(message) if isinstance(message, str) else message)


def verify_graph(nodes: DataFrame, edges: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """Stored graph against expected counts (any of the snapshot's columns), plus unique ids."""
    shown = {k: EDGES_OF_TYPE % k for k in C.EDGE_TYPES}
    problems = [expected_value(name, value, shown.get(name)) for name, value in expected.items()]
    problems += [
        problem(F.expr("total_nodes <> distinct_node_ids"), DUPLICATES % "node_id"),
        problem(F.expr("total_edges <> distinct_edge_ids"), DUPLICATES % "edge_id"),
    ]
    return verdict(graph_snapshot(nodes, edges), problems)


REQUIRED_DOCUMENT_FIELDS = ("path", "content_sha256", "kafka_partition", "kafka_offset")


def verify_documents(documents: DataFrame, manifest: DataFrame, expected: int) -> DataFrame:
    """Stored documents against the manifest, both ways. One scan of each table, one shuffle by id."""
    absent = {f"missing_{f}": F.col(f).isNull() for f in REQUIRED_DOCUMENT_FIELDS}
    flags = {"id_file_id_mismatches": F.col("_id") != F.col("file_id"), **absent}
    found = census(
        tagged_ids(documents, [("document", "_id", 1), ("file", "file_id", 1)], flags),
        tagged_ids(manifest, [("document", "file_id", 2)]))
    report = found.agg(
        _rows_in("document").alias("total_documents"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags),
        _in("file", "id is not null").alias("distinct_file_ids"), _in("file", "n1 > 1").alias("duplicate_file_ids"),
        _in("document", "n1 > 0").alias("distinct_document_ids"),
        _in("document", "n1 = 0").alias("missing_manifest_file_ids"), _in("document", "n2 = 0").alias("unexpected_document_ids"))
    some = lambda name, text, *before: problem(F.col(name) > 0, F.format_string(text, *map(F.lit, before), F.col(name)))
    problems = [expected_value(n, expected) for n in (
        "total_documents", "distinct_file_ids", "distinct_document_ids")]
    problems += [
        some("id_file_id_mismatches", OTHER_ID),
        problem(F.col("duplicate_file_ids") > 0, DUPLICATES % "file_id"),
        some("missing_manifest_file_ids", MISSING_FILES), some("unexpected_document_ids", UNEXPECTED_DOCUMENTS),
    ]
    problems += [some(f"missing_{f}", ABSENT_FIELD, f) for f in REQUIRED_DOCUMENT_FIELDS]
    return verdict(report, problems)


def singleton(documents: DataFrame, file_id: str) -> DataFrame:
    """How many documents carry a file id as ``_id`` and as ``file_id``."""
    return documents.agg(
        F.count_if(F.col("_id") == file_id).alias("count_by_id"),
        F.count_if(F.col("file_id") == file_id).alias("count_by_file_id"))


def singletons(documents: DataFrame) -> DataFrame:
    """For every ``_id``, how many documents carry it as ``_id`` and as ``file_id``."""
    by_id = documents.groupBy("_id").agg(F.count("*").alias("count_by_id"))
    by_file = documents.groupBy(F.col("file_id").alias("_id")).agg(F.count("*").alias("count_by_file_id"))
    return by_id.join(by_file, "_id", "left").select(
        "_id", "count_by_id", F.coalesce("count_by_file_id", F.lit(0).cast("long")).alias("count_by_file_id"))


def verify_idempotency(nodes: DataFrame, edges: DataFrame, documents: DataFrame, file_id: str) -> DataFrame:
    """No duplicate id in any sink, and exactly one document for the file."""
    mine = lambda column: F.col(column) == file_id
    found = census(
        tagged_ids(nodes, [("node", "node_id", 1)]), tagged_ids(edges, [("edge", "edge_id", 1)]),
        tagged_ids(documents, [("document", "_id", 1)], {"count_by_id": mine("_id"), "count_by_file_id": mine("file_id")}))
    report = found.agg(
        _in("node", "n1 > 1").alias("duplicate_node_ids"), _in("edge", "n1 > 1").alias("duplicate_edge_ids"),
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("count_by_id", "count_by_file_id")))
    return verdict(report, [
        expected_value("duplicate_node_ids", 0), expected_value("duplicate_edge_ids", 0),
        expected_value("count_by_id", 1), expected_value("count_by_file_id", 1),
    ])


def exact_state(expected_nodes: DataFrame, expected_edges: DataFrame, nodes: DataFrame, edges: DataFrame,
                documents: DataFrame, file_id: str, content_sha256: str, expected_documents: int,
                minimum_offset: int | None = None, minimum_revision: int | None = None) -> DataFrame:
    """State of one file in all sinks against a fresh extraction: exact id sets, one document with
    the right hash, the number of documents, and a log position that moved on: the offset of a foreign
    log, the revision of one of our own, whose offsets start anew with each revision."""
    def sets(expected: DataFrame, actual: DataFrame, key: str, name: str) -> list[DataFrame]:
        mine = actual.filter(F.col("file_id") == file_id)
        return [
            expected.agg(F.count("*").alias(f"expected_{name}_count")),
            mine.agg(F.count("*").alias(f"actual_{name}_count")),
            compare_sets(expected, mine, key).agg(
                F.count_if(F.col("difference") == "missing").alias(f"missing_{name}s"),
                F.count_if(F.col("difference") == "stale").alias(f"stale_{name}s")),
        ]

    mine = F.col("_id") == file_id
    stored = documents.agg(
        F.count("*").alias("documents"), F.countDistinct("file_id").alias("distinct_file_ids"),
        F.count_if(mine).alias("count_by_id"),
        F.count_if(F.col("file_id") == file_id).alias("count_by_file_id"),
        F.max(F.when(mine, F.col("content_sha256"))).alias("stored_sha256"),
        F.max(F.when(mine, F.col("kafka_offset"))).alias("stored_offset"),
        F.max(F.when(mine, F.col("revision_seq"))).alias("stored_revision"))
    report = one_row(
        *sets(expected_nodes, nodes, "node_id", "node"),
        *sets(expected_edges, edges, "edge_id", "edge"), stored)
    problems = [expected_value(n, v) for n, v in (
        ("missing_nodes", 0), ("stale_nodes", 0), ("missing_edges", 0), ("stale_edges", 0),
        ("count_by_id", 1), ("count_by_file_id", 1), ("stored_sha256", content_sha256),
        ("documents", expected_documents), ("distinct_file_ids", expected_documents))]
    problems.append(problem(F.col("stored_offset").isNull(), "no offset stored"))
    if minimum_offset is not None:
        problems.append(problem(
            F.col("stored_offset") < minimum_offset, f"offset is below {minimum_offset}"))
    if minimum_revision is not None:
        problems.append(problem(
            F.coalesce(F.col("stored_revision") < minimum_revision, F.lit(True)),
            f"revision is below {minimum_revision}"))
    return verdict(report, problems)


def snapshot_difference(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that only one of two snapshots has, counted; both zero means they are equal."""
    tagged = before.select(*columns, F.lit(1).alias("_side")).unionByName(
        after.select(*columns, F.lit(-1).alias("_side")))
    per_row = tagged.groupBy(*columns).agg(F.sum("_side").alias("_n"))
    return per_row.agg(
        F.coalesce(F.sum(F.greatest("_n", F.lit(0))), F.lit(0)).alias("only_before"),
        F.coalesce(F.sum(F.greatest(-F.col("_n"), F.lit(0))), F.lit(0)).alias("only_after"),
    ).withColumn("snapshots_equal", F.expr("only_before = 0 and only_after = 0"))


def walks(edges: DataFrame, start: DataFrame, source: str, target: str, key: str,
          limit: int | None = 100) -> DataFrame:
    """Paths of one or two edges from the ``start`` nodes (column ``node``), no edge used twice.

    With a ``limit``, the first paths by hops and edge keys: of a middle node's edges only the first ``limit`` + 1 can be in
    them (one may be the edge it was reached by), so no more are joined, however many a hub has.
    """
    first = edges.join(start.select(F.col("node").alias(source)), source).select(
        F.col(source).alias("start"), F.col(key).alias("edge_1"), F.col(target).alias("middle"))
    second = edges.select(
        F.col(source).alias("middle"), F.col(key).alias("edge_2"), F.col(target).alias("end"))
    if limit:
        nearest = Window.partitionBy("middle").orderBy("edge_2")
        second = second.join(first.select("middle").distinct(), "middle", "left_semi").withColumn(
            "_n", F.row_number().over(nearest)).where(F.col("_n") <= limit + 1).drop("_n")
    one = first.select("start", "edge_1", F.lit(None).cast(edges.schema[key].dataType).alias("edge_2"),
                       F.col("middle").alias("end"))
    two = first.join(second, "middle").filter("edge_1 <> edge_2").select(
        "start", "edge_1", "edge_2", "end")
    paths = one.unionByName(two).withColumn(
        "hops", F.when(F.col("edge_2").isNull(), 1).otherwise(2))
    return paths.orderBy("hops", "edge_1", F.asc_nulls_first("edge_2")).limit(limit) if limit else paths


def golden_gate(reports: DataFrame, expected: DataFrame) -> DataFrame:
    """All differences between measured and expected values, both ``(report, name, value)``."""
    measured = reports.select("report", "name", F.col("value").alias("actual"))
    return (
        expected.select("report", "name", F.col("value").alias("expected"))
        .join(measured, ["report", "name"], "left")
        .filter(~F.col("expected").eqNullSafe(F.col("actual")))
    )
