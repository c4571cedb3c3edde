"""Extraction results -> change events of the four categories, keyed and ordered."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.functions import ids
from graphloom.operators.sequence import dealt_by_file, packed_ids, unpacked_ids
from graphloom.plans.extract import Extraction

# --- fixed values: order of the events of one file ---------------------------------
RANKS = {
    C.EDGE_DELETE: 0, C.NODE_DELETE: 1, C.NODE_UPSERT: 2, C.EDGE_UPSERT: 3,
    C.PARSER_ERROR: 4, C.FILE_METADATA_UPSERT: 5,
}
# -----------------------------------------------------------------------------------
FEED_COLUMNS = ("category", "key", "value", "file_id", "event_type", "op_rank", "ord")


def event_json(payload: list[Column], properties: Column | None = None) -> Column:
    """JSON text of an event; ``properties`` is JSON object text and becomes a nested object."""
    plain = F.to_json(F.struct(*payload))
    if properties is None:
        return plain
    body = F.substring(plain, F.lit(1), F.length(plain) - 1)
    return F.concat(body, F.lit(',"properties":'), properties, F.lit("}"))


def common(event_type: str, event_time: Column) -> list[Column]:
    """The seven fields every event starts with."""
    return [
        F.lit(C.SCHEMA_VERSION).alias("schema_version"), F.lit(event_type).alias("event_type"),
        event_time.alias("event_time"), F.col("repository"), F.col("file_id"),
        ids.normalize_path(F.col("path")).alias("path"), F.col("content_sha256"),
    ]


def events(df: DataFrame, category: str, event_type: str, event_time: Column, ord: Column) -> DataFrame:
    """Feed rows of one event type. Unknown categories are refused, empty keys are fatal."""
    if category not in C.CATEGORIES:
        raise ValueError(f"no such event category: {category}")
    known = {f.name for f in C.EVENT_SCHEMAS[category].fields}
    delete = event_type.endswith("_DELETE")
    payload = [
        F.col(f.name) for f in C.EVENT_SCHEMAS[category].fields
        if f.name not in C.COMMON_FIELDS and f.name != "properties" and f.name in df.columns
    ]
    properties = F.col("properties") if "properties" in known and not delete else None
    key = F.col(C.KEYS[category])
    guarded = F.when(F.coalesce(key, F.lit("")) != "", key).otherwise(
        F.raise_error(F.lit(f"{category} event without a key")).cast("string"))
    return df.select(
        F.lit(category).alias("category"), guarded.alias("key"),
        event_json(common(event_type, event_time) + payload, properties).alias("value"),
        "file_id", F.lit(event_type).alias("event_type"),
        F.lit(RANKS[event_type]).alias("op_rank"), ord.cast("string").alias("ord"),
    )


def utc_text(when: Column) -> Column:
    """ISO-8601 text with microseconds and a UTC offset."""
    return F.concat(F.date_format(F.to_utc_timestamp(when, F.current_timezone()),
                                  "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def stale_in_files(previous: DataFrame, current: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Rows of ``previous`` that their file no longer has, with the columns of ``files``, and for these files only.

    All are dealt out once, by file, which is a bounded unit, with packed ids. In a file its own row comes first, as it has no
    key, and then by key what the file has now before what it had.
    """
    mark = lambda df, had: df.withColumn("_had", F.lit(had))
    rows = mark(previous, True).unionByName(
        mark(current.select("file_id", key), False), allowMissingColumns=True).unionByName(
        mark(files, False), allowMissingColumns=True)
    rows = packed_ids(rows).repartition("file_id").withColumn("_has", F.when(~F.col("_had"), F.col(key)))
    window = Window.partitionBy("file_id").orderBy(key, "_had").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = [n for n in files.columns if n != "file_id"]
    seen = rows.withColumns({n: F.last(n, ignorenulls=True).over(window) for n in (*carried, "_has")})
    gone = F.coalesce(F.col("_has") != F.col(key), F.lit(True))
    return unpacked_ids(seen.filter(F.col("_had") & F.col(carried[0]).isNotNull() & gone).drop("_had", "_has"))


def change_feed(
    extraction: Extraction, previous_nodes: DataFrame | None = None,
    previous_edges: DataFrame | None = None, event_time: Column | None = None, by_file: bool = False,
) -> DataFrame:
    """All events of a batch of files against the state before it.

    Only parsed files are diffed: a failed file gives its error and zero counts and keeps what it
    had. Files outside the batch are not touched. Deletes carry the hash of the new revision. ``by_file`` deals the nodes and
    edges out by file before their texts are made, for a feed that is written as it is.
    """
    nodes, edges = extraction.nodes, extraction.edges
    if by_file:
        nodes, edges = extraction.dealt or (dealt_by_file(nodes), dealt_by_file(edges))
    time = utc_text(F.current_timestamp()) if event_time is None else event_time
    position = F.lpad(F.col("ord").cast("string"), 20, "0")
    parts = [
        events(nodes, "node", C.NODE_UPSERT, time, position),
        events(edges, "edge", C.EDGE_UPSERT, time, position),
        events(extraction.errors, "error", C.PARSER_ERROR, time, F.col("error_id")),
        events(extraction.metadata, "metadata", C.FILE_METADATA_UPSERT, time, F.col("file_id")),
    ]
    parsed = extraction.files.filter(F.col("status") == "PARSED").select(
        "repository", "path", "file_id", "content_sha256")
    for category, event_type, previous, current, keep in (
        ("node", C.NODE_DELETE, previous_nodes, extraction.nodes, []),
        ("edge", C.EDGE_DELETE, previous_edges, extraction.edges,
         ["edge_type", "source_id", "target_id"]),
    ):
        if previous is None:
            continue
        key = C.KEYS[category]
        stale = stale_in_files(previous.select("file_id", key, *keep), current, parsed, key)
        parts.append(events(stale, category, event_type, time, F.col(key)))
    feed = parts[0]
    for part in parts[1:]:
        feed = feed.unionByName(part)
    return feed


def run_summary(feed: DataFrame, extraction: Extraction, repository: str, started: datetime,
                finished: datetime, dry_run: bool) -> DataFrame:
    """One row of counters over a batch."""
    rows = extraction.metadata.select("status", *C.COUNT_FIELDS).unionByName(
        feed.select("event_type"), allowMissingColumns=True)
    by_status = lambda kind: F.count_if(F.col("status") == kind)
    by_type = lambda kind: F.count_if(F.col("event_type") == kind)
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    breakdown = F.struct(
        total("ast_node_count").alias("ast_nodes"),
        *(total(f"{k.lower()}_edge_count").alias(f"{k.lower()}_edges") for k in C.EDGE_TYPES))
    return rows.agg(
        F.lit(repository).alias("repository"),
        F.count("status").alias("total_files_targeted"),
        by_status("PARSED").alias("processed_files"),
        by_status("FAILED").alias("error_files"),
        by_type(C.NODE_UPSERT).alias("total_nodes_emitted"),
        by_type(C.EDGE_UPSERT).alias("total_edges_emitted"),
        by_type(C.NODE_DELETE).alias("deleted_nodes_emitted"),
        by_type(C.EDGE_DELETE).alias("deleted_edges_emitted"),
        breakdown.alias("cpg_breakdown"), F.lit(dry_run).alias("dry_run"),
        F.round(F.lit(finished).cast("double") - F.lit(started).cast("double"), 3).alias(
            "execution_duration_sec"),
        utc_text(F.lit(finished)).alias("executed_at"),
    )
