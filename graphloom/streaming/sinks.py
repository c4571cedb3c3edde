"""Streaming sinks: keyed upserts of documents, nodes and edges into versioned tables.

Each micro-batch is reduced to one row per key and written to its own partition
``run_id=<query>/batch_id=<n>``. A retried batch overwrites the same partition, and the current state
is the latest row per key over all partitions, decided by source position and never by arrival.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from graphloom import contract as C
from graphloom.functions import text
from graphloom.operators import changes
from graphloom.operators.sequence import dealt_by_file, latest_by_key
from graphloom.session import ID_TABLES

# a foreign log has no revision numbers: its offsets alone decide
DOCUMENT_ORDER = ("revision_seq", "kafka_offset")
GRAPH_ORDER = ("revision_seq", "offset")
_PARTITION = ("run_id", "batch_id")


def decode_events(log: DataFrame, category: str) -> DataFrame:
    """Log records with their value decoded as ``event``; malformed text gives NULL fields."""
    return log.withColumn("event", F.from_json("value", C.EVENT_SCHEMAS[category]))


def accepted(category: str) -> Column:
    """Records that follow the contract closely enough to be stored."""
    kinds = {
        "node": (C.NODE_UPSERT, C.NODE_DELETE), "edge": (C.EDGE_UPSERT, C.EDGE_DELETE),
        "metadata": (C.FILE_METADATA_UPSERT,), "error": (C.PARSER_ERROR,),
    }[category]
    ok = (
        F.col("event").isNotNull() & F.col("event.event_type").isin(*kinds)
        & (F.col("event.schema_version") == C.SCHEMA_VERSION)
        & F.col("event.file_id").isNotNull() & F.col(f"event.{C.KEYS[category]}").isNotNull()
    )
    if category == "edge":
        ends = F.col("event.source_id").isNotNull() & F.col("event.target_id").isNotNull()
        ok = ok & (ends | (F.col("event.event_type") == C.EDGE_DELETE))
    return F.coalesce(ok, F.lit(False))


def rejected_count(log: DataFrame, category: str) -> DataFrame:
    """How many records were stored and how many were left out."""
    ok = accepted(category)
    return decode_events(log, category).agg(
        F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"))


def documents(log: DataFrame) -> DataFrame:
    """Metadata records as documents, one ``_id`` per file, with their log position."""
    return (
        decode_events(log, "metadata").filter(accepted("metadata"))
        .select(
            F.col("event.file_id").alias("_id"), "event.*", F.col("topic").alias("kafka_topic"),
            F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
            F.col("timestamp").alias("kafka_timestamp"), "revision_seq")
        .withColumn("event_time_utc", text.event_time(F.col("event_time")))
        .withColumn("processed_at", F.current_timestamp())
    )


def graph_changes(log: DataFrame, category: str) -> DataFrame:
    """Node or edge records as changes with the stored columns and their log position, which orders the changes of
    one key. ``changed_at`` compares changes across topics; on a foreign log, which has no revision numbers, it is the
    event time."""
    sequence = F.coalesce(F.col("revision_seq"), F.unix_micros(text.event_time(F.col("event.event_time"))))
    return (
        decode_events(log, category).filter(accepted(category))
        .select("event.*", "revision_seq", "offset", sequence.alias("changed_at"))
        .withColumnRenamed("properties", "properties_json").drop("repository")
    )


def error_records(log: DataFrame) -> DataFrame:
    return (
        decode_events(log, "error").filter(accepted("error"))
        .select("event.*", "offset", F.col("timestamp").alias("log_time"))
    )


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a streaming query: kept across restarts, new with a new checkpoint."""
    lines = spark.read.text(f"{checkpoint}/metadata").collect()      # one line, written by Spark
    return json.loads(lines[0][0])["id"]


def keyed_writer(target: str, checkpoint: str, key: Sequence[str], order: Sequence[str], by_file: bool = False
                 ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that stores the last row per key of each batch; without a key,
    all rows. ``by_file`` is for keys that belong to one file each: its rows are dealt out and stored together."""
    def write(batch: DataFrame, batch_id: int) -> None:
        run = _run_id(batch.sparkSession, checkpoint)
        if by_file:
            rows = latest_by_key(dealt_by_file(batch), ["file_id", *key], order)
        else:
            rows = latest_by_key(batch, key, order) if key else batch
        (
            rows.withColumn("state_version", F.lit(C.STATE_VERSION))
            .write.mode("overwrite").option("compression", ID_TABLES).parquet(f"{target}/run_id={run}/batch_id={batch_id}")
        )
    return write


def start(stream: DataFrame, target: str, checkpoint: str, key: Sequence[str], order: Sequence[str],
          name: str, trigger: str | None = "5 seconds", by_file: bool = False) -> StreamingQuery:
    """Run a sink continuously, or with ``trigger=None`` until all present input is stored."""
    writer = (
        stream.writeStream.queryName(name).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(keyed_writer(target, checkpoint, key, order, by_file))
    )
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return timed.start()


def start_documents(log: DataFrame, target: str, checkpoint: str, trigger: str | None = "5 seconds"):
    return start(documents(log), target, checkpoint, ["_id"], DOCUMENT_ORDER, "metadata_documents",
                 trigger)


def start_graph(log: DataFrame, category: str, target: str, checkpoint: str,
                trigger: str | None = "5 seconds", by_file: bool = False):
    """Node or edge sink. It keeps the last upsert and the last delete of a key, because detaching
    needs to know of a delete even when the node came back. ``by_file`` is for logs of ``change_feed``, whose keys belong to
    one file each."""
    return start(graph_changes(log, category), target, checkpoint, [C.KEYS[category], "event_type"],
                 GRAPH_ORDER, f"graph_{category}s", trigger, by_file)


def start_errors(log: DataFrame, target: str, checkpoint: str, trigger: str | None = "5 seconds"):
    return start(error_records(log), target, checkpoint, (), ("offset",), "parser_errors", trigger)


@dataclass(frozen=True)
class Folded:
    """What compaction has put into a base: the base's name, and up to which batch of each run it goes."""

    generation: int = 0
    place: int = 1
    upto: Mapping[str, int] = field(default_factory=dict)

    @property
    def base(self) -> str:
        return f"{_BASE}{self.generation}"


_BASE = "base-"


def folded(spark: SparkSession, target: str) -> Folded:
    """The last compaction of a table; two small records of one row a run, of which the newer one counts."""
    try:
        rows = spark.read.parquet(f"{target}/_folded/place=*").select(
            "generation", F.regexp_extract(F.col("_metadata.file_path"), r"place=(\d)", 1).cast("int").alias("place"), "run", "upto").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return Folded()
    newest = max(r.generation for r in rows)
    return Folded(newest, next(r.place for r in rows if r.generation == newest), {r.run: r.upto for r in rows if r.generation == newest})


def _visible(done: Folded) -> Column:
    """Partitions that count: the base, and batches that are not in it."""
    run, batch = F.col("run_id").cast("string"), F.col("batch_id").cast("long")
    rest = F.lit(True)
    for name, upto in done.upto.items():
        rest = rest & ((run != name) | (batch > upto))
    return F.when(run.startswith(_BASE), run == done.base).otherwise(rest) if done.generation else F.lit(True)


def stored_batches(spark: SparkSession, target: str) -> DataFrame:
    """All rows that count, with their ``run_id`` and ``batch_id``. Rows of another state version are fatal."""
    rows = spark.read.option("basePath", target).parquet(f"{target}/run_id=*").where(_visible(folded(spark, target)))
    version = F.col("state_version")
    checked = F.when(version == C.STATE_VERSION, version).otherwise(
        F.raise_error(F.lit(f"{target} was written by another version")).cast("int"))
    return rows.filter(checked.isNotNull()).drop("state_version")


def stored(spark: SparkSession, target: str) -> DataFrame:
    return stored_batches(spark, target).drop(*_PARTITION)


def current_documents(spark: SparkSession, target: str) -> DataFrame:
    """One document per file: the one with the highest offset; of equal ones the first stored."""
    rows = stored(spark, target).withColumn("_age", -F.unix_micros("processed_at"))
    return latest_by_key(rows, ["_id"], [*DOCUMENT_ORDER, "_age"]).drop("_age")


def recent_errors(spark: SparkSession, target: str, now: Column | None = None) -> DataFrame:
    """Stored parser errors that are still within their retention time, by the time of their log record; a record
    without one goes by its event time, and with neither it stays."""
    now = F.current_timestamp() if now is None else now
    timed = stored(spark, target).withColumn(
        "_time", F.coalesce("log_time", text.event_time(F.col("event_time")), now))
    return changes.retain(timed, "_time", now).drop("_time")


def current_nodes(changes_log: DataFrame) -> DataFrame:
    return changes.apply_changes(
        changes_log, "node_id", GRAPH_ORDER, F.col("event_type") == C.NODE_DELETE
    ).drop("event_type")


def current_edges(changes_log: DataFrame, node_changes: DataFrame | None = None) -> DataFrame:
    """Current edges; with ``node_changes``, without those whose endpoint was deleted later on."""
    edges = changes.apply_changes(
        changes_log, "edge_id", GRAPH_ORDER, F.col("event_type") == C.EDGE_DELETE).drop("event_type")
    if node_changes is None:
        return edges
    order = "changed_at" if "changed_at" in node_changes.columns else "revision_seq"
    deletes = changes.last_deletes(
        node_changes, "node_id", order, F.col("event_type") == C.NODE_DELETE)
    return changes.detach(edges, deletes, "node_id", "source_id", "target_id", order)


def graph_view(spark: SparkSession, nodes_at: str, edges_at: str) -> tuple[DataFrame, DataFrame]:
    """Current nodes, with placeholders for endpoints not seen yet, and current edges."""
    node_changes = stored(spark, nodes_at)
    edges = current_edges(stored(spark, edges_at), node_changes)
    nodes = changes.with_placeholders(
        current_nodes(node_changes), edges, "node_id", "source_id", "target_id")
    return nodes, edges


def graph_by_file(spark: SparkSession, nodes_at: str, edges_at: str) -> DataFrame:
    """What ``graph_view`` holds, as (file_id, kind, id) alone, for logs of ``change_feed``: one exchange, by file."""
    rows = lambda at, *ends: stored(spark, at).select(
        "file_id", F.col(ends[0]).alias("own_id"), *ends[1:], F.col("event_type").endswith("_DELETE").alias("deleted"),
        *GRAPH_ORDER, "changed_at")
    return changes.graph_in_files(
        rows(nodes_at, "node_id"), rows(edges_at, "edge_id", "source_id", "target_id"), GRAPH_ORDER)


def compact(spark: SparkSession, target: str, key: Sequence[str], order: Sequence[str]) -> None:
    """Fold the batches that a table holds now into one base with the last row per key. The stream may go on meanwhile.

    The base is a partition of the same table; a small record, written last, says which batches it stands for, and
    readers leave those out by partition filters. Batches stored after the start are not folded. A compaction that
    stopped before its record can be run again. Runs jobs; one row a run comes to the driver.
    """
    done = folded(spark, target)
    now = stored_batches(spark, target)
    upto = {r.run_id: r.upto for r in now.where(~F.col("run_id").cast("string").startswith(_BASE)).groupBy(
        F.col("run_id").cast("string").alias("run_id")).agg(F.max("batch_id").cast("long").alias("upto")).collect()}
    after = Folded(done.generation + 1, 1 - done.place, {**done.upto, **upto})
    known = F.col("run_id").cast("string").startswith(_BASE)
    for name, last in upto.items():
        known = known | ((F.col("run_id") == name) & (F.col("batch_id") <= last))
    (
        latest_by_key(now.where(known).drop(*_PARTITION), key, order).withColumn("state_version", F.lit(C.STATE_VERSION))
        .write.mode("overwrite").option("compression", ID_TABLES).parquet(f"{target}/run_id={after.base}/batch_id=0")
    )
    rows = [(after.generation, run, last) for run, last in sorted(after.upto.items())]
    spark.createDataFrame(rows, "generation long, run string, upto long").coalesce(1).write.mode("overwrite").parquet(
        f"{target}/_folded/place={after.place}")


def compact_documents(spark: SparkSession, target: str) -> None:
    compact(spark, target, ["_id"], DOCUMENT_ORDER)


def compact_graph(spark: SparkSession, category: str, target: str) -> None:
    """Keeps the last upsert and the last delete of a key, as the sink does."""
    compact(spark, target, [C.KEYS[category], "event_type"], GRAPH_ORDER)
