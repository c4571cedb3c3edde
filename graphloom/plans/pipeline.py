"""One batch of the pipeline: extract, diff against the last parsed revisions, publish, commit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from graphloom import contract as C
from graphloom.operators.feed import change_feed
from graphloom.operators.sequence import merged
from graphloom.plans import state
from graphloom.plans.extract import Extraction, extract
from graphloom.session import materialise
from graphloom.sources import logs
from graphloom.streaming import sinks


@dataclass(frozen=True)
class Locations:
    """Folders of a deployment, all on shared storage."""

    root: str

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    @property
    def state(self) -> str:
        return f"{self.root}/state"


def run_batch(spark: SparkSession, files: DataFrame, at: Locations, revision_seq: int, partitions: int = 1,
              event_time: Column | None = None, skip_unchanged: bool = False) -> tuple[Extraction, DataFrame]:
    """Extract ``files`` and append their events to the log as revision ``revision_seq``.

    The state advances only after the log was written. A batch that stops in between can be run
    again under the same number and replaces what it left behind. With ``skip_unchanged`` the ids of a file are compared
    with the stored ones only if the digests of the two sets differ; what is published is the same either way. The feed is
    read from the log.
    """
    extraction = extract(files)
    previous = state.previous_state(spark, extraction.files, at.state, revision_seq, whole=True) or {}
    if previous and skip_unchanged:
        previous = changed_only(extraction, previous)
    changes = change_feed(extraction, previous.get("nodes"), previous.get("edges"), event_time, by_file=True)
    feed = logs.publish_changes(changes, at.log, revision_seq, partitions)
    state.commit_state(extraction, at.state, revision_seq)
    return extraction, feed


def changed_only(extraction: Extraction, previous: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stored rows of files whose digests are not those of the extraction."""
    now = state.with_digests(extraction.files, extraction.nodes, extraction.edges)
    same = now.join(merged(previous["files"]), ["file_id", "nodes_digest", "edges_digest"], "left_semi").select("file_id")
    same = materialise(same, "unchanged")
    return {name: rows.join(merged(same), "file_id", "left_anti") for name, rows in previous.items()}


def drain(spark: SparkSession, at: Locations) -> None:
    """Run every sink until the log is stored."""
    for category in ("node", "edge"):
        log = logs.stream_log(spark, at.log, C.TOPICS[category])
        sinks.start_graph(log, category, at.table(category), at.checkpoint(category), None, by_file=True).awaitTermination()
    log = logs.stream_log(spark, at.log, C.TOPICS["metadata"])
    sinks.start_documents(log, at.table("metadata"), at.checkpoint("metadata"), None).awaitTermination()
    log = logs.stream_log(spark, at.log, C.TOPICS["error"])
    sinks.start_errors(log, at.table("error"), at.checkpoint("error"), None).awaitTermination()
