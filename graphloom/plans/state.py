"""The ids of each file's last parsed revision, stored so that a small batch touches a small part of them.

State tables are partitioned by the first digits of ``file_id`` (``prefix``) and by ``slot``, 0 or 1. A partition holds
all files of its prefix. A batch reads the partitions of its own prefixes only, and writes each of them anew into the slot
that is not in use (dynamic partition overwrite). A small commit table says which slot of a prefix counts; it is written
last and in two slots of its own, so that until then the state before the batch stays what readers see, and a batch that
stopped anywhere can be run again. Nothing is deleted: a slot is overwritten when its prefix changes the next time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.operators.changes import set_digests
from graphloom.operators.sequence import merged, packed_ids, unpacked_ids
from graphloom.plans.extract import Extraction
from graphloom.session import ID_TABLES

#: Rows of a partition that the first batch aims at, and the most digits of a file id that choose a partition.
PARTITION_ROWS = 1_000_000
MOST_DIGITS = 3
COLUMNS = {
    "files": ("file_id", "content_sha256", "nodes_digest", "edges_digest"),
    "nodes": ("file_id", "node_id"),
    "edges": ("file_id", "edge_id", "edge_type", "source_id", "target_id"),
}


@dataclass(frozen=True)
class Commit:
    """Which slot of each prefix counts after a revision, and where that is written down."""

    revision_seq: int
    place: int
    digits: int
    slots: Mapping[str, int]


def _prefix(digits: int) -> Column:
    return F.substring("file_id", 1, digits)


def _commits(spark: SparkSession, root: str) -> list[Commit]:
    """At most two commits of at most 16 ** digits rows each."""
    try:
        rows = spark.read.parquet(f"{root}/commits").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if any(r.state_version != C.STATE_VERSION for r in rows):
        raise ValueError(f"{root} was written by another version")
    found: dict[tuple[int, int, int], dict[str, int]] = {}
    for r in rows:
        found.setdefault((r.revision_seq, r.place, r.digits), {})[r.prefix] = r.slot
    return [Commit(*key, slots) for key, slots in found.items()]


def last_commit(spark: SparkSession, root: str, revision_seq: int) -> Commit | None:
    """The last commit before a revision, None if there is none. A revision before the last two is refused, since its
    state is gone."""
    commits = _commits(spark, root)
    earlier = [c for c in commits if c.revision_seq < revision_seq]
    if sum(c.revision_seq > revision_seq for c in commits) or (len(commits) == 2 and not earlier):
        raise ValueError(f"revision {revision_seq} is older than the stored state")
    return max(earlier, key=lambda c: c.revision_seq, default=None)


def _touched(files: DataFrame, digits: int) -> list[str]:
    return sorted(r[0] for r in files.select(_prefix(digits)).distinct().collect())


def _rows(spark: SparkSession, root: str, name: str, commit: Commit, prefixes: list[str]) -> DataFrame | None:
    """Stored rows of some prefixes, or None without any; rows of another state version are fatal."""
    by_slot = {slot: [p for p in prefixes if commit.slots.get(p) == slot] for slot in (0, 1)}
    wanted = [(F.col("slot") == slot) & F.col("prefix").isin(chosen) for slot, chosen in by_slot.items() if chosen]
    if not wanted:
        return None
    rows = spark.read.schema(_schema(name)).parquet(f"{root}/{name}").where(wanted[0] if len(wanted) == 1 else wanted[0] | wanted[1])
    version = F.col("state_version")
    fatal = F.raise_error(F.lit("the stored state was written by another version")).cast("int")
    checked = rows.where(F.when(version == C.STATE_VERSION, version).otherwise(fatal).isNotNull())
    return checked.where("file_id is not null").select(*COLUMNS[name])


def _schema(name: str) -> str:
    return ", ".join(f"{c} string" for c in COLUMNS[name]) + ", state_version int, prefix string, slot int"


def previous_state(spark: SparkSession, batch: DataFrame, root: str, revision_seq: int, whole: bool = False
                   ) -> dict[str, DataFrame] | None:
    """Stored ``files``, ``nodes`` and ``edges`` of the batch's files before a revision; None without any.

    Reads the partitions of the batch's prefixes. Runs a job to find them (at most 16 ** ``MOST_DIGITS`` values).
    ``whole`` gives all files of these partitions, for steps that pick out the batch's files by themselves.
    """
    commit = last_commit(spark, root, revision_seq)
    if commit is None:
        return None
    prefixes = _touched(batch, commit.digits)
    found = {name: _rows(spark, root, name, commit, prefixes) for name in COLUMNS}
    if found["files"] is None:
        return None
    if whole:
        return found
    return {name: unpacked_ids(packed_ids(rows).join(merged(batch.select("file_id")), "file_id", "left_semi")) for name, rows in found.items()}


def with_digests(files: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``files`` with digests of their sets of node and edge ids."""
    for name, ids, key in (("nodes_digest", nodes, "node_id"), ("edges_digest", edges, "edge_id")):
        files = files.join(merged(set_digests(ids, "file_id", key, name)), "file_id", "left")
    return files.withColumns({n: F.coalesce(n, F.lit("")) for n in ("nodes_digest", "edges_digest")})


def _digits(edges: DataFrame) -> int:
    """As many digits as make partitions of about ``PARTITION_ROWS`` edges, one at least."""
    wanted = -(-edges.count() // PARTITION_ROWS)
    return min(MOST_DIGITS, next(d for d in range(1, MOST_DIGITS + 1) if 16 ** d >= wanted or d == MOST_DIGITS))


def commit_state(extraction: Extraction, root: str, revision_seq: int, digits: int | None = None) -> None:
    """Store the ids of this batch's parsed files; other files of their prefixes are carried over, and the commit comes
    last. A batch that is run again replaces what it left behind. The first commit decides for how many ``digits`` of
    file ids the tables are partitioned, by the size of its batch if none are given."""
    parsed = extraction.files.filter(F.col("status") == "PARSED")
    spark = parsed.sparkSession
    commit = last_commit(spark, root, revision_seq) or Commit(0, 1, digits or _digits(extraction.edges), {})
    prefixes = _touched(parsed, commit.digits)
    slots = {p: 1 - commit.slots.get(p, 1) for p in prefixes}
    slot_of = F.create_map(*(F.lit(x) for pair in slots.items() for x in pair)) if slots else None
    written = {"nodes": extraction.nodes, "edges": extraction.edges,
               "files": with_digests(parsed, extraction.nodes, extraction.edges)}
    for name, rows in written.items():
        if slot_of is None:
            break
        rows = packed_ids(rows.select(*COLUMNS[name]))
        carried = _rows(spark, root, name, commit, prefixes)
        if carried is not None:
            rows = rows.unionByName(packed_ids(carried).join(merged(parsed.select("file_id")), "file_id", "left_anti"))
        # a row without an id in every partition, so that one without rows replaces what its slot held
        marks = spark.range(1).select(F.explode(F.array(*map(F.lit, prefixes))).alias("prefix"))
        placed = rows.withColumn("prefix", _prefix(commit.digits)).unionByName(marks, allowMissingColumns=True).withColumns({
            "state_version": F.lit(C.STATE_VERSION), "slot": F.element_at(slot_of, F.col("prefix"))})
        (
            unpacked_ids(placed.hint("rebalance", F.col("prefix"))).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").option("compression", ID_TABLES)
            .partitionBy("prefix", "slot").parquet(f"{root}/{name}")
        )
    rows = [(p, s, revision_seq, commit.digits, C.STATE_VERSION) for p, s in sorted({**commit.slots, **slots}.items())]
    (
        spark.createDataFrame(rows, "prefix string, slot int, revision_seq long, digits int, state_version int").coalesce(1)
        .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/commits/place={1 - commit.place}")
    )
