"""Keyed logs: writing events, reading them in batch or as a stream, replaying dumps.

A log is either a Kafka cluster (``kafka`` options given, connector on the class path) or a folder
of Parquet files partitioned by topic and revision, which behaves the same way offline.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom import contract as C
from graphloom.operators.sequence import first_by_group
from graphloom.session import ID_TABLES


def topic_of(category: Column) -> Column:
    """Topic of a category; an unknown category is fatal."""
    topics = F.create_map(*(F.lit(v) for pair in C.TOPICS.items() for v in pair))
    return F.coalesce(F.try_element_at(topics, category), F.raise_error(
        F.concat(F.lit("no such event category: "), category)).cast("string"))


def log_records(feed: DataFrame, revision_seq: int, partitions: int = 1, by_file: bool = False) -> DataFrame:
    """Feed rows as log records, in order of their revision and, within it, of their offset.

    Offsets hold among the records of one key, which share a task: they follow event order and position, start
    anew with each revision and have gaps. Nothing is sorted across tasks. ``by_file`` deals records out by file, for feeds
    whose keys belong to one file each, as those of ``change_feed`` do: what a file's records share is then packed away.
    """
    dealt = ["file_id", "key"] if by_file else ["key"]
    numbered = feed.repartition(dealt[0]).sortWithinPartitions(*dealt, "op_rank", "ord").withColumn(
        "offset", F.monotonically_increasing_id())
    return _as_records(numbered, revision_seq, partitions)


def _as_records(numbered: DataFrame, revision_seq: int, partitions: int, more: Sequence[str] = ()) -> DataFrame:
    return numbered.select(
        "key", "value", topic_of(F.col("category")).alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"), "offset",
        F.current_timestamp().alias("timestamp"), F.lit(revision_seq).cast("long").alias("revision_seq"), *more,
    )


def _write_revision(records: DataFrame, target: str, revision_seq: int) -> None:
    (
        records.drop("revision_seq").write.mode("overwrite").option("partitionOverwriteMode", "static")
        .option("compression", ID_TABLES).partitionBy("topic").parquet(f"{target}/revision_seq={revision_seq}")
    )


def publish_changes(feed: DataFrame, target: str, revision_seq: int, partitions: int = 1) -> DataFrame:
    """Append a batch's ``change_feed`` as one revision, and give the feed back as it was written.

    No key comes twice in such a feed, so any offsets will do, and records stay with the tasks that make them. The feed's own
    columns lie beside those of the log, whose readers leave them out; a position that is the key itself is not written again.
    Otherwise as ``publish``.
    """
    own = ["file_id", "event_type", "op_rank", "ord"]
    records = _as_records(feed.withColumns({
        "offset": F.monotonically_increasing_id(), "ord": F.nullif("ord", "key")}), revision_seq, partitions, own)
    _write_revision(records, target, revision_seq)
    topics = F.create_map(*(F.lit(v) for name, topic in C.TOPICS.items() for v in (topic, name)))
    written = T.StructType([C.ENVELOPE["key"], C.ENVELOPE["value"], C.ENVELOPE["topic"], *(feed.schema[name] for name in own)])
    return feed.sparkSession.read.schema(written).parquet(f"{target}/revision_seq={revision_seq}").select(
        F.element_at(topics, F.col("topic")).alias("category"), "key", "value", *own[:3], F.coalesce("ord", "key").alias("ord"))


def publish(feed: DataFrame, target: str, revision_seq: int, partitions: int = 1, by_file: bool = False) -> None:
    """Append one revision to a folder log. Writing the same revision again replaces all of its topics,
    and it becomes visible only when the whole write has committed."""
    _write_revision(log_records(feed, revision_seq, partitions, by_file), target, revision_seq)


def publish_kafka(feed: DataFrame, servers: str, options: Mapping[str, str] | None = None) -> None:
    """Send the feed to Kafka, acknowledged by all replicas."""
    (
        feed.select(topic_of(F.col("category")).alias("topic"), "key", "value")
        .write.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all").option("kafka.compression.type", "gzip")
        .options(**(options or {})).save()
    )


def _kafka_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", F.lit(None).cast("long").alias("revision_seq"))


def read_log(spark: SparkSession, location: str, topic: str, kafka: bool = False,
             starting_offsets: str = "earliest") -> DataFrame:
    """All records of a topic. ``location`` is a folder or the Kafka servers."""
    if kafka:
        return _kafka_columns(
            spark.read.format("kafka").option("kafka.bootstrap.servers", location)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    return spark.read.schema(C.ENVELOPE).parquet(location).filter(F.col("topic") == topic)


def stream_log(spark: SparkSession, location: str, topic: str, kafka: bool = False,
               starting_offsets: str = "earliest", files_per_trigger: int | None = None) -> DataFrame:
    """The records of a topic as a stream."""
    if kafka:
        return _kafka_columns(
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", location)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    reader = spark.readStream.schema(C.ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(location).filter(F.col("topic") == topic)


def without_replays(log: DataFrame, within: str) -> DataFrame:
    """A stream of log records without those that it has had before, by their place in the log.

    Places are kept in the stream's state as long as records of their time can come: ``within`` is how far behind the newest
    record's time a record may be. Older ones are taken for replays and left out.
    """
    place = ["topic", "partition", "revision_seq", "offset"]
    return log.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(place)


def first_records(log: DataFrame) -> DataFrame:
    """The first record of each topic as ``key | value``."""
    return first_by_group(log, ["topic"], ["revision_seq", "partition", "offset"]).select(
        "topic", F.concat_ws(" | ", "key", "value").alias("record"))


def write_dump(feed: DataFrame, target: str) -> None:
    """Dry run: JSON lines per category, packed, in event order within a file; a source file's events share one."""
    (
        feed.repartition("file_id").sortWithinPartitions("category", "file_id", "op_rank", "ord").select("category", "value")
        .write.mode("overwrite").option("compression", "gzip").partitionBy("category").text(target)
    )


def read_events(spark: SparkSession, location: str, category: str) -> DataFrame:
    """Events of a JSONL dump with its schema; lines that are no JSON are in ``_corrupt_record``."""
    schema = T.StructType([*C.EVENT_SCHEMAS[category].fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(location)


def require_valid(events: DataFrame) -> DataFrame:
    """Make a line that is no JSON fatal, naming the line."""
    bad = F.col("_corrupt_record")
    key = events.columns[0]
    return events.withColumn(key, F.when(bad.isNull(), F.col(key)).otherwise(
        F.raise_error(F.concat(F.lit("not JSON: "), bad)).cast("string"))).drop("_corrupt_record")


def _line_place() -> Column:
    """Text that sorts the lines of text files by file and place in it."""
    padded = lambda number: F.lpad(number.cast("string"), 20, "0")
    return F.concat_ws(":", F.col("_metadata.file_path"), padded(F.col("_metadata.file_block_start")),
                       padded(F.monotonically_increasing_id()))


def replay_dumps(spark: SparkSession, folder: str, categories: Sequence[str] = tuple(C.CATEGORIES),
                 partitioned: bool = False) -> DataFrame:
    """JSONL dumps as feed rows, keyed per category; only the named categories. ``partitioned``
    reads the layout of ``write_dump`` instead of one file per category. Events of one key keep the
    order of their lines; a category without a dump has no events."""
    unknown = [name for name in categories if name not in C.CATEGORIES]
    if unknown:
        raise ValueError(f"no such categories: {unknown}; known are {list(C.CATEGORIES)}")
    feed = None
    for category in categories:
        name = f"category={category}" if partitioned else C.CATEGORIES[category][2]
        try:
            read = spark.read.text(f"{folder}/{name}")
        except AnalysisException as problem:        # nothing of this category was dumped
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        lines = read.select("value", _line_place().alias("ord")).filter(F.trim("value") != "")
        parsed = lines.withColumn("_json", F.parse_json("value"))
        member = lambda name: F.variant_get("_json", f"$.{name}", "string")
        part = parsed.select(
            F.lit(category).alias("category"), member(C.KEYS[category]).alias("key"), "value",
            member("file_id").alias("file_id"), member("event_type").alias("event_type"),
            F.lit(0).alias("op_rank"), "ord")
        feed = part if feed is None else feed.unionByName(part)
    if feed is None:
        raise FileNotFoundError(f"{folder} holds none of {list(categories)}")
    return feed


def sample_events(spark: SparkSession, location: str, category: str) -> DataFrame:
    """Sample files, each with one JSON event in any layout, as feed rows with their key, ordered by path."""
    texts = spark.read.text(location, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("ord")).withColumn("_json", F.parse_json("value"))
    member = lambda name: F.variant_get("_json", f"$.{name}", "string")
    return texts.select(
        F.lit(category).alias("category"), member(C.KEYS[category]).alias("key"),
        F.to_json("_json").alias("value"), member("file_id").alias("file_id"),
        member("event_type").alias("event_type"), F.lit(0).alias("op_rank"), "ord")
