"""Driver queries: revision diffs, change feeds, current state and streams."""

from __future__ import annotations

import functools
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.functions import ids, text
from graphloom.operators import changes, feed, sequence
from graphloom.plans import derived
from graphloom.plans.catalog import REPOSITORY, query, table
from graphloom.plans.extract import Extraction, extract
from graphloom.plans.pipeline import Locations, drain, run_batch
from graphloom.plans.state import commit_state, previous_state
from graphloom.session import shared_folder
from graphloom.sources import logs
from graphloom.streaming import sinks

# --- diffs -----------------------------------------------------------------------------------

_CUT = "2024-01-15"


@query(f"""
    with old as (select distinct user_id, props from events where ts < timestamp '{_CUT}'),
    new as (select distinct user_id, props from events where ts >= timestamp '{_CUT}'),
    touched as (select user_id, max(event_id) as revision from events where ts >= timestamp '{_CUT}' group by 1)
    select user_id, props, sha256(revision::varchar) as content_sha256
    from (select * from old except select * from new) join touched using (user_id)""")
def revision_diff(spark, sf_dir):
    """What users of the new revision no longer have; each row carries the new revision's hash."""
    events = table(spark, sf_dir, "events").select("user_id", "props", "event_id", "ts")
    cut = F.col("ts") >= F.lit(_CUT).cast("timestamp_ntz")
    previous = events.filter(~cut).select("user_id", "props").distinct()
    current = events.filter(cut).select("user_id", "props").distinct()
    touched = events.filter(cut).groupBy("user_id").agg(F.max("event_id").alias("revision"))
    stale = changes.stale_rows(previous, current, touched, "user_id", "props")
    return stale.join(touched, "user_id").select(
        "user_id", "props", ids.sha256(F.col("revision").cast("string")).alias("content_sha256"))


@query(f"""
    with old as (select distinct user_id, event_type from events where ts < timestamp '{_CUT}'),
    new as (select distinct user_id, event_type from events where ts >= timestamp '{_CUT}'),
    differing as (select user_id from (select * from old except select * from new)
                  union select user_id from (select * from new except select * from old))
    select distinct user_id from events where user_id not in (select user_id from differing)""")
def unchanged_files(spark, sf_dir):
    """Users with the same kinds of events before and after a cut, by digests of their sets."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    cut = F.col("ts") >= F.lit(_CUT).cast("timestamp_ntz")
    before, after = (events.filter(c).select("user_id", "event_type").distinct() for c in (~cut, cut))
    return changes.unchanged_groups(before, after, "user_id", "event_type")


_TIME = "2026-01-01T00:00:00.000000+00:00"


def _order_batch(spark, sf_dir):
    """Customers as files and orders as their nodes: the batch has the orders that are final or
    open, the state before it those that are open or partial. Customers in debt fail. Gives the batch and
    the nodes and edges before it."""
    customers = table(spark, sf_dir, "customer").select(
        F.lit(REPOSITORY).alias("repository"),
        F.concat(F.lit("customer/"), F.col("c_custkey").cast("string")).alias("path"),
        ids.sha256(F.col("c_name")).alias("content_sha256"), "c_custkey",
        "c_acctbal", F.when(F.col("c_acctbal") < 0, "FAILED").otherwise("PARSED").alias("status"),
    ).withColumn("file_id", ids.file_id(F.col("repository"), F.col("path")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").join(
        sequence.merged(customers), F.col("o_custkey") == F.col("c_custkey"))
    spath = F.concat(F.lit("root.orders["), F.col("o_orderkey").cast("string"), F.lit("]"))
    nodes = orders.withColumns({"structural_path": spath, "node_type": F.lit("Order")}).withColumn(
        "node_id", ids.node_id(F.col("file_id"), F.col("structural_path"), F.col("node_type")))
    shaped = nodes.select(
        "repository", "path", "file_id", "content_sha256", "status", "o_orderstatus", "node_id",
        "structural_path", "node_type", F.lit("Order").alias("label"), F.lit(0).alias("lineno"),
        F.lit(0).alias("col_offset"), F.lit(0).alias("end_lineno"), F.lit(0).alias("end_col_offset"),
        F.lit("").alias("code"),
        F.concat(F.lit('{"status":"'), F.col("o_orderstatus"), F.lit('"}')).alias("properties"),
        F.col("o_orderkey").alias("ord"))
    current = shaped.filter("o_orderstatus in ('F', 'O') and status = 'PARSED'").drop("status", "o_orderstatus")
    previous = shaped.filter("o_orderstatus in ('O', 'P')").drop("status", "o_orderstatus")
    root = ids.node_id(F.col("file_id"), F.lit("root"), F.lit("Module"))

    def edges(df):
        kept = df.select(
            "repository", "path", "file_id", "content_sha256", F.lit("AST").alias("edge_type"),
            root.alias("source_id"), F.col("node_id").alias("target_id"),
            F.lit('{"field":"orders"}').alias("properties"), "ord")
        return kept.withColumn("edge_id", ids.edge_id(*(F.col(n) for n in (
            "file_id", "edge_type", "source_id", "target_id", "properties"))))

    failed = customers.filter("status = 'FAILED'").withColumns({
        "error_type": F.lit("DebtError"), "error_message": F.col("path"), "lineno": F.lit(0),
        "col_offset": F.lit(0)})
    errors = failed.withColumn("error_id", ids.error_id(
        F.col("file_id"), F.col("error_type"), F.col("lineno"), F.col("col_offset"), F.col("error_message")))
    metadata = customers.select(
        "repository", "path", "file_id", "content_sha256", F.lit(C.LANGUAGE).alias("language"),
        F.lit(0).cast("long").alias("size_bytes"), F.lit(0).alias("line_count"),
        *(F.lit(0).alias(n) for n in C.COUNT_FIELDS), "status")
    batch = Extraction(files=customers, nodes=current, edges=edges(current), errors=errors, metadata=metadata)
    return batch, previous, edges(previous)


def _order_revision(spark, sf_dir):
    return feed.change_feed(*_order_batch(spark, sf_dir), F.lit(_TIME))


def _envelope_sql(event_type: str) -> str:
    return (f"'{{\"schema_version\":\"1.0.0\",\"event_type\":\"{event_type}\",\"event_time\":\"{_TIME}\","
            f"\"repository\":\"{REPOSITORY}\",\"file_id\":\"' || f || '\",\"path\":\"' || path || "
            f"'\",\"content_sha256\":\"' || sha || '\"'")


_FEED_SQL = f"""
    with c as (
        select c_custkey, 'customer/' || c_custkey as path, sha256(c_name) as sha,
               sha256('{REPOSITORY}:customer/' || c_custkey) as f, c_acctbal < 0 as failed
        from customer),
    o as (
        select *, 'root.orders[' || o_orderkey || ']' as sp,
               sha256(f || ':root.orders[' || o_orderkey || ']:Order') as node_id,
               sha256(f || ':root:Module') as root_id
        from orders join c on c_custkey = o_custkey where not failed),
    e as (
        select *, sha256(f || ':AST:' || root_id || ':' || node_id || ':{{"field":"orders"}}') as edge_id from o),
    all_events as (
        select 'edge' as category, edge_id as key, f as file_id, 'EDGE_DELETE' as event_type, 0 as op_rank,
               {_envelope_sql("EDGE_DELETE")} || ',"edge_id":"' || edge_id || '","edge_type":"AST","source_id":"'
               || root_id || '","target_id":"' || node_id || '"}}' as value
        from e where o_orderstatus = 'P'
        union all
        select 'node', node_id, f, 'NODE_DELETE', 1,
               {_envelope_sql("NODE_DELETE")} || ',"node_id":"' || node_id || '"}}'
        from e where o_orderstatus = 'P'
        union all
        select 'node', node_id, f, 'NODE_UPSERT', 2,
               {_envelope_sql("NODE_UPSERT")} || ',"node_id":"' || node_id || '","structural_path":"' || sp
               || '","node_type":"Order","label":"Order","lineno":0,"col_offset":0,"end_lineno":0,'
               || '"end_col_offset":0,"code":"","properties":{{"status":"' || o_orderstatus || '"}}}}'
        from e where o_orderstatus in ('F', 'O')
        union all
        select 'edge', edge_id, f, 'EDGE_UPSERT', 3,
               {_envelope_sql("EDGE_UPSERT")} || ',"edge_id":"' || edge_id || '","edge_type":"AST","source_id":"'
               || root_id || '","target_id":"' || node_id || '","properties":{{"field":"orders"}}}}'
        from e where o_orderstatus in ('F', 'O')
        union all
        select 'error', sha256(f || ':DebtError:0:0:' || path), f, 'PARSER_ERROR', 4,
               {_envelope_sql("PARSER_ERROR")} || ',"error_id":"' || sha256(f || ':DebtError:0:0:' || path)
               || '","error_type":"DebtError","error_message":"' || path || '","lineno":0,"col_offset":0}}'
        from c where failed
        union all
        select 'metadata', f, f, 'FILE_METADATA_UPSERT', 5,
               {_envelope_sql("FILE_METADATA_UPSERT")} || ',"language":"python","size_bytes":0,"line_count":0,'
               || '"ast_node_count":0,"ast_edge_count":0,"cfg_edge_count":0,"dfg_edge_count":0,'
               || '"call_edge_count":0,"status":"' || case when failed then 'FAILED' else 'PARSED' end || '"}}'
        from c)"""


@query(_FEED_SQL + " select category, key, value, file_id, event_type, op_rank::bigint as op_rank from all_events")
def feed_order(spark, sf_dir):
    """The whole change feed of a revision, with event texts."""
    return _order_revision(spark, sf_dir).select(
        "category", "key", "value", "file_id", "event_type", F.col("op_rank").cast("long").alias("op_rank"))


@query(_FEED_SQL + """
    select 'cpg.' || case category when 'metadata' then category else category || 's' end as topic,
           count(*) as records, count(distinct key) as keys
    from all_events group by 1""")
def log_topics(spark, sf_dir):
    """The feed as log records by topic. Only records of keys whose offsets follow the order of their events count."""
    records = logs.log_records(_order_revision(spark, sf_dir), 1, partitions=4, by_file=True)
    rank = F.element_at(F.create_map(*(F.lit(x) for pair in feed.RANKS.items() for x in pair)), F.get_json_object("value", "$.event_type"))
    per_key = records.withColumn("rank", rank).groupBy("topic", "key").agg(
        F.count("*").alias("n"), F.collect_list(F.struct("offset", "rank")).alias("all"))
    ranks = F.transform(F.array_sort("all"), lambda r: r["rank"])
    offsets = F.size(F.array_distinct(F.transform("all", lambda r: r["offset"])))
    whole = F.when((F.col("n") == offsets) & (ranks == F.array_sort(ranks)), F.col("n"))
    return per_key.groupBy("topic").agg(F.sum(whole).alias("records"), F.count("*").alias("keys"))


@query("""
    with c as (select c_custkey, c_acctbal < 0 as failed from customer),
    o as (select o_orderstatus as s from orders join c on c_custkey = o_custkey where not failed)
    select 'corpus' as repository, (select count(*) from c) as total_files_targeted,
           (select count(*) from c where not failed) as processed_files, (select count(*) from c where failed) as error_files,
           (select count(*) from o where s in ('F', 'O')) as total_nodes_emitted,
           (select count(*) from o where s in ('F', 'O')) as total_edges_emitted,
           (select count(*) from o where s = 'P') as deleted_nodes_emitted,
           (select count(*) from o where s = 'P') as deleted_edges_emitted,
           0::bigint as ast_nodes, true as dry_run, 2.5::double as execution_duration_sec,
           '2026-01-01T00:00:02.500000+00:00' as executed_at""")
def run_summary(spark, sf_dir):
    """Counters over a batch of orders and its feed."""
    batch, nodes, edges = _order_batch(spark, sf_dir)
    started = datetime(2026, 1, 1, tzinfo=timezone.utc)
    report = feed.run_summary(feed.change_feed(batch, nodes, edges, F.lit(_TIME)), batch, REPOSITORY, started,
                              started + timedelta(seconds=2.5), dry_run=True)
    return report.withColumn("ast_nodes", F.col("cpg_breakdown.ast_nodes")).drop("cpg_breakdown")


@query(_FEED_SQL + """
    select key as error_id, file_id, json_extract_string(value, '$.path') as path, 'DebtError' as error_type, 0::bigint as lineno,
           false as corrupt
    from all_events where category = 'error'""")
def dump_errors(spark, sf_dir):
    """The error events of a feed, dumped as lines and read with their schema."""
    at = _run_folder(spark)
    logs.write_dump(_order_revision(spark, sf_dir), at)
    return logs.read_events(spark, f"{at}/category=error", "error").select(
        "error_id", "file_id", "path", "error_type", F.col("lineno").cast("long").alias("lineno"),
        F.col("_corrupt_record").isNotNull().alias("corrupt"))


@query("""
    with c as (select c_acctbal < 0 as other from customer)
    select 'one version' as state, (select count(*) from c) as files, false as refused
    union all select 'two versions', null, (select bool_or(other) from c)""")
def version_guard(spark, sf_dir):
    """Earlier state is read whole if it is all of this version, and refused if some of it is not."""
    batch, _, edges = _order_batch(spark, sf_dir)
    every = batch.files.withColumn("status", F.lit("PARSED"))
    roots = every.select("file_id", F.col("file_id").alias("node_id"))
    found = []
    for name in ("one version", "two versions"):
        root = f"{_run_folder(spark)}/state"
        commit_state(Extraction(files=every, nodes=roots, edges=edges, errors=batch.errors, metadata=batch.metadata), root, 1, digits=1)
        if name != "one version":
            marked = every.where("c_acctbal < 0").select(
                "file_id", F.lit("").alias("node_id"), F.lit(C.STATE_VERSION + 1).alias("state_version"),
                F.substring("file_id", 1, 1).alias("prefix"), F.lit(0).alias("slot"))
            marked.write.mode("append").partitionBy("prefix", "slot").parquet(f"{root}/nodes")
        try:
            found.append((name, previous_state(spark, every, root, 2)["nodes"].count(), False))
        except PySparkException as problem:
            if "another version" not in str(problem):
                raise
            found.append((name, None, True))
    return spark.createDataFrame(found, "state string, files long, refused boolean")


@query("""
    with d as (select doc_id, coalesce(toxic, 0) = 1 as failed, text
               from documents left join labels using (doc_id)),
    lines as (select doc_id, failed, unnest(string_split(text, chr(10))) as line from d),
    keys as (select distinct doc_id, failed, sha256(line) as k, line from lines)
    select doc_id, count(*) filter (failed or length(line) > 40) as nodes,
           case when failed then 'FAILED' else 'PARSED' end as status
    from keys group by doc_id, failed""")
def failed_keeps_state(spark, sf_dir):
    """Documents as files and their lines as nodes. The new revision drops short lines, but a file
    that fails keeps all it had."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text").join(
        table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    failed = F.coalesce(F.col("toxic") == 1, F.lit(False))
    previous = documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).select(
        "doc_id", ids.sha256(F.col("line")).alias("node_id"), F.length("line").alias("size")).distinct()
    current = previous.filter("size > 40").select("doc_id", "node_id")
    files = documents.select("doc_id", F.when(failed, "FAILED").otherwise("PARSED").alias("status"))
    stale = changes.stale_rows(
        previous, current, files.filter("status = 'PARSED'"), "doc_id", "node_id")
    kept = changes.missing_from(previous, stale, ["doc_id", "node_id"])
    counted = kept.groupBy("doc_id").agg(F.count("*").alias("nodes"))
    return files.join(counted, "doc_id", "left").select(
        "doc_id", F.coalesce("nodes", F.lit(0).cast("long")).alias("nodes"), "status")


# --- current state ----------------------------------------------------------------------------

@query("""
    select user_id, event_id, event_type, props from events
    qualify row_number() over (partition by user_id order by event_id desc) = 1""")
def compact_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "props")
    return sequence.latest_by_key(events, ["user_id"], ["event_id"])


@query("""
    select event_type, user_id, event_id from events
    qualify row_number() over (partition by event_type order by event_id) = 1""")
def first_by_topic(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    return sequence.first_by_group(events, ["event_type"], ["event_id"])


_CDC_SQL = """
    select user_id, props, event_id from events
    qualify row_number() over (partition by user_id, props order by event_id desc) = 1"""


@query(f"""
    select key, event_id from (
        select user_id || '/' || props as key, event_id, event_type from events
        qualify row_number() over (partition by user_id || '/' || props order by event_id desc) = 1)
    where event_type <> 'error'""")
def cdc_apply(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), "props").alias("key"), "event_id", "event_type")
    return changes.apply_changes(log, "key", ["event_id"], F.col("event_type") == "error").drop("event_type")


@query("""
    with gone as (select p_partkey, p_size % 5 as gone_at from part where p_size > 20)
    select l_partkey, l_suppkey, count(*) as n from lineitem
    where not exists (select 1 from gone where p_partkey = l_partkey and gone_at > l_linenumber)
      and not exists (select 1 from gone where p_partkey = l_suppkey and gone_at > l_linenumber)
    group by all""")
def detach_delete(spark, sf_dir):
    log = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("node"), (F.col("p_size") % 5).alias("seq"), "p_size")
    deletes = changes.last_deletes(log, "node", "seq", F.col("p_size") > 20)
    edges = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber")
    kept = changes.detach(edges, deletes, "node", "l_partkey", "l_suppkey", "l_linenumber")
    return kept.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))


@query("""
    with n as (select 'p' || p_partkey as id, p_brand from part where p_size > 10
               union all select 's' || s_suppkey, null from supplier where s_acctbal > 0),
    e as (select 'p' || l_partkey as id from lineitem union select 's' || l_suppkey from lineitem)
    select id, p_brand as node_type from n union all select id, null from e where id not in (select id from n)""")
def placeholder_nodes(spark, sf_dir):
    name = lambda mark, key: F.concat(F.lit(mark), F.col(key).cast("string"))
    nodes = table(spark, sf_dir, "part").filter("p_size > 10").select(
        name("p", "p_partkey").alias("id"), F.col("p_brand").alias("node_type")
    ).unionByName(table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(
        name("s", "s_suppkey").alias("id"), F.lit(None).cast("string").alias("node_type")))
    edges = table(spark, sf_dir, "lineitem").select(
        name("p", "l_partkey").alias("source_id"), name("s", "l_suppkey").alias("target_id"))
    return changes.with_placeholders(nodes, edges, "id", "source_id", "target_id")


@query("""
    select event_id, user_id from events
    where ts >= (select max(ts) from events) - interval 7 days""")
def retention(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    newest = events.agg(F.max("ts")).scalar()
    return changes.retain(events, "ts", newest).drop("ts")


# --- log records and streams --------------------------------------------------------------------

def _metadata_log(spark, sf_dir):
    """Events as records of the metadata topic: users are files, an event is a revision of one.
    Errors have broken text, clicks another schema version, signups no time."""
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    event = F.struct(
        F.when(F.col("event_type") == "click", "2.0.0").otherwise(C.SCHEMA_VERSION).alias("schema_version"),
        F.when(F.col("event_type") == "signup", "never").otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).alias("event_time"),
        F.lit(C.FILE_METADATA_UPSERT).alias("event_type"),
        ids.file_id(F.lit(REPOSITORY), user).alias("file_id"),
        F.lit(REPOSITORY).alias("repository"), user.alias("path"),
        ids.sha256(F.col("props")).alias("content_sha256"),
        F.get_json_object("props", "$.k").cast("int").alias("line_count"))
    shown = F.to_json(event)
    return events.select(
        ids.file_id(F.lit(REPOSITORY), user).alias("key"),
        F.when(F.col("event_type") == "error", F.substring(shown, 1, 60)).otherwise(shown).alias("value"),
        F.lit(C.TOPICS["metadata"]).alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("revision_seq"))


_DOCUMENT_SQL = f"""
    select sha256('{REPOSITORY}:' || user_id) as _id, sha256(props) as content_sha256,
           json_extract_string(props, '$.k')::bigint as line_count, event_id as kafka_offset,
           case when event_type <> 'signup' then epoch_us(ts) end as event_time_us
    from events where event_type not in ('error', 'click')"""


@query(_DOCUMENT_SQL)
def contract_filter(spark, sf_dir):
    return sinks.documents(_metadata_log(spark, sf_dir)).select(
        "_id", "content_sha256", F.col("line_count").cast("long").alias("line_count"), "kafka_offset",
        F.unix_micros("event_time_utc").alias("event_time_us"))


@query("""
    select count(*) filter (event_type not in ('error', 'click')) as accepted,
           count(*) filter (event_type in ('error', 'click')) as rejected from events""")
def rejected_records(spark, sf_dir):
    return sinks.rejected_count(_metadata_log(spark, sf_dir), "metadata")


def _run_folder(spark) -> str:
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


LOG_FILES = 4       # batches that a stream reads a log in, of as many files each as its size asks for
LOG_FILE_ROWS = 250_000


def _write_log(records, folder):
    """A log in several batches of files, so that most keys cross them and a later batch often holds an older record. Gives
    the number of files a batch, which keeps what one task writes and reads at about ``LOG_FILE_ROWS`` records."""
    files = max(1, -(-records.count() // (LOG_FILES * LOG_FILE_ROWS)))
    records.repartition(LOG_FILES * files).write.mode("append").parquet(folder)
    return files


def _with_batches(spark, state, target):
    """``state`` with the number of runs and batches that count in its stored table."""
    stored = sinks.stored_batches(spark, target)
    count = lambda name: stored.agg(F.count_distinct(name)).scalar()
    return state.withColumn("runs", count("run_id")).withColumn("batches", count("batch_id"))


def _run_documents(spark, at, files, replays_within=None):
    stream = logs.stream_log(spark, f"{at}/log", C.TOPICS["metadata"], files_per_trigger=files)
    stream = logs.without_replays(stream, replays_within) if replays_within else stream
    sinks.start_documents(stream, f"{at}/table", f"{at}/checkpoint", None).awaitTermination()


def _stored_documents(spark, at):
    return _with_batches(spark, sinks.current_documents(spark, f"{at}/table").select(
        "_id", "content_sha256", F.col("line_count").cast("long").alias("line_count"), "kafka_offset",
        F.unix_micros("event_time_utc").alias("event_time_us")), f"{at}/table")


_LAST_DOCUMENT_SQL = f"""
    select *, 1::bigint as runs, {{batches}}::bigint as batches from ({_DOCUMENT_SQL}
    qualify row_number() over (partition by user_id order by event_id desc) = 1)"""


@query(_LAST_DOCUMENT_SQL.format(batches=LOG_FILES))
def stream_upsert(spark, sf_dir):
    """Metadata stream end to end, in several batches: log folder -> keyed table -> current documents."""
    at = _run_folder(spark)
    _run_documents(spark, at, _write_log(_metadata_log(spark, sf_dir), f"{at}/log"))
    return _stored_documents(spark, at)


@query(_LAST_DOCUMENT_SQL.format(batches=2 * LOG_FILES))
def stream_restart(spark, sf_dir):
    """The metadata stream run, run again without new input, and run once more after the whole log was published
    a second time: one run by its checkpoint, and the same documents."""
    at = _run_folder(spark)
    records = _metadata_log(spark, sf_dir)
    files = _write_log(records, f"{at}/log")
    _run_documents(spark, at, files)
    _run_documents(spark, at, files)
    _run_documents(spark, at, _write_log(records, f"{at}/log"))
    return _stored_documents(spark, at)


@query(f"""
    select *, 0::bigint as stored_twice from ({_DOCUMENT_SQL} qualify row_number() over (partition by user_id order by event_id desc) = 1)""")
def stream_suppressed(spark, sf_dir):
    """The log published a second time while the stream remembers it: no record is stored twice."""
    at = _run_folder(spark)
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("timestamp"))
    records = _metadata_log(spark, sf_dir).drop("timestamp").join(events, F.col("offset") == F.col("event_id")).drop("event_id")
    for _ in range(2):
        _run_documents(spark, at, _write_log(records, f"{at}/log"), "60 days")
    stored = sinks.stored(spark, f"{at}/table")
    twice = stored.groupBy("_id", "kafka_offset").count().where("count > 1").agg(F.count("*")).scalar()
    return sinks.current_documents(spark, f"{at}/table").select(
        "_id", "content_sha256", F.col("line_count").cast("long").alias("line_count"), "kafka_offset",
        F.unix_micros("event_time_utc").alias("event_time_us")).withColumn("stored_twice", twice)


@query(f"""
    select *, 2::bigint as runs, {LOG_FILES + 1}::bigint as batches from ({_DOCUMENT_SQL}
    qualify row_number() over (partition by user_id order by event_id desc) = 1)""")
def stream_compacted(spark, sf_dir):
    """The metadata stream over a first part of the log, a compaction of its table, and the stream again over the rest:
    the base and the batches after it count."""
    at = _run_folder(spark)
    records = _metadata_log(spark, sf_dir)
    middle = table(spark, sf_dir, "events").agg(F.percentile_approx("event_id", 0.5)).scalar()
    first = F.col("offset") < middle
    _run_documents(spark, at, _write_log(records.filter(first), f"{at}/log"))
    sinks.compact_documents(spark, f"{at}/table")
    _run_documents(spark, at, _write_log(records.filter(~first), f"{at}/log"))
    return _stored_documents(spark, at)


@query(f"""
    with e as (select * from events where event_type = 'error')
    select sha256('{REPOSITORY}:' || user_id || ':' || event_id) as error_id, event_id as "offset", 'SyntaxError' as error_type,
           1::bigint as runs, {LOG_FILES}::bigint as batches
    from e where ts >= (select max(ts) from e) - interval {C.ERROR_RETENTION_DAYS} days""")
def stream_errors(spark, sf_dir):
    """Error stream in several batches; what is older than the retention time at the last record is left out."""
    at = _run_folder(spark)
    events = table(spark, sf_dir, "events").filter("event_type = 'error'")
    user = F.col("user_id").cast("string")
    key = ids.sha256(F.concat(F.lit(f"{REPOSITORY}:"), user, F.lit(":"), F.col("event_id").cast("string")))
    event = F.struct(
        F.lit(C.SCHEMA_VERSION).alias("schema_version"), F.lit(C.PARSER_ERROR).alias("event_type"),
        F.lit("unknown").alias("event_time"), F.lit(REPOSITORY).alias("repository"),
        ids.file_id(F.lit(REPOSITORY), user).alias("file_id"), user.alias("path"), F.lit("").alias("content_sha256"),
        key.alias("error_id"), F.lit("SyntaxError").alias("error_type"), F.col("props").alias("error_message"),
        F.lit(0).alias("lineno"), F.lit(0).alias("col_offset"))
    files = _write_log(events.select(
        key.alias("key"), F.to_json(event).alias("value"), F.lit(C.TOPICS["error"]).alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("long").alias("revision_seq")), f"{at}/log")
    stream = logs.stream_log(spark, f"{at}/log", C.TOPICS["error"], files_per_trigger=files)
    sinks.start_errors(stream, f"{at}/table", f"{at}/checkpoint", None).awaitTermination()
    newest = sinks.stored(spark, f"{at}/table").agg(F.max("log_time")).scalar()
    recent = sinks.recent_errors(spark, f"{at}/table", newest).select("error_id", "offset", "error_type")
    return _with_batches(spark, recent, f"{at}/table")


@query(_DOCUMENT_SQL.replace("event_id as kafka_offset,", "").replace("not in ('error', 'click')", "<> 'error'").replace(
    "from events", ", event_type = 'click' as rejected from events")
    + " qualify row_number() over (partition by user_id, event_type = 'click' order by event_id desc) = 1")
def dump_round_trip(spark, sf_dir):
    """Several events a key as a dump of one category, replayed into a log: the last of each key in event order, for
    records that a sink takes and for those that it rejects."""
    at = _run_folder(spark)
    whole = _metadata_log(spark, sf_dir).filter(F.col("value").endswith("}"))
    logs.write_dump(whole.select(
        F.lit("metadata").alias("category"), "key", "value", F.col("key").alias("file_id"),
        F.lit(C.FILE_METADATA_UPSERT).alias("event_type"), F.lit(0).alias("op_rank"),
        F.lpad(F.col("offset").cast("string"), 20, "0").alias("ord")), f"{at}/dump")
    logs.publish(logs.replay_dumps(spark, f"{at}/dump", partitioned=True), f"{at}/log", 1)
    decoded = sinks.decode_events(logs.read_log(spark, f"{at}/log", C.TOPICS["metadata"]), "metadata").withColumn(
        "rejected", ~sinks.accepted("metadata"))
    last = sequence.latest_by_key(decoded.select("key", "rejected", "revision_seq", "offset", "event"), ["key", "rejected"],
                                  sinks.DOCUMENT_ORDER[:1] + sinks.GRAPH_ORDER[1:])
    return last.select(
        F.col("key").alias("_id"), "event.content_sha256", F.col("event.line_count").cast("long").alias("line_count"),
        F.unix_micros(text.event_time(F.col("event.event_time"))).alias("event_time_us"), "rejected")


@query(f"""
    select sha256('{REPOSITORY}:' || user_id || '/' || props) as node_id, event_id as "offset",
           1::bigint as runs, {LOG_FILES}::bigint as batches
    from ({_CDC_SQL.replace("select user_id, props, event_id", "select user_id, props, event_id, event_type")})
    where event_type <> 'error'""")
def stream_graph(spark, sf_dir):
    """Node stream end to end; errors delete the node of their user and properties."""
    at = _run_folder(spark)
    events = table(spark, sf_dir, "events")
    node = F.concat_ws("/", F.col("user_id").cast("string"), "props")
    key = ids.file_id(F.lit(REPOSITORY), node)
    kind = F.when(F.col("event_type") == "error", C.NODE_DELETE).otherwise(C.NODE_UPSERT)
    event = F.struct(
        F.lit(C.SCHEMA_VERSION).alias("schema_version"), kind.alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"),
        F.lit(REPOSITORY).alias("repository"), key.alias("file_id"), node.alias("path"),
        F.lit("").alias("content_sha256"), key.alias("node_id"), F.col("event_type").alias("node_type"))
    records = events.select(
        key.alias("key"), F.to_json(event).alias("value"), F.lit(C.TOPICS["node"]).alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"), F.lit(None).cast("long").alias("revision_seq"))
    files = _write_log(records, f"{at}/log")
    stream = logs.stream_log(spark, f"{at}/log", C.TOPICS["node"], files_per_trigger=files)
    sinks.start_graph(stream, "node", f"{at}/table", f"{at}/checkpoint", None).awaitTermination()
    return _with_batches(spark, sinks.current_nodes(sinks.stored(spark, f"{at}/table")).select("node_id", "offset"), f"{at}/table")


# Nodes and edges of the derived texts: of the first revision, and of the second one.
@query(f"""
    with s as (
        select 'suppliers/' || s_suppkey || '.py' as path, s_acctbal > 5000 as edited, s_acctbal < 0 as broken
        from supplier)
    select sha256('{REPOSITORY}:' || path) as file_id, path,
           (case when edited then 51 + 3 * 8 else 47 + 8 end)::bigint as file_nodes,
           (case when edited then 50 + 12 + 9 + 2 + 3 * 10 else 46 + 8 + 8 + 3 + 10 end)::bigint as file_edges,
           (case when broken then 0 when edited then 9 + 3 else 8 + 1 end)::bigint as dfg_edge_count,
           case when broken then 'FAILED' else 'PARSED' end as status
    from s""")
def replay_graph(spark, sf_dir):
    """The whole pipeline over two revisions: extraction, diff, log, streams and current state. In the
    second revision some files are edited, some are broken and the others are not in the batch."""
    at = Locations(_run_folder(spark))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")

    def texts(df, kind, steps):
        return derived.row_files(df, REPOSITORY, "suppliers", "s_suppkey", "s_nationkey", F.lit(kind), F.lit(steps))

    edited = texts(suppliers.filter("s_acctbal > 5000"), 1, 3)
    broken = texts(suppliers.filter("s_acctbal < 0"), 0, 1).withColumn(
        "content", F.lit("def broken(:\n").cast("binary"))
    run_batch(spark, texts(suppliers, 0, 1), at, 1, partitions=4)
    run_batch(spark, edited.unionByName(broken), at, 2, partitions=4)
    drain(spark, at)
    current = sinks.graph_by_file(spark, at.table("node"), at.table("edge"))
    counted = current.groupBy("file_id").agg(
        *(F.count_if(F.col("kind") == kind).alias(f"file_{kind}s") for kind in ("node", "edge")))
    documents = sinks.current_documents(spark, at.table("metadata")).select(
        "file_id", "path", F.col("dfg_edge_count").cast("long").alias("dfg_edge_count"), "status")
    return documents.join(counted, "file_id", "full").select(
        "file_id", "path", "file_nodes", "file_edges", "dfg_edge_count", "status")


@query(f"""
    with s as (select 'suppliers/' || s_suppkey || '.py' as path, s_acctbal > 5000 as edited from supplier)
    select sha256('{REPOSITORY}:' || path) as file_id, (case when edited then 51 + 3 * 8 else 47 + 8 end)::bigint as nodes,
           (case when edited then 50 + 12 + 9 + 2 + 3 * 10 else 46 + 8 + 8 + 3 + 10 end)::bigint as edges,
           0::bigint as missing, 0::bigint as stale
    from s""")
def recompute_compare(spark, sf_dir):
    """Files extracted again, against the ids that two batches stored for them: exact in both directions."""
    at = Locations(_run_folder(spark))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")

    def texts(df, kind, steps):
        return derived.row_files(df, REPOSITORY, "suppliers", "s_suppkey", "s_nationkey", F.lit(kind), F.lit(steps))

    edited = texts(suppliers.filter("s_acctbal > 5000"), 1, 3)
    for revision, batch in enumerate((texts(suppliers, 0, 1), edited), start=1):
        commit_state(extract(batch), at.state, revision)
    again = extract(edited.unionByName(texts(suppliers.filter("not s_acctbal > 5000"), 0, 1)))
    stored = previous_state(spark, again.files, at.state, 3)
    side = lambda df, kind, key, name: df.select("file_id", F.lit(kind).alias("kind"), F.col(key).alias("id"), F.lit(name).alias("side"))
    both = functools.reduce(DataFrame.unionByName, (
        side(df, kind, key, name) for name, found in (("expected", (again.nodes, again.edges)), ("actual", (stored["nodes"], stored["edges"])))
        for kind, key, df in zip(("node", "edge"), ("node_id", "edge_id"), found, strict=True)))
    # dealt out once, by file, for both steps: ids of a file lie together
    per_id = both.repartition("file_id").groupBy("file_id", "kind", "id").agg(
        *(F.count_if(F.col("side") == name).alias(name) for name in ("expected", "actual")))
    rows = lambda name, where: F.coalesce(F.sum(F.when(where, F.col(name))), F.lit(0).cast("long"))
    return per_id.groupBy("file_id").agg(
        rows("expected", F.col("kind") == "node").alias("nodes"), rows("expected", F.col("kind") == "edge").alias("edges"),
        rows("expected", F.col("actual") == 0).alias("missing"), rows("actual", F.col("expected") == 0).alias("stale"))


@query(f"""
    select sha256('{REPOSITORY}:samples/' || s_suppkey || '.py') as _id, sha256(s_name) as content_sha256,
           s_nationkey::bigint as line_count from supplier""")
def sample_log(spark, sf_dir):
    """Sample events, one file each and laid out over many lines, published with their keys and read as documents."""
    at = _run_folder(spark)
    path = F.concat(F.lit("samples/"), F.col("s_suppkey").cast("string"), F.lit(".py"))
    event = F.struct(
        F.lit(C.SCHEMA_VERSION).alias("schema_version"), F.lit(C.FILE_METADATA_UPSERT).alias("event_type"), F.lit(_TIME).alias("event_time"),
        F.lit(REPOSITORY).alias("repository"), ids.file_id(F.lit(REPOSITORY), path).alias("file_id"), path.alias("path"),
        ids.sha256(F.col("s_name")).alias("content_sha256"), F.col("s_nationkey").alias("line_count"))
    samples = table(spark, sf_dir, "supplier").select("s_suppkey", F.to_json(event, {"pretty": "true"}).alias("value"))
    # many tasks write the files, one a record, and each moves its own into place
    (
        samples.select("value").repartition(4 * spark.sparkContext.defaultParallelism).write.option("maxRecordsPerFile", 1)
        .option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(f"{at}/samples")
    )
    logs.publish(logs.sample_events(spark, f"{at}/samples", "metadata"), f"{at}/log", 1)
    return sinks.documents(logs.read_log(spark, f"{at}/log", C.TOPICS["metadata"])).select(
        "_id", "content_sha256", F.col("line_count").cast("long").alias("line_count"))
