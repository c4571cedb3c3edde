"""Driver queries: contract rules, aggregates, reconciliation and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.functions import ids
from graphloom.functions.rules import with_violations
from graphloom.operators import changes, checks, documents
from graphloom.plans.catalog import REPOSITORY, query, table


@query(f"""
    select event_id, array_to_string(list_sort(list_distinct([
        case when event_type = 'click' then 'const:schema_version' end,
        case when event_type = 'error' then 'required:file_id' end,
        case when event_type = 'signup' then 'pattern:file_id' end,
        case when event_type = 'signup' then 'format:event_time' end,
        case when event_type = 'error' then 'additionalProperties:extra' end,
        case when k < 20 then 'minimum:line_count' end,
        case when k >= 90 then 'type:size_bytes' end,
        case when k % 2 = 0 then 'enum:status' end,
        case when k = 33 then 'minLength:path' end
    ])), ',') as violations
    from (select *, json_extract_string(props, '$.k')::bigint as k from events)""")
def contract_violations(spark, sf_dir):
    """Rules that metadata events made from the event table break."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    kind = F.col("event_type")
    file = ids.sha256(F.col("user_id").cast("string"))
    event = F.struct(
        F.when(kind == "click", "1.0.1").otherwise(C.SCHEMA_VERSION).alias("schema_version"),
        F.lit(C.FILE_METADATA_UPSERT).alias("event_type"),
        F.when(kind == "signup", F.date_format("ts", "yyyy-MM-dd HH:mm")).otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).alias("event_time"),
        F.lit(REPOSITORY).alias("repository"),
        F.when(kind == "signup", F.upper(F.concat(F.lit("A"), F.substring(file, 2, 63)))).when(
            kind != "error", file).alias("file_id"),
        F.when(F.col("k") == 33, "").otherwise("a.py").alias("path"), F.lit("").alias("content_sha256"),
        F.lit("python").alias("language"), F.when(F.col("k") < 90, F.col("k")).alias("size_bytes"),
        F.when(F.col("k") >= 90, F.col("k").cast("string")).alias("_size_text"),
        (F.col("k") - 20).alias("line_count"), *(F.col("k").alias(n) for n in C.COUNT_FIELDS),
        F.when(F.col("k") % 2 == 0, "parsed").otherwise("PARSED").alias("status"),
        F.when(kind == "error", "x").alias("extra"))
    value = F.replace(F.to_json(event), F.lit("_size_text"), F.lit("size_bytes"))
    checked = with_violations(events.select("event_id", value.alias("value")), "metadata")
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


@query(f"""
    select coalesce(quality::varchar, '{C.PLACEHOLDER}') as kind, count(*) as n
    from documents left join labels using (doc_id) group by 1""")
def type_breakdown(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return checks.breakdown(joined, F.col("quality").cast("string"))


@query("select event_type as kind, count(*) as n from events group by 1")
def edge_breakdown(spark, sf_dir):
    return checks.breakdown(table(spark, sf_dir, "events"), F.col("event_type"), "<unknown>")


@query("select count(*) as text_total, count(distinct sha256(text)) as text_distinct from documents")
def distinct_totals(spark, sf_dir):
    hashed = table(spark, sf_dir, "documents").select(ids.sha256(F.col("text")).alias("id"))
    return checks.totals(hashed, "id", "text")


@query("""
    select sha256(text) as id, count(*) as n from documents group by 1 having count(*) > 1
    order by n desc, id limit 10""")
def duplicate_ids(spark, sf_dir):
    hashed = table(spark, sf_dir, "documents").select(ids.sha256(F.col("text")).alias("id"))
    return checks.duplicates(hashed, "id")


@query("""
    select count(*) as duplicate_ids from (
        select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1)""")
def duplicate_count(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(
        F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"))
    return checks.duplicate_count(keys, "id")


_GRAPH_SQL = """
    nodes as (select 'p' || p_partkey as node_id from part where p_size > 2
              union all select 's' || s_suppkey from supplier where s_acctbal > -500),
    edges as (select sha256(l_orderkey || ':' || l_partkey || ':' || l_suppkey) as edge_id,
                     'p' || l_partkey as source_id, 's' || l_suppkey as target_id from lineitem)"""


def _part_graph(spark, sf_dir):
    name = lambda mark, key: F.concat(F.lit(mark), F.col(key).cast("string"))
    nodes = table(spark, sf_dir, "part").filter("p_size > 2").select(
        name("p", "p_partkey").alias("node_id"), F.col("p_type").alias("node_type")
    ).unionByName(table(spark, sf_dir, "supplier").filter("s_acctbal > -500").select(
        name("s", "s_suppkey").alias("node_id"), F.lit(None).cast("string").alias("node_type")))
    text = lambda key: F.col(key).cast("string")
    edges = table(spark, sf_dir, "lineitem").select(
        ids.digest_of(text("l_orderkey"), text("l_partkey"), text("l_suppkey")).alias("edge_id"),
        name("p", "l_partkey").alias("source_id"), name("s", "l_suppkey").alias("target_id"),
        F.when(F.col("l_returnflag") == "A", "AST").when(F.col("l_returnflag") == "N", "CFG")
        .otherwise("DFG").alias("edge_type"))
    return nodes, edges


@query(f"""
    with {_GRAPH_SQL},
    r as (
        select (select count(*) from nodes) as node_events, (select count(distinct node_id) from nodes) as distinct_node_ids,
               (select count(*) from edges) as edge_events, (select count(distinct edge_id) from edges) as distinct_edge_ids,
               (select count(*) from orders) as metadata_events,
               (select count(distinct o_orderkey) from orders) as distinct_metadata_file_ids,
               (select count(*) from labels where toxic = 1) as error_events,
               (select count(distinct source_id) from edges where source_id not in (select node_id from nodes)) as missing_edge_sources,
               (select count(distinct target_id) from edges where target_id not in (select node_id from nodes)) as missing_edge_targets)
    select *, case when node_events = distinct_node_ids and edge_events = distinct_edge_ids and error_events = 0
                        and missing_edge_sources = 0 and missing_edge_targets = 0
                        and metadata_events = 15000 and distinct_metadata_file_ids = 15000
                   then 'PASS' else 'FAIL' end as status
    from r""")
def referential_integrity(spark, sf_dir):
    nodes, edges = _part_graph(spark, sf_dir)
    metadata = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file_id"))
    errors = table(spark, sf_dir, "labels").filter("toxic = 1")
    return checks.corpus_integrity(nodes, edges, metadata, errors, 15000)


@query(f"""
    with {_GRAPH_SQL},
    r as (
        select (select count(*) from nodes) as total_nodes, (select count(distinct node_id) from nodes) as distinct_node_ids,
               (select count(*) from edges) as total_edges, (select count(distinct edge_id) from edges) as distinct_edge_ids,
               (select count(*) from supplier where s_acctbal > -500) as placeholder_nodes,
               (select count(*) from lineitem where l_returnflag = 'A') as "AST",
               (select count(*) from lineitem where l_returnflag = 'N') as "CFG",
               (select count(*) from lineitem where l_returnflag = 'R') as "DFG", 0::bigint as "CALL"),
    m as (
        select *, concat_ws('; ',
            case when total_nodes <> 2000 then 'total_nodes: expected 2000, got ' || total_nodes end,
            case when placeholder_nodes <> 0 then 'placeholder_nodes: expected 0, got ' || placeholder_nodes end,
            case when "AST" <> 20000 then 'AST edges: expected 20000, got ' || "AST" end,
            case when "CALL" <> 0 then 'CALL edges: expected 0, got ' || "CALL" end,
            case when total_nodes <> distinct_node_ids then 'duplicate node_id values detected' end,
            case when total_edges <> distinct_edge_ids then 'duplicate edge_id values detected' end
        ) as found from r)
    select * exclude (found), found as mismatches,
           case when found = '' then 'PASS' else 'FAIL' end as status from m""")
def verdict(spark, sf_dir):
    """Stored graph against expected counts."""
    nodes, edges = _part_graph(spark, sf_dir)
    report = checks.verify_graph(nodes, edges, {
        "total_nodes": 2000, "placeholder_nodes": 0, "AST": 20000, "CALL": 0})
    return report.withColumn("mismatches", F.array_join("mismatches", "; "))


@query("""
    select coalesce(a.o_custkey, b.o_custkey) as o_custkey,
           case when b.o_custkey is null then 'missing' else 'stale' end as difference
    from (select distinct o_custkey from orders where o_orderstatus = 'F') a
    full join (select distinct o_custkey from orders where o_orderpriority = '1-URGENT') b
      on a.o_custkey = b.o_custkey
    where a.o_custkey is null or b.o_custkey is null""")
def exact_set_diff(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return changes.compare_sets(
        orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderpriority = '1-URGENT'"), "o_custkey")


@query("""
    with d as (
        select doc_id::varchar as _id, case when n_chars > 20000 then source else doc_id::varchar end as file_id,
               case when n_chars > 300 then source end as path, lang as content_sha256,
               doc_id as kafka_partition, nullif(n_chars, 500) as kafka_offset
        from documents),
    l as (select distinct doc_id::varchar as _id from labels where quality = 1),
    r as (
        select count(*) as total_documents, count(*) filter (_id <> file_id) as id_file_id_mismatches,
               count(*) filter (path is null) as missing_path,
               count(*) filter (content_sha256 is null) as missing_content_sha256,
               count(*) filter (kafka_partition is null) as missing_kafka_partition,
               count(*) filter (kafka_offset is null) as missing_kafka_offset,
               count(distinct file_id) as distinct_file_ids,
               (select count(*) from (select 1 from d group by file_id having count(*) > 1)) as duplicate_file_ids,
               count(distinct _id) as distinct_document_ids,
               (select count(*) from l where _id not in (select _id from d)) as missing_manifest_file_ids,
               (select count(*) from d where _id not in (select _id from l)) as unexpected_document_ids
        from d),
    m as (
        select *, concat_ws('; ',
            case when total_documents <> 1000 then 'total_documents: expected 1000, got ' || total_documents end,
            case when distinct_file_ids <> 1000 then 'distinct_file_ids: expected 1000, got ' || distinct_file_ids end,
            case when distinct_document_ids <> 1000 then 'distinct_document_ids: expected 1000, got ' || distinct_document_ids end,
            case when id_file_id_mismatches > 0 then '_id != file_id for ' || id_file_id_mismatches || ' documents' end,
            case when duplicate_file_ids > 0 then 'duplicate file_id values detected' end,
            case when missing_manifest_file_ids > 0 then missing_manifest_file_ids || ' manifest files are missing' end,
            case when unexpected_document_ids > 0 then unexpected_document_ids || ' unexpected documents exist' end,
            case when missing_path > 0 then 'path is absent in ' || missing_path || ' documents' end,
            case when missing_content_sha256 > 0 then 'content_sha256 is absent in ' || missing_content_sha256 || ' documents' end,
            case when missing_kafka_partition > 0 then 'kafka_partition is absent in ' || missing_kafka_partition || ' documents' end,
            case when missing_kafka_offset > 0 then 'kafka_offset is absent in ' || missing_kafka_offset || ' documents' end
        ) as found from r)
    select * exclude (found), found as mismatches,
           case when found = '' then 'PASS' else 'FAIL' end as status from m""")
def reconcile_manifest(spark, sf_dir):
    """Documents against the labelled ones, both ways."""
    text = F.col("doc_id").cast("string")
    documents = table(spark, sf_dir, "documents").select(
        text.alias("_id"), F.when(F.col("n_chars") > 20000, F.col("source")).otherwise(text).alias("file_id"),
        F.when(F.col("n_chars") > 300, F.col("source")).alias("path"), F.col("lang").alias("content_sha256"),
        F.col("doc_id").alias("kafka_partition"), F.nullif("n_chars", F.lit(500)).alias("kafka_offset"))
    manifest = table(spark, sf_dir, "labels").filter("quality = 1").select(text.alias("file_id"))
    report = checks.verify_documents(documents, manifest, 1000)
    return report.withColumn("mismatches", F.array_join("mismatches", "; "))


@query("""
    with j as (select d.doc_id, d.lang, l.quality, l.toxic from documents d left join labels l using (doc_id))
    select 'doc_id' as field, count(*) filter (doc_id is null) as missing from j
    union all select 'lang', count(*) filter (lang is null) from j
    union all select 'quality', count(*) filter (quality is null) from j
    union all select 'toxic', count(*) filter (toxic is null) from j""")
def missing_fields(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")
    return checks.missing_fields(joined, ["doc_id", "lang", "quality", "toxic"])


@query("select o_custkey, count(*) as n from orders group by 1 order by n desc, o_custkey limit 20")
def top_files(spark, sf_dir):
    return checks.top_groups(table(spark, sf_dir, "orders"), "o_custkey")


_EDGES_SQL = """
    edges as (select 'r' || n_regionkey as s, 'n' || n_nationkey as t, 'rn' || n_nationkey as id from nation
              union all select 'n' || c_nationkey, 'c' || c_custkey, 'nc' || c_custkey from customer
              union all select 'c' || o_custkey, 'o' || o_orderkey, 'co' || o_orderkey from orders),
    paths as (
        select s as start, id as edge_1, null as edge_2, t as "end", 1 as hops from edges
        where s in (select 'n' || n_nationkey from nation where n_regionkey = 1)
        union all
        select a.s, a.id, b.id, b.t, 2 from edges a join edges b on a.t = b.s and a.id <> b.id
        where a.s in (select 'n' || n_nationkey from nation where n_regionkey = 1))"""


def _shop_edges(spark, sf_dir):
    name = lambda mark, key: F.concat(F.lit(mark), F.col(key).cast("string"))

    def edges(df, up, down, source, target):
        return table(spark, sf_dir, df).select(
            name(up, source).alias("source_id"), name(down, target).alias("target_id"),
            name(up + down, target).alias("edge_id"))

    return (
        edges("nation", "r", "n", "n_regionkey", "n_nationkey")
        .unionByName(edges("customer", "n", "c", "c_nationkey", "c_custkey"))
        .unionByName(edges("orders", "c", "o", "o_custkey", "o_orderkey")))


@query(f"""
    with {_EDGES_SQL}
    select start, edge_1, edge_2, "end", hops::bigint as hops from paths""")
def two_hop(spark, sf_dir):
    """All paths of one or two edges from the nations of a region."""
    start = table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"))
    return checks.walks(_shop_edges(spark, sf_dir), start, "source_id", "target_id", "edge_id", None).withColumn(
        "hops", F.col("hops").cast("long"))


@query(f"""
    with {_EDGES_SQL}
    select start, edge_1, edge_2, "end", hops::bigint as hops from paths
    order by hops, edge_1, edge_2 nulls first limit 100""")
def two_hop_sample(spark, sf_dir):
    start = table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"))
    return checks.walks(_shop_edges(spark, sf_dir), start, "source_id", "target_id", "edge_id").withColumn(
        "hops", F.col("hops").cast("long"))


@query("""
    with a as (select o_custkey, o_orderstatus, count(*) as n from orders group by all),
    b as (select o_custkey, case when o_orderpriority = '5-LOW' then 'P' else o_orderstatus end as o_orderstatus,
                 count(*) as n from orders group by all),
    d as (select coalesce(a.n, 0) - coalesce(b.n, 0) as n from a full join b
          on a.o_custkey = b.o_custkey and a.o_orderstatus = b.o_orderstatus)
    select sum(greatest(n, 0))::bigint as only_before, sum(greatest(-n, 0))::bigint as only_after,
           sum(abs(n)) = 0 as snapshots_equal
    from d""")
def snapshot_equal(spark, sf_dir):
    before = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    after = before.withColumn("o_orderstatus", F.when(
        F.col("o_orderpriority") == "5-LOW", "P").otherwise(F.col("o_orderstatus")))
    return checks.snapshot_difference(before, after, ["o_custkey", "o_orderstatus"])


@query("""
    select user_id as file_id, strftime(ts, '%Y-%m-%d') as event_time, count(*) as n
    from events group by all""")
def revision_times(spark, sf_dir):
    """Nodes per file and event time, newest first within a file."""
    nodes = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("file_id"), F.date_format("ts", "yyyy-MM-dd").alias("event_time"))
    return checks.times_by_file(nodes)


@query("""
    select coalesce(n.f, e.f) as file_id, coalesce(n.n, 0)::bigint as file_nodes, coalesce(e.n, 0)::bigint as file_edges
    from (select o_custkey as f, count(*) as n from orders where o_orderstatus = 'F' group by 1) n
    full join (select o_custkey as f, count(*) as n from lineitem join orders on o_orderkey = l_orderkey group by 1) e
      on n.f = e.f""")
def file_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    nodes = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("file_id"))
    edges = table(spark, sf_dir, "lineitem").select("l_orderkey").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("file_id"))
    return checks.counts_by_file(nodes, edges)


@query("""
    select lang, count(*) as files, count(*) filter (toxic = 1) as error_files,
           coalesce(sum(octet_length(encode(text))), 0)::bigint as size_bytes,
           coalesce(sum(n_chars), 0)::bigint as ast_nodes
    from documents left join labels using (doc_id) group by lang""")
def corpus_rollup(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.octet_length("text").cast("long").alias("size"), "n_chars").join(
        table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return checks.rollup(joined, ["lang"], F.col("toxic") == 1, {"size_bytes": "size", "ast_nodes": "n_chars"})


@query("""
    with measured as (select 'quality' as report, quality::varchar as name, count(*) as value from labels group by 2
                      union all select 'toxic', toxic::varchar, count(*) from labels group by 2),
    expected as (select lower(c) as report, n as name, 100::bigint as value
                 from (values ('QUALITY', '0'), ('QUALITY', '1'), ('TOXIC', '0'), ('TOXIC', '1'), ('TOXIC', '2')) t(c, n))
    select e.report, e.name, e.value as expected, m.value as actual
    from expected e left join measured m on m.report = e.report and m.name = e.name
    where e.value is distinct from m.value""")
def golden_gate(spark, sf_dir):
    """Differences between measured and expected report values."""
    labels = table(spark, sf_dir, "labels")

    def report(name):
        return checks.breakdown(labels, F.col(name).cast("string")).select(
            F.lit(name).alias("report"), F.col("kind").alias("name"), F.col("n").alias("value"))

    expected = spark.createDataFrame(
        [("quality", "0", 100), ("quality", "1", 100), ("toxic", "0", 100), ("toxic", "1", 100), ("toxic", "2", 100)],
        "report string, name string, value long")
    return checks.golden_gate(report("quality").unionByName(report("toxic")), expected)


@query("""
    with d as (select c_custkey::varchar as id, case when c_acctbal < 0 then 'x' else c_custkey::varchar end as file
               from customer)
    select id, count(*) filter (true) as count_by_id,
           (select count(*) from d b where b.file = a.id) as count_by_file_id
    from d a group by id""")
def singletons(spark, sf_dir):
    """Documents per ``_id`` and per ``file_id``; both must be one."""
    key = F.col("c_custkey").cast("string")
    documents = table(spark, sf_dir, "customer").select(
        key.alias("_id"), F.when(F.col("c_acctbal") < 0, "x").otherwise(key).alias("file_id"))
    return checks.singletons(documents).withColumnRenamed("_id", "id")


@query(f"""
    with {_GRAPH_SQL},
    d as (select c_custkey::varchar as id, case when c_acctbal < 0 then 'x' else c_custkey::varchar end as file from customer),
    r as (
        select (select count(*) from (select 1 from nodes group by node_id having count(*) > 1)) as duplicate_node_ids,
               (select count(*) from (select 1 from edges group by edge_id having count(*) > 1)) as duplicate_edge_ids,
               (select count(*) from d where id = '7') as count_by_id, (select count(*) from d where file = '7') as count_by_file_id),
    m as (
        select *, concat_ws('; ',
            case when duplicate_node_ids <> 0 then 'duplicate_node_ids: expected 0, got ' || duplicate_node_ids end,
            case when duplicate_edge_ids <> 0 then 'duplicate_edge_ids: expected 0, got ' || duplicate_edge_ids end,
            case when count_by_id <> 1 then 'count_by_id: expected 1, got ' || count_by_id end,
            case when count_by_file_id <> 1 then 'count_by_file_id: expected 1, got ' || count_by_file_id end
        ) as found from r)
    select * exclude (found), found as mismatches, case when found = '' then 'PASS' else 'FAIL' end as status from m""")
def idempotency(spark, sf_dir):
    """Duplicate ids in all sinks, and the documents of one file."""
    nodes, edges = _part_graph(spark, sf_dir)
    key = F.col("c_custkey").cast("string")
    documents = table(spark, sf_dir, "customer").select(
        key.alias("_id"), F.when(F.col("c_acctbal") < 0, "x").otherwise(key).alias("file_id"))
    report = checks.verify_idempotency(nodes, edges, documents, "7")
    return report.withColumn("mismatches", F.array_join("mismatches", "; "))


@query("""
    with n as (select o_orderkey::varchar as id, o_custkey = 7 as mine, o_orderstatus as s from orders),
    e as (select l_orderkey || ':' || l_linenumber as id, o_custkey = 7 as mine, l_returnflag as s
          from lineitem join orders on o_orderkey = l_orderkey),
    en as (select id from n where mine and s in ('F', 'O')), an as (select id from n where mine and s in ('O', 'P')),
    ee as (select id from e where mine and s in ('A', 'N')), ae as (select id from e where mine and s in ('N', 'R')),
    r as (
        select (select count(*) from en) as expected_node_count, (select count(*) from an) as actual_node_count,
               (select count(distinct id) from en where id not in (select id from an)) as missing_nodes,
               (select count(distinct id) from an where id not in (select id from en)) as stale_nodes,
               (select count(*) from ee) as expected_edge_count, (select count(*) from ae) as actual_edge_count,
               (select count(distinct id) from ee where id not in (select id from ae)) as missing_edges,
               (select count(distinct id) from ae where id not in (select id from ee)) as stale_edges,
               count(*) as documents, count(distinct c_custkey) as distinct_file_ids,
               count(*) filter (c_custkey = 7) as count_by_id, count(*) filter (c_custkey = 7) as count_by_file_id,
               max(sha256(c_name)) filter (c_custkey = 7) as stored_sha256, max(c_custkey) filter (c_custkey = 7) as stored_offset,
               max(c_nationkey) filter (c_custkey = 7) as stored_revision
        from customer),
    m as (
        select *, concat_ws('; ',
            case when missing_nodes <> 0 then 'missing_nodes: expected 0, got ' || missing_nodes end,
            case when stale_nodes <> 0 then 'stale_nodes: expected 0, got ' || stale_nodes end,
            case when missing_edges <> 0 then 'missing_edges: expected 0, got ' || missing_edges end,
            case when stale_edges <> 0 then 'stale_edges: expected 0, got ' || stale_edges end,
            case when count_by_id <> 1 then 'count_by_id: expected 1, got ' || count_by_id end,
            case when count_by_file_id <> 1 then 'count_by_file_id: expected 1, got ' || count_by_file_id end,
            'stored_sha256: expected none, got ' || stored_sha256,
            case when documents <> 1500 then 'documents: expected 1500, got ' || documents end,
            case when distinct_file_ids <> 1500 then 'distinct_file_ids: expected 1500, got ' || distinct_file_ids end,
            case when stored_offset < 5 then 'offset is below 5' end,
            case when stored_revision < 100 then 'revision is below 100' end
        ) as found from r)
    select * exclude (found), found as mismatches, case when found = '' then 'PASS' else 'FAIL' end as status from m""")
def exact_state(spark, sf_dir):
    """State of one file in all sinks against what it should be: a customer's orders and their lines."""
    text = lambda name: F.col(name).cast("string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    nodes = orders.select(text("o_orderkey").alias("node_id"), text("o_custkey").alias("file_id"), "o_orderstatus")
    edges = table(spark, sf_dir, "lineitem").join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat_ws(":", text("l_orderkey"), text("l_linenumber")).alias("edge_id"), text("o_custkey").alias("file_id"), "l_returnflag")
    documents = table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("_id"), text("c_custkey").alias("file_id"), ids.sha256(F.col("c_name")).alias("content_sha256"),
        F.col("c_custkey").alias("kafka_offset"), F.col("c_nationkey").alias("revision_seq"))
    report = checks.exact_state(
        nodes.filter("file_id = '7' and o_orderstatus in ('F', 'O')"), edges.filter("file_id = '7' and l_returnflag in ('A', 'N')"),
        nodes.filter("o_orderstatus in ('O', 'P')"), edges.filter("l_returnflag in ('N', 'R')"), documents, "7", "none", 1500, 5, 100)
    return report.withColumn("mismatches", F.array_join("mismatches", "; "))


_DOCUMENTS_SQL = """
    select '/of/k' as pointer, json_extract_string(props, '$.k') as value from e
    union select '/users/0', user_id::varchar from e union select '/users/1', '"' || event_type[1] || '"' from e
    union select '/last~1digits', (event_id % 1000)::varchar from e"""


@query(f"""
    with l as (with e as (select * from events where event_type = 'signup') {_DOCUMENTS_SQL}),
    r as (with e as (select * from events where event_type = 'purchase') {_DOCUMENTS_SQL})
    select pointer, value, 'left' as side from (select * from l except select * from r)
    union all select pointer, value, 'right' from (select * from r except select * from l)""")
def schema_equal(spark, sf_dir):
    """What the documents of signups say and those of purchases do not, and the other way round; their ids aside."""
    events = table(spark, sf_dir, "events")
    text = F.format_string(
        '{"$id": %d, "users": [%d, "%s"], "of": %s, "last/digits": %d}', F.col("event_id"), F.col("user_id"),
        F.substring("event_type", 1, 1), F.col("props"), F.col("event_id") % 1000)
    of = lambda kind: events.filter(F.col("event_type") == kind).select(text.alias("document"))
    return documents.document_differences(of("signup"), of("purchase"), "document")
