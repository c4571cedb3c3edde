"""What keeps work small on large tables: how much is sent, shuffled or done by one task."""

import json
import os
import re

from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.functions import ids
from graphloom.llm import quality
from graphloom.operators import changes, feed, graph, names, sequence
from graphloom.plans import queries_changes, queries_graph
from graphloom.plans.extract import extract, linked_edges, metadata, resolved_places, syntax_rows
from graphloom.plans.pipeline import Locations, drain, run_batch
from graphloom.plans.state import commit_state, previous_state
from graphloom.session import materialise
from graphloom.sources import logs
from graphloom.streaming import sinks

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tree_rows_are_made_distinct_by_their_keys(spark):
    """Only numbers are grouped: no path and no id is a grouping key."""
    for query in (queries_graph.node_ids, queries_graph.tree_edges):
        grouped = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan(query(spark, SF_DIR)))
        names = {re.sub(r"#\d+L?", "", key).strip() for keys in grouped for key in keys.split(",") if key.strip()}
        assert names and all(name.split("_")[-1] in ("regionkey", "nationkey", "custkey", "orderkey", "linenumber") for name in names)


def test_texts_go_to_the_scoring_workers_once(spark):
    documents = spark.createDataFrame([(1, "one two", "en"), (2, None, None)], "doc_id long, text string, lang string")
    model = quality.fit(documents, spark.createDataFrame([], "doc_id long, quality int"))
    kept = quality.keep(documents, model, least=0.0)
    given = re.search(r"MapInArrow apply\(([^)]*)\)", plan(kept)).group(1).split(",")
    assert len(given) == len(documents.columns)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, documents.collect()), key=str)


def test_shape_of_a_file_has_only_the_rows_that_edges_are_found_from(spark, files_of):
    files = files_of({"a.py": "x = 1 + 2 * 3\n", "b.py": "", "c.py": "def broken(:\n"})
    whole, shape = syntax_rows(files, 2), syntax_rows(files, 2, texts=False)
    nodes = {r.file_id: r.n for r in whole.groupBy("file_id").agg(F.count("pos").alias("n")).collect()}
    counted = shape.filter("size_bytes is not null").select("file_id", F.coalesce("node_count", F.lit(0)).alias("n")).collect()
    assert {r.file_id: r.n for r in counted} == nodes and sorted(nodes.values()) == [0, 1, 11]
    assert shape.count() < whole.count()
    same = lambda flat: sorted(map(tuple, metadata(flat, resolved_places(flat)).collect()))
    assert same(shape) == same(whole)


def test_a_larger_log_has_more_files_and_as_many_batches(spark, monkeypatch):
    monkeypatch.setattr(queries_changes, "LOG_FILE_ROWS", 100)
    assert queries_changes._write_log(spark.range(1001), queries_changes._run_folder(spark)) == 3
    batches = queries_changes.stream_upsert(spark, SF_DIR).select("batches").distinct().collect()
    assert [r.batches for r in batches] == [queries_changes.LOG_FILES]


def test_sample_files_lie_in_one_folder_written_by_many_tasks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(queries_changes.logs, "sample_events", lambda spark, at, kind: seen.append(at) or real(spark, at, kind))
    assert queries_changes.sample_log(spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/supplier.parquet").count()
    at = seen[0].removesuffix("/*")
    names = [n for n in os.listdir(at) if n.startswith("part-") and os.path.getsize(f"{at}/{n}")]     # a first, empty one may lie beside
    assert len(names) == 10 and len({n.split("-")[1] for n in names}) > 1


real = queries_changes.logs.sample_events


def test_linked_edges_are_those_of_the_whole_extraction(spark, files_of):
    files = files_of({
        "a.py": "try:\n    f()()\n    a.b(c)[0]()\nexcept OSError as e:\n    print(e)\nfinally:\n    pass\nwith x as y:\n    y += (lambda z: z)(1)\n",
        "b.py": "def f(n=1):\n    global g\n    g = n\n    for i in g:\n        if i:\n            break\n    else:\n        f(i)\n    return g\nf(g)\n",
        "broken.py": "def (:\n", "empty.py": ""})
    columns = graph.EDGE_COLUMNS
    whole = extract(files).edges.filter("edge_type <> 'AST'").select(*columns).collect()
    assert sorted(linked_edges(files).select(*columns).collect()) == sorted(whole) and len(whole) > 20


def test_ids_of_edges_cost_one_exchange_and_no_broadcast(spark, files_of):
    flat = materialise(syntax_rows(files_of({"a.py": "a = 1\nprint(a)\n"})), "syntax")
    found = plan(graph.with_ids(resolved_places(flat), flat))
    assert found.count("Exchange hashpartitioning") == 1 and "Broadcast" not in found


NAMES = {
    "a.py": "def f(n=1):\n    global g\n    g = n\n    for i in g:\n        if i:\n            f(i)\n        else:\n            break\n    return g\nf(g)\ng += f\n",
    "b.py": "def f():\n    x = y = 1\n    def keep():\n        nonlocal x\n        x = y\n        return x\n    with y as z:\n        keep()(z)\n    return x\n",
    "c.py": "try:\n    a = f()\nexcept E as e:\n    print(e, a)\nfinally:\n    while a:\n        pass\n"}


def test_rows_of_a_file_are_dealt_out_once_for_each_kind_of_edge(spark, files_of):
    flat = materialise(syntax_rows(files_of(NAMES), texts=False), "syntax")
    facts = materialise(names.scope_facts(flat), "scopes")
    plain = names._reached(names._passed(names.name_uses(flat.filter(~names._odd())), facts.filter("not is_odd")))
    for df in (graph.follow_places(flat, bounded=True), names.call_places(flat, facts), plain):
        assert plan(df).count("Exchange hashpartitioning") == 1 and "Join" not in plan(df)


def test_successors_in_bounded_files_are_those_that_joins_find(spark, files_of):
    flat = materialise(syntax_rows(files_of(NAMES), texts=False), "syntax")
    rows = lambda df: sorted(map(tuple, df.collect()))
    found = rows(graph.follow_places(flat, bounded=True))
    assert found == rows(graph.follow_places(flat)) and len(found) > 10
    steps = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 1, 6), (1, 0, 3, 7), (1, 2, 4, 8), (2, 0, 0, 9)], "file int, block int, i int, pos int")
    stepped = sequence.next_in_block(steps, ["file", "block"], "i", {"pos": "next"}, within=["file"])
    assert {r.pos: r.next for r in stepped.collect()} == {5: 6, 6: None, 7: None, 8: None, 9: None}


def test_only_names_declared_nonlocal_take_the_general_way(spark, files_of):
    flat = materialise(syntax_rows(files_of(NAMES), texts=False), "syntax")
    assert {r.name for r in names.name_uses(flat.filter(names._odd())).select("name").collect()} == {"x"}
    assert {r.name for r in names.scope_facts(flat).filter("is_odd").collect()} == {"x"}


def test_the_id_of_a_node_is_made_once(spark, files_of):
    """One digest for the node and one for the edge, not one for each end of it."""
    flat = materialise(syntax_rows(files_of(NAMES), texts=False, paths=True), "syntax")
    assert plan(graph.with_ids(resolved_places(flat), flat)).count("sha2(") == 2


def test_a_batch_of_orders_is_not_broadcast(spark):
    assert "Broadcast" not in plan(queries_changes.run_summary(spark, SF_DIR))


def test_stored_state_is_not_broadcast(spark, files_of):
    extraction, at = extract(files_of({"a.py": "a = 1\n", "b.py": "b = 2\n"})), queries_changes._run_folder(spark)
    commit_state(extraction, at, 1)
    found = previous_state(spark, extraction.files.filter("path = 'a.py'"), at, 2)
    assert [r.path for r in found["nodes"].join(extraction.files, "file_id").select("path").distinct().collect()] == ["a.py"]
    assert not any("Broadcast" in plan(df) for df in found.values())


def test_recomputed_ids_are_dealt_out_by_file_once(spark):
    found = plan(queries_changes.recompute_compare(spark, SF_DIR))
    assert "Broadcast" not in found and "FullOuter" not in found


def test_stale_rows_are_found_with_one_exchange(spark):
    previous = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y"), ("b", "3", "z"), ("c", "4", "w")], "file_id string, node_id string, more string")
    current = spark.createDataFrame([("a", "2"), ("a", "3"), ("d", "4")], "file_id string, node_id string")
    files = spark.createDataFrame([("a", "pa"), ("c", "pc"), ("d", "pd")], "file_id string, path string")
    stale = feed.stale_in_files(previous, current, files, "node_id")
    assert sorted(map(tuple, stale.select("file_id", "node_id", "more", "path").collect())) == [("a", "1", "x", "pa"), ("c", "4", "w", "pc")]
    assert plan(stale).count("Exchange hashpartitioning") == 1 and "Join" not in plan(stale)


def test_dumps_are_packed(spark):
    at = queries_changes._run_folder(spark)
    logs.write_dump(queries_changes._order_revision(spark, SF_DIR), at)
    names = [n for _, _, found in os.walk(at) for n in found if n.startswith("part-")]
    assert names and all(n.endswith(".gz") for n in names)


def test_log_records_of_a_file_share_a_task_and_keep_their_order(spark):
    rows = [("node", f"{f}-{k}", "{}", f, f"o{rank}", rank, "0") for f in "abcdefgh" for k in range(20) for rank in (3, 0, 2)]
    df = spark.createDataFrame(rows, "category string, key string, value string, file_id string, event_type string, op_rank int, ord string")
    found = logs.log_records(df.withColumn("value", F.col("op_rank").cast("string")), 1, by_file=True).select("key", "offset", "value").collect()
    tasks, order = {}, {}
    for r in sorted(found, key=lambda r: r.offset):
        tasks.setdefault(r.key.split("-")[0], set()).add(r.offset >> 33)
        order.setdefault(r.key, []).append(r.value)
    assert len(found) == len(rows) and all(len(t) == 1 for t in tasks.values()) and all(v == ["0", "2", "3"] for v in order.values())


def test_packed_ids_are_the_same_ids(spark):
    texts = ["a" * 64, "0123456789abcdef" * 4, "A" * 64, "a" * 64 + "\n", "a" * 63, "x" * 32, "", "\x01" + "a" * 32, "é", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, id string")
    found = df.withColumn("p", ids.packed(F.col("id"))).select("n", F.octet_length("p").alias("size"), ids.unpacked(F.col("p")).alias("back")).orderBy("n").collect()
    assert [r.back for r in found] == texts and [r.size for r in found[:3]] == [33, 33, 65]


def test_the_graph_of_a_feed_is_found_with_one_exchange(spark):
    """Current, deleted and returned nodes, detached edges and unknown ends: as the general operators have it."""
    up, down = ("NODE_UPSERT", "EDGE_UPSERT"), ("NODE_DELETE", "EDGE_DELETE")
    node = lambda f, i, seq, kind=up: (f"f{f}", f"n{f}{i}", kind[0], seq, seq, seq)
    edge = lambda f, i, a, b, seq, kind=up: (f"f{f}", f"e{f}{i}", f"n{f}{a}", f"n{f}{b}", kind[1], seq, seq, seq)
    order = "revision_seq long, offset long, changed_at long"
    nodes = spark.createDataFrame(
        [node(f, 1, 1) for f in range(3)] + [node(f, 2, s, k) for f in range(2) for s, k in ((1, up), (2, down))]
        + [node(0, 3, s, k) for s, k in ((1, up), (2, down), (3, up))], f"file_id string, node_id string, event_type string, {order}")
    edges = spark.createDataFrame(
        [edge(0, 1, 1, 2, 1), edge(0, 2, 1, 3, 1), edge(0, 3, 1, 3, 3), edge(0, 4, 1, 4, 1), edge(0, 5, 4, 1, 2), edge(0, 6, 1, 2, 2),
         edge(1, 1, 1, 1, 1), edge(1, 1, 1, 1, 2, down), edge(1, 2, 1, 5, 1), edge(1, 2, 2, 1, 4)],
        f"file_id string, edge_id string, source_id string, target_id string, event_type string, {order}")
    kept = sinks.current_edges(edges, nodes)
    view = changes.with_placeholders(sinks.current_nodes(nodes), kept, "node_id", "source_id", "target_id")
    wanted = [(r.file_id, "node", r.node_id) for r in view.collect()] + [(r.file_id, "edge", r.edge_id) for r in kept.collect()]
    change = lambda df, own: df.withColumnRenamed(own, "own_id").withColumn("deleted", F.col("event_type").endswith("_DELETE")).drop("event_type")
    found = changes.graph_in_files(change(nodes, "node_id"), change(edges, "edge_id"), sinks.GRAPH_ORDER)
    assert plan(found).count("Exchange hashpartitioning") == 1 and "Join" not in plan(found)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(wanted, key=key)
    assert {r[2] for r in wanted if r[0] is None} == {"n04", "n02", "n12"} and ("f0", "edge", "e02") not in wanted


def test_a_batch_is_written_once_and_dealt_out_before_its_texts_are_made(spark, files_of, tmp_path, monkeypatch):
    """The feed is read from the log, and the log is written without a shuffle of event texts."""
    plans = []
    write = logs._write_revision
    monkeypatch.setattr(logs, "_write_revision", lambda records, *rest: (plans.append(plan(records)), write(records, *rest)))
    at = Locations(str(tmp_path))
    _, first = run_batch(spark, files_of({"a.py": "x = 1\ny = x\n", "b.py": "if ready go\n"}), at, 1)
    assert first.columns == list(feed.FEED_COLUMNS)
    _, second = run_batch(spark, files_of({"a.py": "x = 1\n"}), at, 2)
    for found in plans:
        below = []      # depths of the exchanges above a line
        for line in found.splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            below = [d for d in below if d < depth] + [depth] * ("Exchange" in line)
            assert not (below and "AS op_rank" in line)
        assert "AS op_rank" in found and "Exchange" in found
    found = {r.key: r for r in second.collect()}
    logged = spark.read.schema(C.ENVELOPE).parquet(at.log).filter("revision_seq = 2").collect()
    assert {(r.key, r.value) for r in logged} == {(r.key, r.value) for r in found.values()} and len(logged) == len(found)
    deleted = [r for r in found.values() if r.event_type == C.NODE_DELETE]
    assert deleted and all((r.ord, r.category, r.op_rank) == (r.key, "node", 1) for r in deleted)
    assert all(len(r.ord) == 20 for r in found.values() if r.event_type == C.NODE_UPSERT)
    assert first.count() == 10 + 11 + 1 + 2
    # what the sinks, the log and the state store is packed, too
    drain(spark, at)
    names = [os.path.join(d, n) for d, _, found in os.walk(tmp_path) for n in found if n.endswith(".parquet") and "commits" not in d]
    assert len(names) > 5 and all(".zstd." in n for n in names)
