import json

import pytest
from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.functions import ids
from graphloom.functions.rules import with_violations
from graphloom.operators import checks
from graphloom.operators.feed import change_feed, run_summary
from graphloom.plans import state
from graphloom.plans.extract import extract, select_file
from graphloom.plans.pipeline import Locations, drain, run_batch
from graphloom.sources import logs
from graphloom.streaming import sinks
from tests.fixtures import SOURCES

MARKER = "\n\ndef twice(number):\n    doubled = number + number\n    return doubled\n"
CORPUS = {path: SOURCES[path][0] for path in ("pair.py", "shop.py", "counters.py", "package/__init__.py")}


def counts(feed):
    return {(r.event_type): r.n for r in feed.groupBy("event_type").agg(F.count("*").alias("n")).collect()}


def test_revision_diff_and_order(spark, files_of, tmp_path):
    at = Locations(str(tmp_path))
    run_batch(spark, files_of({"fixture.py": "width = 3\nheight = width\n", "other.py": "a = 1\n"}), at, 1)
    extraction, feed = run_batch(spark, files_of({"fixture.py": "width = 3\n"}), at, 2)
    assert counts(feed) == {
        C.EDGE_DELETE: 7, C.NODE_DELETE: 5, C.NODE_UPSERT: 5, C.EDGE_UPSERT: 4,
        C.FILE_METADATA_UPSERT: 1}
    records = feed.orderBy("op_rank", "ord").collect()
    kinds = [json.loads(r.value)["event_type"] for r in records]
    assert kinds == sorted(kinds, key=[
        C.EDGE_DELETE, C.NODE_DELETE, C.NODE_UPSERT, C.EDGE_UPSERT, C.FILE_METADATA_UPSERT].index)
    events = [json.loads(r.value) for r in records]
    deleted = [e["edge_id"] for e in events if e["event_type"] == C.EDGE_DELETE]
    assert deleted == sorted(deleted)
    # the log keeps that order for each key
    logged = spark.read.parquet(at.log).filter("revision_seq = 2")
    assert logged.count() == len(records)
    by_key = {}
    for r in logged.orderBy("offset").collect():
        by_key.setdefault(r.key, []).append(json.loads(r.value)["event_type"])
    assert {k: [json.loads(r.value)["event_type"] for r in records if r.key == k] for k in by_key} == by_key

    # publishing it again with fewer topics leaves none of the others behind
    logs.publish(feed.filter("category = 'node'"), str(tmp_path / "again"), 1)
    logs.publish(feed.filter("category = 'edge'"), str(tmp_path / "again"), 1)
    assert {r.topic for r in spark.read.parquet(str(tmp_path / "again")).select("topic").collect()} == {"cpg.edges"}
    sha = extraction.files.first().content_sha256
    assert {e["content_sha256"] for e in events} == {sha}           # deletes carry the new hash
    assert len({e["event_time"] for e in events}) == 1
    assert all("properties" not in e for e in events if e["event_type"].endswith("DELETE"))

    # a failed revision gives an error and zero counts, and deletes nothing
    _, feed = run_batch(spark, files_of({"fixture.py": "if ready go\n"}), at, 3)
    assert counts(feed) == {C.PARSER_ERROR: 1, C.FILE_METADATA_UPSERT: 1}
    metadata = json.loads(feed.filter("category = 'metadata'").first().value)
    assert metadata["status"] == "FAILED" and metadata["ast_node_count"] == 0
    assert metadata["line_count"] == 1 and metadata["size_bytes"] == 12

    # an unchanged file emits everything again, measured against the last good revision
    _, feed = run_batch(spark, files_of({"fixture.py": "width = 3\n"}), at, 4)
    assert counts(feed) == {C.NODE_UPSERT: 5, C.EDGE_UPSERT: 4, C.FILE_METADATA_UPSERT: 1}


def test_events_follow_the_contract(spark, files_of, tmp_path):
    at = Locations(str(tmp_path))
    sources = {"src/fixture.py": SOURCES["scale.py"][0], "gone.py": "width = 3\nheight = width\n", "bad.py": "if ready go\n"}
    run_batch(spark, files_of(sources), at, 1)
    _, feed = run_batch(spark, files_of({"gone.py": "width = 3\n"}), at, 2)
    log = spark.read.parquet(at.log)
    for category, topic in C.TOPICS.items():
        checked = with_violations(log.filter(F.col("topic") == topic), category)
        assert checked.count() > 0
        assert checked.filter(F.size("violations") > 0).count() == 0, category


def test_unreadable_file(spark):
    rows = [("r", "gone.py", None, "FileNotFoundError", "no such file")]
    extraction = extract(spark.createDataFrame(rows, C.FILES))
    error, metadata = extraction.errors.first(), extraction.metadata.first()
    assert (error.error_type, error.lineno, error.col_offset) == ("FileNotFoundError", 0, 0)
    assert metadata.size_bytes == 0 and metadata.line_count == 0 and metadata.status == "FAILED"
    assert metadata.content_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert extraction.nodes.count() == 0 and extraction.edges.count() == 0


@pytest.fixture(scope="module")
def deployment(spark, files_of, tmp_path_factory):
    at = Locations(str(tmp_path_factory.mktemp("deployment")))
    run_batch(spark, files_of(CORPUS), at, 1, partitions=3)
    drain(spark, at)
    return at


def state_of(spark, at):
    nodes, edges = sinks.graph_view(spark, at.table("node"), at.table("edge"))
    return nodes, edges, sinks.current_documents(spark, at.table("metadata"))


def snapshot(documents):
    return sorted(tuple(r) for r in documents.select(
        "_id", "content_sha256", "kafka_offset", "processed_at").collect())


def test_five_phase_replay(spark, files_of, deployment):
    at, path = deployment, "shop.py"
    original, modified = CORPUS[path], CORPUS[path] + MARKER
    counted = {}
    # 1 baseline, 2 unchanged replay, 3 modified, 5 restored
    for phase, (revision, text) in enumerate(
            [(1, original), (2, original), (3, modified), (5, original)], start=1):
        extraction = extract(select_file(files_of({path: text}), path))
        if revision > 1:
            run_batch(spark, files_of({path: text}), at, revision, partitions=3)
            drain(spark, at)
        file = extraction.files.first()
        nodes, edges, documents = state_of(spark, at)
        report = checks.exact_state(
            extraction.nodes, extraction.edges, nodes, edges, documents, file.file_id,
            file.content_sha256, len(CORPUS), minimum_revision=revision).first()
        assert report.status == "PASS", (phase, report.mismatches)
        total = checks.graph_snapshot(nodes, edges).first()
        assert total.placeholder_nodes == 0
        assert total.total_nodes == total.distinct_node_ids
        counted[phase] = (report.actual_node_count, report.actual_edge_count,
                          total.total_nodes, total.total_edges)
        if phase == 3:      # 4 restart without new input changes nothing
            before = snapshot(documents)
            drain(spark, at)
            again = state_of(spark, at)[2]
            assert snapshot(again) == before
            assert checks.snapshot_difference(
                documents, again, ["_id", "content_sha256", "kafka_offset", "processed_at"]
            ).first().snapshots_equal
    assert counted[1] == counted[2] == counted[4]
    assert [b - a for a, b in zip(counted[1], counted[3])] == [15, 20, 15, 20]
    nodes, edges, documents = state_of(spark, at)
    report = checks.verify_idempotency(nodes, edges, documents, extraction.files.first().file_id).first()
    assert report.status == "PASS", report.mismatches


def test_integrity_reports(spark, files_of, deployment):
    extraction = extract(files_of(CORPUS))
    report = checks.corpus_integrity(
        extraction.nodes, extraction.edges, extraction.metadata, extraction.errors, len(CORPUS)).first()
    assert report.status == "PASS" and report.node_events == 22 + 38 + 51 + 1
    report = checks.corpus_integrity(
        extraction.nodes.filter("node_type <> 'Name'"), extraction.edges, extraction.metadata,
        extraction.errors, len(CORPUS)).first()
    assert report.status == "FAIL" and report.missing_edge_targets > 0

    at = deployment
    documents = sinks.current_documents(spark, at.table("metadata"))
    manifest = extraction.files.select("file_id")
    assert checks.verify_documents(documents, manifest, len(CORPUS)).first().status == "PASS"
    short = checks.verify_documents(documents.filter("path <> 'pair.py'"), manifest, len(CORPUS)).first()
    assert "1 manifest files are missing" in short.mismatches

    expected = {"total_nodes": 112, "AST": 108, "placeholder_nodes": 0}
    good = checks.verify_graph(extraction.nodes, extraction.edges, expected).first()
    assert good.status == "PASS", good.mismatches
    bad = checks.verify_graph(extraction.nodes, extraction.edges, {"CFG": 0}).first()
    assert bad.status == "FAIL" and bad.mismatches == ["CFG edges: expected 0, got 13"]


def test_placeholders_and_detach(spark):
    def node(i, kind, seq):
        return (f"n{i}", "t" if kind == C.NODE_UPSERT else None, kind, seq, seq)

    def edge(i, a, b, seq):
        return (f"e{i}", f"n{a}", f"n{b}", C.EDGE_UPSERT, seq, seq)

    nodes = spark.createDataFrame(
        [node(1, C.NODE_UPSERT, 1), node(2, C.NODE_UPSERT, 1), node(2, C.NODE_DELETE, 2),
         node(3, C.NODE_UPSERT, 1), node(3, C.NODE_DELETE, 2), node(3, C.NODE_UPSERT, 3)],
        "node_id string, node_type string, event_type string, revision_seq long, offset long")
    edges = spark.createDataFrame(
        [edge(1, 1, 2, 1), edge(2, 1, 3, 1), edge(3, 1, 3, 3), edge(4, 1, 4, 1)],
        "edge_id string, source_id string, target_id string, event_type string, "
        "revision_seq long, offset long")
    kept = sinks.current_edges(edges, nodes)
    assert {r.edge_id for r in kept.collect()} == {"e3", "e4"}
    from graphloom.operators.changes import with_placeholders
    view = with_placeholders(sinks.current_nodes(nodes), kept, "node_id", "source_id", "target_id")
    assert {(r.node_id, r.node_type) for r in view.collect()} == {("n1", "t"), ("n3", "t"), ("n4", None)}


def metadata_event(sha, lines, **changes):
    event = {
        "schema_version": "1.0.0", "event_type": "FILE_METADATA_UPSERT",
        "event_time": "2026-07-24T00:00:00.123456+00:00", "repository": "r", "file_id": "f" * 64,
        "path": "a.py", "content_sha256": sha * 64, "language": "python", "size_bytes": 120,
        "line_count": lines, **{n: 1 for n in C.COUNT_FIELDS}, "status": "PARSED",
    }
    event.update(changes)
    return json.dumps(event)


def test_document_stream(spark, tmp_path):
    log, table, checkpoint = (str(tmp_path / n) for n in ("log", "table", "checkpoint"))

    def send(revision, *values):
        rows = [("f" * 64, v, C.TOPICS["metadata"], 0, revision * 100 + i, None, revision)
                for i, v in enumerate(values)]
        spark.createDataFrame(rows, C.ENVELOPE).write.mode("append").partitionBy(
            "topic", "revision_seq").parquet(log)

    def run(checkpoint=checkpoint):
        stream = logs.stream_log(spark, log, C.TOPICS["metadata"])
        sinks.start_documents(stream, table, checkpoint, None).awaitTermination()
        return sinks.current_documents(spark, table)

    send(1, metadata_event("a", 8), metadata_event("a", 8), "no json", None, "",
         metadata_event("c", 1, schema_version="2.0.0"), metadata_event("c", 1, event_type="OTHER"),
         metadata_event("c", 1, file_id=None))
    first = run().collect()
    assert len(first) == 1 and first[0].content_sha256 == "a" * 64 and first[0].kafka_offset == 101
    assert first[0]._id == first[0].file_id
    send(2, metadata_event("b", 12), metadata_event("b", 12, event_time="no time"))
    (document,) = run().collect()
    assert document.content_sha256 == "b" * 64 and document.kafka_offset == 201
    assert document.event_time_utc is None
    assert snapshot(run()) == snapshot(sinks.current_documents(spark, table))
    # a new checkpoint reads everything again and arrives at the same document
    before = snapshot(sinks.current_documents(spark, table))
    assert snapshot(run(str(tmp_path / "second"))) == before
    counted = sinks.rejected_count(logs.read_log(spark, log, C.TOPICS["metadata"]), "metadata").first()
    assert (counted.accepted, counted.rejected) == (4, 6)
    # compaction while the stream goes on: what is folded is left out, later batches count
    before = sinks.current_documents(spark, table).select("_id", "content_sha256", "kafka_offset").collect()
    sinks.compact_documents(spark, table)
    assert [(r.run_id, r.batch_id) for r in sinks.stored_batches(spark, table).select("run_id", "batch_id").collect()] == [("base-1", 0)]
    assert sinks.current_documents(spark, table).select("_id", "content_sha256", "kafka_offset").collect() == before
    send(3, metadata_event("d", 15))
    assert run().first().content_sha256 == "d" * 64
    assert sinks.stored_batches(spark, table).count() == 2
    sinks.compact_documents(spark, table)
    assert sinks.folded(spark, table).generation == 2 and sinks.stored_batches(spark, table).count() == 1
    assert run().first().content_sha256 == "d" * 64


def test_dump_round_trip_and_first_records(spark, files_of, tmp_path):
    extraction = extract(files_of({"a.py": "x = 1\n", "b.py": "if ready go\n"}))
    feed = change_feed(extraction)
    logs.write_dump(feed, str(tmp_path / "dump"))
    replayed = logs.replay_dumps(spark, str(tmp_path / "dump"), partitioned=True)
    assert {(r.category, r.key) for r in replayed.collect()} == {
        (r.category, r.key) for r in feed.collect()}
    with pytest.raises(ValueError):
        logs.replay_dumps(spark, str(tmp_path), ["nodes"])
    logs.publish(replayed, str(tmp_path / "log"), 1)
    records = logs.first_records(spark.read.parquet(str(tmp_path / "log"))).collect()
    assert {r.topic for r in records} == set(C.TOPICS.values())
    assert all(r.record[64:67] == " | " for r in records)
    edges = logs.read_events(spark, str(tmp_path / "dump" / "category=edge"), "edge")
    assert json.loads(edges.filter("edge_type = 'AST'").orderBy("edge_id").first().properties)["field"]
    assert logs.require_valid(edges).count() == 4


def test_run_summary(spark, files_of):
    from datetime import datetime, timezone

    extraction = extract(files_of({"a.py": SOURCES["shop.py"][0], "b.py": "if ready go\n"}))
    began = datetime(2026, 1, 1, tzinfo=timezone.utc)
    row = run_summary(change_feed(extraction), extraction, "r", began, began.replace(second=2), True).first()
    assert (row.total_files_targeted, row.processed_files, row.error_files) == (2, 1, 1)
    assert (row.total_nodes_emitted, row.total_edges_emitted) == (38, 48)
    assert tuple(row.cpg_breakdown) == (38, 37, 2, 5, 4)
    assert row.execution_duration_sec == 2.0 and row.executed_at == "2026-01-01T00:00:02.000000+00:00"


def test_error_stream_and_report(spark, files_of, tmp_path):
    at = Locations(str(tmp_path))
    old = F.lit("2020-01-01T00:00:00.000000+00:00")
    run_batch(spark, files_of({"a.py": "if ready go\n", "b.py": "x = 1\n"}), at, 1, event_time=old)
    run_batch(spark, files_of({"c.py": "x = = 1\n"}), at, 2)
    drain(spark, at)
    assert sinks.stored(spark, at.table("error")).count() == 2
    # retention goes by the time of the log record, not by the time that the event tells
    assert {r.path for r in sinks.recent_errors(spark, at.table("error")).collect()} == {"a.py", "c.py"}
    later = F.current_timestamp() + F.expr("interval 8 days")
    assert sinks.recent_errors(spark, at.table("error"), later).count() == 0
    nodes, edges, documents = state_of(spark, at)
    assert {(r.path, r.status) for r in documents.collect()} == {
        ("a.py", "FAILED"), ("b.py", "PARSED"), ("c.py", "FAILED")}
    checks.write_report(checks.verify_graph(nodes, edges, {"total_nodes": 5}), str(tmp_path / "report"))
    (report,) = spark.read.json(str(tmp_path / "report")).collect()
    assert report.status == "PASS" and report.total_edges == 4


def test_sample_events(spark, tmp_path):
    for number, sha in enumerate("ab"):
        event = json.loads(metadata_event(sha, 8 + number))
        (tmp_path / f"{number}.json").write_text(json.dumps(event, indent=2))
    samples = logs.sample_events(spark, str(tmp_path / "*.json"), "metadata")
    logs.publish(samples, str(tmp_path / "log"), 1)
    log = logs.read_log(spark, str(tmp_path / "log"), C.TOPICS["metadata"])
    assert {r.key for r in log.collect()} == {"f" * 64}
    assert {r.line_count for r in sinks.documents(log).collect()} == {8, 9}


def stored_ids(spark, files, at, revision):
    found = state.previous_state(spark, files.select(ids.file_id(F.col("repository"), F.col("path")).alias("file_id")), at.state, revision)
    return {name: sorted(map(tuple, rows.collect())) for name, rows in found.items()} if found else None


def test_a_small_batch_reads_and_writes_few_partitions(spark, files_of, tmp_path):
    """One file out of many: partition filters in the plan, other prefixes untouched, the rest of its prefix carried over."""
    at = Locations(str(tmp_path))
    corpus = {f"m{i}.py": f"x{i} = {i}\n" for i in range(40)}
    state.commit_state(extract(files_of(corpus)), at.state, 1, digits=1)
    before = stored_ids(spark, files_of(corpus), at, 2)
    assert len(before["files"]) == 40
    one = files_of({"m7.py": "y = 1\nz = y\n"})
    batch = extract(one)
    plan = state.previous_state(spark, batch.files, at.state, 2)["nodes"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "prefix" in plan.split("PartitionFilters: [")[1].split("]")[0]
    stamps = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet") if "commits" not in str(p)}
    state.commit_state(batch, at.state, 2)
    mine = batch.files.first().file_id[0]
    fresh = {p.parent.parent.name for p in tmp_path.rglob("*.parquet") if p not in stamps and "commits" not in str(p)}
    assert fresh == {f"prefix={mine}"} and all(p.stat().st_mtime_ns == t for p, t in stamps.items())
    after = stored_ids(spark, files_of(corpus), at, 3)
    own = {r.file_id for r in batch.files.collect()}
    for name in before:
        assert [r for r in after[name] if r[0] not in own] == [r for r in before[name] if r[0] not in own]
    assert {r[1] for r in after["nodes"] if r[0] in own} == {r.node_id for r in batch.nodes.collect()}


def test_state_of_stopped_and_repeated_batches(spark, files_of, tmp_path, monkeypatch):
    at = Locations(str(tmp_path))
    first, second = files_of({"a.py": "x = 1\n", "b.py": "y = x\n"}), files_of({"a.py": "", "c.py": "z = 1\n"})
    state.commit_state(extract(first), at.state, 1, digits=1)
    kept = stored_ids(spark, first, at, 2)
    edited = extract(second)
    # stopped before its commit: readers still see the first revision
    with monkeypatch.context() as broken:
        broken.setattr(type(spark), "createDataFrame", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.commit_state(edited, at.state, 2)
    assert stored_ids(spark, first, at, 2) == kept
    for _ in range(2):      # run again, and once more after it was committed
        state.commit_state(edited, at.state, 2)
        assert stored_ids(spark, first, at, 2) == kept
        now = stored_ids(spark, second, at, 3)
        assert len(now["nodes"]) == 1 + 5 and len(now["edges"]) == 4      # an empty file has no edges, and none are left of it
    state.commit_state(extract(first), at.state, 5)
    assert stored_ids(spark, first, at, 6) == kept
    with pytest.raises(ValueError, match="older than the stored state"):
        state.commit_state(edited, at.state, 2)
    # a failed file keeps its state, and so does a batch of nothing but failures
    state.commit_state(extract(files_of({"a.py": "if ready go\n"})), at.state, 6)
    assert stored_ids(spark, first, at, 7) == kept


def test_skipping_unchanged_files_publishes_the_same(spark, files_of, tmp_path):
    corpus = {path: SOURCES[path][0] for path in ("pair.py", "shop.py")}
    edited = {**corpus, "shop.py": corpus["shop.py"] + MARKER}
    time, feeds = F.lit("2026-01-01T00:00:00.000000+00:00"), []
    for skip in (False, True):
        at = Locations(str(tmp_path / str(skip)))
        run_batch(spark, files_of(edited), at, 1)
        feeds.append(sorted(map(tuple, run_batch(spark, files_of(corpus), at, 2, event_time=time, skip_unchanged=skip)[1].collect())))
    assert feeds[0] == feeds[1] and any(r[4] == C.NODE_DELETE for r in feeds[0])
