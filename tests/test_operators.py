"""Operators on small tables against plain Python, with very uneven groups."""

import json
import random

import pytest
from pyspark.sql import functions as F

from graphloom import contract as C
from graphloom.functions.rules import with_violations
from graphloom.operators import changes, checks, feed, graph, names, sequence


@pytest.fixture(scope="module")
def uneven():
    """Rows (group, position, value): one group has a third of all rows."""
    rng = random.Random(7)
    rows = []
    for position in range(3000):
        group = 0 if rng.random() < 0.34 else rng.randrange(1, 60)
        rows.append((group, position, rng.randrange(1000) if rng.random() < 0.2 else None))
    return rows


@pytest.mark.parametrize("chunk", [None, 1, 7, 500, 10_000])
def test_asof_last(spark, uneven, chunk):
    expected, last = {}, {}
    for group, position, value in uneven:
        expected[position] = last.get(group)
        if value is not None:
            last[group] = value
    df = spark.createDataFrame(uneven, "g int, p long, v int")
    column = None if chunk is None else F.floor(F.col("p") / chunk)
    got = sequence.asof_last(df, ["g"], ["p"], F.col("v"), "last", column).collect()
    assert {r.p: r["last"] for r in got} == expected and len(got) == len(uneven)


def test_latest_and_first(spark, uneven):
    df = spark.createDataFrame(uneven, "g int, p long, v int")
    latest = {r.g: (r.p, r.v) for r in sequence.latest_by_key(df, ["g"], ["p"]).collect()}
    first = {r.g: (r.p, r.v) for r in sequence.first_by_group(df, ["g"], ["p"]).collect()}
    for group in {g for g, _, _ in uneven}:
        mine = [(p, v) for g, p, v in uneven if g == group]
        assert latest[group] == mine[-1] and first[group] == mine[0]


def test_inherited_follow(spark):
    # block 0: a b; b owns block 1: c d; d is a loop that owns block 2: e; e owns block 3: f
    rows = [("a", 0, 0, [], None), ("b", 0, 1, [], None), ("c", 1, 0, ["b"], None), ("d", 1, 1, ["b"], None),
            ("e", 2, 0, [], "d"), ("f", 3, 0, ["e"], "d"), ("g", 4, 0, ["a"], None), ("h", 5, 0, ["d", "b"], None)]
    df = spark.createDataFrame(
        [(1, *r) for r in rows], "k int, pos string, block int, i int, owners array<string>, loop string")
    got = sequence.inherited_follow(df, ["k"], "pos", ["block"], "i", "owners", "loop")
    assert {r.pos: r.follow for r in got.collect()} == {
        "a": "b", "b": None, "c": "d", "d": None, "e": "d", "f": "d", "g": "b", "h": None}


def test_last_values_stay_in_their_group(spark):
    """One window over many groups gives what one window a group gives."""
    rng = random.Random(4)
    rows = [(rng.randint(0, 2), rng.randint(0, 3), rng.choice("ab"), i, rng.choice([None, None, i]), rng.choice([None, "x", "y"])) for i in range(400)]
    df = spark.createDataFrame(rows, "file int, scope int, name string, seq int, a int, b string").repartition(3)
    got = sequence.asof_within(df, ["file"], ["scope", "name"], ["seq"], [(F.col("a"), "last_a"), (F.col("b"), "last_b")])
    key = ["file", "scope", "name"]
    expected = sequence.asof_last(sequence.asof_last(df, key, ["seq"], F.col("a"), "last_a"), key, ["seq"], F.col("b"), "last_b")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())) and got.count() == 400


def test_nearest_in_chain_stops_at_a_local_name(spark):
    probes = spark.createDataFrame(
        [(1, "s1", "x", 0), (1, "s0", "x", 1), (2, "s2", "x", 0), (2, "s0", "x", 1), (3, "s9", "y", 0)],
        "call int, scope string, name string, level int")
    facts = spark.createDataFrame([("s1", "x", None), ("s0", "x", "f")], "scope string, name string, fn string")
    got = names.nearest_in_chain(probes, facts, ["call"], ["scope", "name"], "level", "fn", "target")
    assert {r.call: r.target for r in got.collect()} == {1: None, 2: "f", 3: None}


def test_dedupe_edges(spark):
    df = spark.createDataFrame(
        [("1", "AST", "a", "b"), ("1", "AST", "a", "b"), ("2", "CFG", "a", "a"), ("3", "CALL", "", "b")],
        "edge_id string, edge_type string, source_id string, target_id string")
    assert [r.edge_id for r in graph.dedupe_edges(df).collect()] == ["1"]
    bad = spark.createDataFrame([("1", "OTHER", "a", "b")], df.schema)
    with pytest.raises(Exception, match="no such edge type"):
        graph.dedupe_edges(bad).collect()


def test_feed_guards(spark):
    df = spark.createDataFrame(
        [("r", "f", "p", "h", "")], "repository string, file_id string, path string, content_sha256 string, node_id string")
    with pytest.raises(ValueError):
        feed.events(df, "nodes", C.NODE_DELETE, F.lit("t"), F.lit(""))
    with pytest.raises(Exception, match="without a key"):
        feed.events(df, "node", C.NODE_DELETE, F.lit("t"), F.lit("")).collect()


def test_retention_and_reports(spark):
    df = spark.sql("select * from values (timestamp'2026-01-01', 1), (timestamp'2026-01-08', 2) as t(ts, n)")
    kept = changes.retain(df, "ts", F.lit("2026-01-08 12:00:00").cast("timestamp")).collect()
    assert [r.n for r in kept] == [2]
    nodes = spark.createDataFrame(
        [("f", "1", "t1"), ("f", "2", "t1"), ("f", "3", "t2"), ("g", "4", "t9")],
        "file_id string, node_id string, event_time string")
    assert [tuple(r) for r in checks.times_of_file(nodes, "f").collect()] == [("t2", 1), ("t1", 2)]
    assert tuple(checks.file_counts(nodes, nodes.filter("node_id = '1'"), "f").first()) == (3, 1)
    documents = spark.createDataFrame([("f", "f"), ("g", "f")], "_id string, file_id string")
    assert tuple(checks.singleton(documents, "f").first()) == (1, 2)
    assert {(r._id, r.count_by_file_id) for r in checks.singletons(documents).collect()} == {("f", 2), ("g", 0)}


def test_walks(spark):
    edges = spark.createDataFrame(
        [("a", "b", "1"), ("b", "a", "2"), ("b", "c", "3"), ("c", "a", "4")], "s string, t string, id string")
    start = spark.createDataFrame([("a",)], "node string")
    got = [(r.edge_1, r.edge_2, r.end) for r in checks.walks(edges, start, "s", "t", "id").collect()]
    assert got == [("1", None, "b"), ("1", "2", "a"), ("1", "3", "c")]
    assert checks.walks(edges, start, "s", "t", "id", 2).count() == 2


GOOD_NODE = {
    "schema_version": "1.0.0", "event_type": "NODE_UPSERT", "event_time": "2026-07-24T00:00:00+00:00",
    "repository": "r", "file_id": "a" * 64, "path": "a.py", "content_sha256": "", "node_id": "b" * 64,
    "structural_path": "root.body[0]", "node_type": "FunctionDef", "label": "FunctionDef:answer", "lineno": 1,
    "col_offset": 0, "end_lineno": 2, "end_col_offset": 13, "code": "", "properties": {"name": "answer", "args": []},
}


@pytest.mark.parametrize("change, expected", [
    ({}, []),
    ({"lineno": 1.0}, []),
    ({"event_time": "2026-07-24T00:00:00.123Z"}, []),
    ({"event_time": "2026-07-24 00:00:00"}, ["format:event_time"]),
    ({"event_time": 5}, ["type:event_time"]),
    ({"schema_version": "1.0.1"}, ["const:schema_version"]),
    ({"event_type": "node"}, ["enum:event_type"]),
    ({"file_id": "A" * 64}, ["pattern:file_id"]),
    ({"content_sha256": "abc"}, ["pattern:content_sha256"]),
    ({"path": ""}, ["minLength:path"]),
    ({"lineno": -1}, ["minimum:lineno"]),
    ({"lineno": 1.5}, ["type:lineno"]),
    ({"lineno": "1"}, ["type:lineno"]),
    ({"lineno": True}, ["type:lineno"]),
    ({"code": None}, ["type:code"]),
    ({"properties": []}, ["type:properties"]),
    ({"file_path": "x"}, ["additionalProperties:file_path"]),
    ({"label": ...}, ["required:label"]),
    ({"event_type": "NODE_DELETE", "label": ..., "code": ...}, []),
    ({"node_id": ..., "path": ...}, ["required:node_id", "required:path"]),
])
def test_contract_rules(spark, change, expected):
    event = {k: v for k, v in {**GOOD_NODE, **change}.items() if v is not ...}
    df = spark.createDataFrame([(json.dumps(event),)], "value string")
    assert with_violations(df, "node").first().violations == expected


def test_contract_rules_on_other_texts(spark):
    df = spark.createDataFrame([("[]",), ("{",), ("5",)], "value string")
    assert [r.violations for r in with_violations(df, "edge").collect()] == [["type:$"]] * 3


def test_golden_gate(spark):
    expected = spark.createDataFrame(
        [("a", "n", 1), ("a", "m", 2), ("b", "n", 3)], "report string, name string, value int")
    measured = spark.createDataFrame([("a", "n", 1), ("a", "m", 9)], expected.schema)
    rows = checks.golden_gate(measured, expected).collect()
    assert {(r.report, r.name, r.expected, r.actual) for r in rows} == {("a", "m", 2, 9), ("b", "n", 3, None)}
