"""Divergence of sources from each other and from their language, by a frequent-pattern tree of term rows.

A term of a language is a row: the sources that have it, in order, each with its count. For two sources a and b of a
language the value is the sum of ``abs(p_a - p_b)`` over all kept terms, where p is a smoothed share in whole
billionths. Written with the share that a term without occurrences has in a source (``floor``), the sum falls apart:

* ``V * abs(floor_a - floor_b)`` for all V kept terms, as if no source had any,
* for each term of a: ``abs(p_a - floor_b) - abs(floor_a - floor_b)``, as if only a had it; likewise for b,
* for each term of both: ``abs(p_a - p_b) - abs(p_a - floor_b) - abs(floor_a - p_b) + abs(floor_a - floor_b)``.

The last part comes from the tree. Equal rows are one row with a multiplicity; a row is a path from the root, and rows
that begin alike share the nodes of that beginning. A node stands for all rows below it, so each pair of a node and one of
its ancestors gives its correction once, times the node's multiplicity. Rows are dealt by ranges of their first
cells, so that rows of one path meet in one task; a task's part of the tree is its sorted rows, where nodes are runs
of equal beginnings. A node whose rows lie in two tasks or batches is two nodes, which add up to the same sum.

The second part is worked out on histograms (source, share) -> number of terms. Occurrences are combined in each slice of
texts before they are sent, so neither a common term nor a large source is more than a few rows a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from graphloom.llm import words as W
from graphloom.llm.common import materialise

#: Letters and everything outside ASCII.
LETTERS = W.ALNUM & ~((np.arange(256) >= 48) & (np.arange(256) <= 57))
SLICE_BYTES = 2 << 20
#: Rows that are handed to Spark at a time.
SENT_ROWS = 1 << 15
SCALE = 1_000_000_000
PRIOR = 5
LEAST_DOCUMENTS = 30
TOP_TERMS = 50
#: Node-ancestor pairs that a task holds at a time.
PAIRS = 1 << 20

COUNTED = "lang string, source string, term string, n long, docs long"
_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
TREE = "lang string, a int, b int, value long"


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sum of the values of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(values[order], starts)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> occurrences and texts of each term of a slice; the empty term marks a group as present."""
    for batch in batches:
        for counted in _slice_terms(batch):
            for at in range(0, counted.num_rows, SENT_ROWS):
                yield counted.slice(at, SENT_ROWS)


def _slice_terms(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    names: dict[tuple[str, str], int] = {}
    pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
    of_row = np.fromiter((names.setdefault(p, len(names)) for p in pairs), np.int64, batch.num_rows)
    langs, sources = (pa.array([n[c] for n in names], pa.string()) for c in (0, 1))
    for part in W.slices(batch.column(2), SLICE_BYTES):
        low = W.LOWER[part.data]
        found = W.words(low, part.offsets, LETTERS)
        size = np.diff(found.rows)
        here = of_row[part.first:part.first + len(size)]
        ends = np.concatenate([[0], np.cumsum(found.ends - found.starts)])
        terms = pa.Array.from_buffers(pa.large_binary(), len(found.starts), [
            None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(low[LETTERS[low]])]).dictionary_encode()
        many = max(1, len(terms.dictionary))
        code = terms.indices.to_numpy().astype(np.int64)
        in_text, n = _sums(np.repeat(np.arange(len(size)), size) * many + code, np.ones(len(code), np.int64))
        key = here[in_text // many] * many + in_text % many
        cell, n = _sums(key, n)
        docs = _sums(key, np.ones(len(key), np.int64))[1]
        present = np.unique(here)
        group = pa.array(np.concatenate([cell // many, present]))
        spelled = pa.concat_arrays([terms.dictionary.take(pa.array(cell % many)), pa.array([b""] * len(present), pa.large_binary())])
        none = np.zeros(len(present), np.int64)
        yield pa.RecordBatch.from_arrays(
            [langs.take(group), sources.take(group), spelled.cast(pa.binary()).cast(pa.string()),
             pa.array(np.concatenate([n, none])), pa.array(np.concatenate([docs, none]))], schema=_COUNTED)


def share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * kept)) of three columns, in decimals that hold any count."""
    wide = "cast({} as decimal(20,0))".format
    return F.expr(f"1 + (({wide(n)} + {PRIOR}) * cast({SCALE} as decimal(10,0))) div ({wide(total)} + {PRIOR} * {wide(kept)})")


def tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (lang, row, many), where a row is its cells (no, n, p, floor) -> sums of corrections of pairs of sources."""
    for batch in batches:
        rows = batch.column(1)
        offsets = rows.offsets.to_numpy().astype(np.int64)
        no, n, p, floor = (rows.values.field(c).to_numpy() for c in ("no", "n", "p", "floor"))
        langs = batch.column(0).dictionary_encode()
        lang, many = langs.indices.to_numpy(), batch.column(2).to_numpy()
        begin, size = offsets[:-1], np.diff(offsets)
        common = np.zeros(len(size), np.int64)
        same = 1 + np.flatnonzero(lang[1:] == lang[:-1])
        while len(same):
            depth = int(common[same[0]])
            same = same[(size[same] > depth) & (size[same - 1] > depth)]
            x, y = begin[same] + depth, begin[same - 1] + depth
            same = same[(no[x] == no[y]) & (n[x] == n[y])]
            common[same] += 1
        width = int(no.max()) + 1 if len(no) else 1
        keys, values = [], []
        for depth in range(1, int(size.max()) if len(size) else 0):
            opens = np.flatnonzero((common <= depth) | (np.arange(len(size)) == 0))
            total = np.add.reduceat(many, opens)
            deep = size[opens] > depth
            opens, total = opens[deep], total[deep]
            for at in range(0, len(opens), max(1, PAIRS // depth)):
                node, weight = opens[at:at + max(1, PAIRS // depth)], total[at:at + max(1, PAIRS // depth)]
                own = np.repeat(begin[node] + depth, depth)
                above = (begin[node][:, None] + np.arange(depth)).ravel()
                value = np.abs(p[above] - p[own]) - np.abs(p[above] - floor[own]) - np.abs(floor[above] - p[own]) + np.abs(floor[above] - floor[own])
                k, v = _sums((np.repeat(lang[node].astype(np.int64), depth) * width + no[above]) * width + no[own], value * np.repeat(weight, depth))
                keys.append(k)
                values.append(v)
        if keys:
            key, value = _sums(np.concatenate(keys), np.concatenate(values))
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(key // width // width)), pa.array((key // width % width).astype(np.int32)),
                 pa.array((key % width).astype(np.int32)), pa.array(value)], names=["lang", "a", "b", "value"])


def divergence(documents: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
               least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source) of ``documents``.

    Terms are runs of letters (ASCII, made small) and characters outside ASCII. A language keeps the terms that at least
    ``least_documents`` of its rows have. Part ``pair``: how far each other source of the language is, over all kept
    terms. Part ``term``: the first ``top_terms`` terms whose share in the group is above their share in the language, by how much.
    Ranks are by falling value, then by item.

    Null texts, languages and sources count as empty ones; a group without terms is compared with N = 0; a language that
    keeps no term gives pairs of value 0. A row is a document, whether its id repeats or not; other columns are ignored. An
    empty table gives an empty result. Part ``pair`` has as many rows as a language has ordered pairs of sources, which
    is the result asked for; nothing else grows with the square of anything. Runs jobs: intermediate tables are written.
    """
    cell = F.struct("no", "n", "p", "floor")
    plain = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (lang, "lang"), (source, "source"), (text, "text"))])
    counts = materialise(plain.mapInArrow(count_terms, COUNTED).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    kept = materialise(
        counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents).drop("docs"), "kept")
    cells = materialise(counts.join(kept, ["lang", "term"]).drop("docs"), "cells")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    none = F.lit(0).cast("long")
    groups = counts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("v", "lang_n", "group_n")])
    groups = materialise(groups.withColumn("none", none).withColumns({
        "no": F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1,
        "floor": F.when(F.col("v") > 0, share("none", "group_n", "v")).otherwise(none)}).drop("none"), "groups")

    shares = cells.join(groups, ["lang", "source"]).withColumns(
        {"p": share("n", "group_n", "v"), "q": share("total", "lang_n", "v")})
    shares = materialise(shares.select("lang", "source", "term", "no", "n", "p", "q", "floor"), "shares")

    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    terms = above.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top_terms)

    rows = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(cell)).alias("row")).groupBy("lang", "row").agg(
        F.count(F.lit(1)).alias("many"))
    # ranges go by the first two cells, so that what Spark samples for them is short; rows that are alike so far may part
    start = [F.get("row", F.lit(i))[c] for i in (0, 1) for c in ("no", "n")]
    dealt = materialise(rows, "rows").repartitionByRange("lang", *start, F.xxhash64("row"))
    shared = dealt.sortWithinPartitions("lang", "row").mapInArrow(tree, TREE)
    alone = shares.groupBy("lang", "no", "p", "floor").agg(F.count(F.lit(1)).alias("m"))
    other = groups.select("lang", F.col("no").alias("b"), F.col("floor").alias("floor_b"))
    singles = alone.withColumnRenamed("no", "a").join(other, "lang").where("a <> b").select(
        "lang", "a", "b", F.expr("m * (abs(p - floor_b) - abs(floor - floor_b))").alias("value"))
    both = singles.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).unionByName(shared)
    ordered = both.unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    base = groups.withColumnRenamed("no", "a").join(other, "lang").where("a <> b").select(
        "lang", "a", "b", F.expr("v * abs(floor - floor_b)").alias("value"))
    summed = base.unionByName(ordered).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    named = lambda no, name: groups.select("lang", F.col("no").alias(no), F.col("source").alias(name))
    pairs = summed.join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(first)).unionByName(terms)
