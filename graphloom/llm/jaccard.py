"""N-gram Jaccard join: MinHash candidates pruned by their posterior, the rest verified exactly.

1. Each text becomes the set of hashes of its word shingles, a 128-bit digest of that set and a MinHash signature.
   Equal sets are one node from here on, so copies cost one row each.
2. Nodes that share a band of their signatures are candidates. Within a bucket, signatures are compared a few values at
   a time, and a pair is dropped as soon as the posterior probability (uniform prior) that its similarity reaches the
   threshold falls below the tolerance. What survives is kept as a spanning forest, whose components are clusters.
3. Within a cluster all pairs are verified on the shingle sets. Each node gets its number of links, and the links'
   spanning forest gives the classes.

Buckets and clusters of any size are cut into blocks, and each task compares two blocks, so a group with most of the rows
is spread over many tasks and no task or row list grows with its square. Buckets with the same members, as the bands
of one group of near copies mostly are, are compared once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from graphloom.llm import words as W
from graphloom.llm.common import ambiguous, materialise, numbered
from graphloom.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
TOLERANCE = 1e-6
STEP = 16
BLOCK_NODES = 512
BLOCK_SHINGLES = 500_000
_PAIRS = 100_000
_COLUMNS = 4096

_FACTORS = W.mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(part: W.Slice, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): distinct shingle hashes of all rows in order, and where each row's begin and end.

    A text with fewer words than a shingle has one shingle of all its words; one without words has none.
    """
    low = W.LOWER[part.data]
    found = W.words(low, part.offsets, W.ALNUM)
    counts = np.diff(found.rows)
    hashes = W.span_hashes(low, found.starts, found.ends)
    inside = W.within_rows(found.rows, length)
    values = [W.window_hashes(hashes, length)[inside]]
    rows = [np.repeat(np.arange(len(counts)), counts)[:len(inside)][inside]]
    for short in range(1, length):
        at = np.flatnonzero(counts == short)
        values.append(W.window_hashes(hashes, short)[found.rows[at]] if len(at) else np.empty(0, np.uint64))
        rows.append(at)
    value, row = np.concatenate(values), np.concatenate(rows)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(counts) + 1))


def digests(value: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit digest of each row's set."""
    total = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(W.mix(value ^ np.uint64(salt)), out=total[1:])
    return W.mix(total[ends[1:]] - total[ends[:-1]] + np.diff(ends).astype(np.uint64)).view(np.int64)


def signatures(value: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least hash of each row under each of the hash functions; rows without shingles are left out."""
    starts = ends[:-1][np.diff(ends) > 0]
    out = np.empty((len(starts), len(_FACTORS)), np.uint32)
    # a stretch of rows at a time, so that the values stay in the processor's cache
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(starts, starts[at] + 32_768)))
        stop = starts[upto] if upto < len(starts) else len(value)
        here, where = value[starts[at]:stop], starts[at:upto] - starts[at]
        for k, factor in enumerate(_FACTORS):
            out[at:upto, k] = np.minimum.reduceat(here * factor, where) >> np.uint64(32)
        at = upto
    return out


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch.column(1)):
            value, ends = shingle_sets(part)
            size = np.diff(ends)
            rows = iter(signatures(value, ends))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[part.first:part.first + len(size)], pa.array(size, pa.int64()),
                 pa.array(digests(value, ends, 1)), pa.array(digests(value, ends, 2)),
                 pa.array([next(rows).tobytes() if n else None for n in size], pa.binary())],
                names=["doc_id", "n", "node", "check", "sig"])


def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of texts (column 0); keeps the wanted node (column 1) and the other columns."""
    for batch in batches:
        for part in W.slices(batch.column(0)):
            value, ends = shingle_sets(part)
            own = pa.array(digests(value, ends, 1))
            rest = batch.slice(part.first, len(ends) - 1)
            sets = pa.array([value[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            kept = pa.array(own.to_numpy() == rest.column(1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*rest.columns[1:], sets], names=[*rest.schema.names[1:], "sets"]).filter(kept)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, total: int = BANDS * BAND_ROWS,
                  step: int = STEP) -> list[int]:
    """After each step, the fewest equal values with which a pair can still reach the threshold."""
    x = (np.arange(100_000) + 0.5) / 100_000
    least = []
    for n in range(step, total + 1, step):
        for m in range(n + 1):
            log = m * np.log(x) + (n - m) * np.log1p(-x)
            p = np.exp(log - log.max())
            if p[x >= threshold].sum() >= tolerance * p.sum():
                break
        least.append(m)
    return least


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each index' component."""
    label = np.arange(count)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of a stream that is sorted by its first ``keys`` columns, many at a time, with their starts."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        starts = _starts(table, keys)
        if len(starts) > 1:
            last = int(starts[-1])
            yield table.slice(0, last), starts[:-1]
            held = table.slice(last).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, _starts(table, keys)


def _starts(table: pa.Table, keys: int) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in range(keys):
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def pairs(starts: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All i < j of one group, of all groups."""
    ends = np.append(starts[1:], count)
    partners = np.repeat(ends, ends - starts) - np.arange(count) - 1
    i = np.repeat(np.arange(count), partners)
    first = np.cumsum(partners) - partners
    return i, np.arange(len(i)) - first[i] + i + 1


def pruned(least: list[int], step: int) -> Callable:
    """Function from sorted candidate rows (bucket, lo, hi, block, node, sig) to the forest of surviving pairs."""
    def survive(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        same = np.zeros(len(i), np.int64)
        for k, enough in enumerate(least):
            part = slice(k * step, (k + 1) * step)
            same += (sig[i, part] == sig[j, part]).sum(axis=1)
            on = same >= enough
            i, j, same = i[on], j[on], same[on]
        return i, j

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches, 3):
            lo, hi, block, node = (table.column(c).to_numpy() for c in (1, 2, 3, 4))
            sig = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint32).reshape(len(node), -1)
            ends = np.append(starts[1:], len(node))
            at = 0
            while at < len(starts):
                # groups with about _PAIRS pairs in all; the largest group has twice BLOCK_NODES rows
                sizes = ends[at:] - starts[at:]
                upto = at + max(1, int(np.searchsorted(np.cumsum(sizes * (sizes - 1) // 2), _PAIRS)))
                a, b = int(starts[at]), int(ends[upto - 1])
                found = []
                i, j = pairs(starts[at:upto] - a, b - a)
                i, j = i + a, j + a
                if (lo[a:b] != hi[a:b]).any():
                    cross = (lo[i] == hi[i]) | (block[i] != block[j])
                    i, j = i[cross], j[cross]
                for k in range(0, len(i), _PAIRS):
                    found.append(survive(sig, i[k:k + _PAIRS], j[k:k + _PAIRS]))
                i, j = (np.concatenate(x) - a if x else np.empty(0, np.int64) for x in zip(*found, strict=True)) if found else ([], [])
                label = forest(b - a, i, j)
                moved = np.flatnonzero(label != np.arange(b - a))
                yield pa.RecordBatch.from_arrays([pa.array(node[a + moved]), pa.array(node[a + label[moved]])], names=["a", "b"])
                at = upto

    return compare


def verified(threshold: Fraction) -> Callable:
    """Function from sorted cluster rows (root, lo, hi, block, node, copies, sets) to (node, links, to)."""
    def shared(sets: list[np.ndarray]) -> np.ndarray:
        """Sizes of all intersections."""
        values = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        values, row = values[order], row[order]
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        code = np.cumsum(new) - 1
        common = np.bincount(code)[code] > 1
        code, row = code[common], row[common]
        total = np.zeros((len(sets), len(sets)), np.float32)
        if len(code):
            new = np.ones(len(code), bool)
            new[1:] = code[1:] != code[:-1]
            code = np.cumsum(new) - 1
            for first in range(0, int(code[-1]) + 1, _COLUMNS):
                a, b = np.searchsorted(code, (first, first + _COLUMNS))
                held = np.zeros((len(sets), min(_COLUMNS, int(code[-1]) + 1 - first)), np.float32)
                held[row[a:b], code[a:b] - first] = 1
                total += held @ held.T
        return total.astype(np.int64)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches, 3):
            lo, hi, block, node, copies = (table.column(c).to_numpy() for c in (1, 2, 3, 4, 5))
            held = table.column(6)
            nodes, links, to = [], [], []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=True):
                # repeated rows of the table give a node twice
                rows = a + np.flatnonzero(np.diff(node[a:b], prepend=node[a] - 1 if node[a] > -2**62 else node[a] + 1) != 0)
                if len(rows) < 2:
                    continue
                sets = [np.frombuffer(held[int(r)].as_py(), np.uint64) for r in rows]
                size = np.array([len(s) for s in sets])
                both = shared(sets)
                linked = both * threshold.denominator >= threshold.numerator * (size[:, None] + size[None, :] - both)
                np.fill_diagonal(linked, False)
                if lo[a] != hi[a]:
                    linked &= block[rows][:, None] != block[rows][None, :]
                label = forest(len(rows), *np.nonzero(np.triu(linked)))
                nodes.append(node[rows])
                links.append(linked @ copies[rows])
                to.append(node[rows][label])
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (nodes, links, to)], names=["node", "links", "to"])

    return verify


def in_blocks(rows: DataFrame, keys: list[str], blocks: Column, node: str) -> DataFrame:
    """Each row once for every block that its own is compared with; sorted by group within partitions."""
    own = F.pmod(F.xxhash64(F.col(node), F.lit("block")), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    spread = (rows.withColumn("blocks", blocks).withColumn("block", own).withColumn("other", other)
              .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))
    key = [*keys, "lo", "hi"]
    return spread.repartition(*key).sortWithinPartitions(*key, node)


def links(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) per document row.

    ``n_links`` counts the other rows whose word sets have a similarity of ``threshold`` or more; ``class_id`` is the
    least id of the rows that links join, ``n_copies`` the number of rows with the same set. Words are runs of
    letters, digits and characters outside ASCII, in small letters. Null texts and texts without words have no
    links and are classes of their own. Rows that repeat an id are rows of their own; a class of rows without an
    id has none; an empty table gives an empty result. Other columns are ignored.
    """
    kind = dict(documents.dtypes)[doc_id]
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = materialise(rows.mapInArrow(sketch, f"doc_id {kind}, n long, node long, check long, sig binary"), "sketches")
    nodes = materialise(sketches.where("n > 0").groupBy("node", "check", "n", "sig")
                        .agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies")), "nodes")

    width = BAND_ROWS * 4
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda k: F.xxhash64(k, F.substring("sig", k * width + 1, F.lit(width))))
    placed = nodes.select("node", F.explode(band).alias("bucket"))
    buckets = (placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
        .where("size > 1").groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket")))
    # both sides of these joins grow with the input, so none is broadcast, however small it is today
    candidates = (placed.join(buckets.select("bucket", "size").hint("merge"), "bucket")
                  .join(nodes.select("node", "sig").hint("merge"), "node"))
    compared = in_blocks(candidates, ["bucket"], F.ceil(F.col("size") / BLOCK_NODES), "node").select(
        "bucket", "lo", "hi", "block", "node", "sig")
    near = compared.mapInArrow(pruned(least_matches(threshold), STEP), "a long, b long")
    clusters = materialise(components(near, "a", "b").join(
        nodes.select("node", "n", "least_id", "copies"), "node"), "clusters")

    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_NODES, F.col("total") / BLOCK_SHINGLES))
    wanted = clusters.join(sizes, "root").hint("merge")
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["least_id"])).select(
        "text", "node", "root", "copies", "size", "total")
    sets = texts.mapInArrow(shingled, "node long, root long, copies long, size long, total long, sets binary")
    found = materialise(in_blocks(sets, ["root"], blocks, "node").select(
        "root", "lo", "hi", "block", "node", "copies", "sets",
    ).mapInArrow(verified(Fraction(str(threshold))), "node long, links long, to long"), "links")
    classes = components(found.where("node <> to"), "node", "to")
    least = (classes.join(nodes.select("node", "least_id"), "node").groupBy("root")
             .agg(F.min("least_id").alias("class_id")))
    by_node = (nodes.select("node", "least_id", "copies")
               .join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
               .join(classes.join(least, "root").select("node", "class_id"), "node", "left")
               .select("node", "copies", F.coalesce("class_id", "least_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links")))
    known = sketches.select("doc_id", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(by_node, "node", "left")
    return known.select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"))


def one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Exactly one row of each class: one with the least id, or one without an id if the class has no id."""
    if ambiguous(documents, doc_id):
        rows = numbered(documents, "__row")
        found = links(rows, "__row", text, threshold).select(F.col("doc_id").alias("__row"), "class_id")
        kept = (rows.select("__row", F.col(doc_id).alias("__id")).join(found, "__row").groupBy("class_id")
                .agg(F.min(F.struct(F.col("__id").isNull(), "__id", "__row")).alias("least")).select("least.__row"))
        return rows.join(kept, "__row", "left_semi").select(documents.columns)
    found = links(documents, doc_id, text, threshold)
    dropped = found.where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias(doc_id)).distinct()
    return documents.join(dropped, doc_id, "left_anti").select(documents.columns)
