"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Statistics are computed a column of texts at a time. Training takes a bounded sample of labelled rows to the driver,
where trees of depth ``DEPTH`` are grown level by level from histograms of binned statistics. A model is flat arrays
(statistic, threshold, children, leaf values), which all rows walk together in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from graphloom.llm import words as W

#: Bound of the training sample, in rows.
SAMPLE_ROWS = 20_000
BINS = 64
DEPTH = 4
TREES = 60
RATE = 0.2
LEAF_ROWS = 20
SHRINK = 1.0

STATISTICS = (
    "bytes", "words", "letters", "digits", "capitals", "symbols", "marks", "spaces", "other", "word_bytes",
    "distinct_words", "repeated_windows", "lines", "distinct_lines", "long_words", "lone_marks",
)
_B = np.arange(256)
_CLASSES = (
    W.ALNUM & ~((_B >= 48) & (_B <= 57)) & (_B != 96),                              # letters
    (_B >= 48) & (_B <= 57),                                                        # digits
    (_B >= 65) & (_B <= 90),                                                        # capitals
    np.isin(_B, list(b"#*$%&|<>@\\^~`{}[]=+_")),                                    # symbols
    np.isin(_B, list(b".,;:!?'\"()-/")),                                            # marks
    ~W.NONSPACE,                                                                    # spaces
    _B < 32,                                                                        # other
)


def _distinct(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Number of distinct values a row."""
    if not len(values):
        return np.zeros(count)
    order = np.lexsort((values, rows))
    r, v = rows[order], values[order]
    new = np.ones(len(v), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.bincount(r[new], minlength=count).astype(float)


def statistics(part: W.Slice) -> np.ndarray:
    """One row of STATISTICS for each text; an empty text has zeros."""
    data, offsets = part.data, part.offsets
    n, size = len(offsets) - 1, np.diff(offsets).astype(float)
    over = np.maximum(size, 1)
    shares = []
    for kind in _CLASSES:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind[data], out=total[1:])
        shares.append((total[offsets[1:]] - total[offsets[:-1]]) / over)
    found = W.words(data, offsets, W.NONSPACE)
    counts = np.diff(found.rows)
    many = np.maximum(counts, 1)
    rows = np.repeat(np.arange(n), counts)
    hashes = W.span_hashes(data, found.starts, found.ends)
    length = (found.ends - found.starts).astype(float)
    run = W.window_hashes(hashes, 3)
    inside = W.within_rows(found.rows, 3)
    windows = np.maximum(np.bincount(rows[:len(run)][inside], minlength=n), 1)
    repeated = 1 - _distinct(rows[:len(run)][inside], run[inside], n) / windows
    repeated[counts < 3] = 0
    breaks = np.ones(256, bool)
    breaks[10] = False
    lines = W.words(data, offsets, breaks)
    line_rows = np.repeat(np.arange(n), np.diff(lines.rows))
    n_lines = np.maximum(np.diff(lines.rows), 1)
    lone = (length <= 2) & ~W.ALNUM[data[found.starts]] if len(length) else np.empty(0, bool)
    return np.column_stack([
        np.log1p(size), np.log1p(counts), *shares, np.bincount(rows, length, n) / many,
        _distinct(rows, hashes, n) / many, repeated, np.log1p(np.diff(lines.rows)),
        _distinct(line_rows, W.span_hashes(data, lines.starts, lines.ends), n) / n_lines,
        np.bincount(rows, length > 14, n) / many, np.bincount(rows, lone, n) / many,
    ])


class Model(NamedTuple):
    base: float
    feature: np.ndarray         # trees x nodes; children of node i are 2i + 1 and 2i + 2
    threshold: np.ndarray
    value: np.ndarray           # of the leaves, trees x 2**depth


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Model:
    """Boosted trees for the logistic loss; without rows, or with one class only, a constant model."""
    n, width = x.shape
    p = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(p / (1 - p)))
    inner = 2 ** depth - 1
    feature = np.zeros((trees, inner), np.int32)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    if n == 0 or y.min() == y.max():
        return Model(base, feature, threshold, value)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    score = np.full(n, base)
    for t in range(trees):
        q = 1 / (1 + np.exp(-score))
        slope, bend = y - q, q * (1 - q)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, wide = 2 ** level - 1, 2 ** level
            gains = np.zeros((width, wide, BINS))
            for f in range(width):
                at = (node - first) * BINS + binned[:, f]
                g = np.bincount(at, slope, wide * BINS).reshape(wide, BINS).cumsum(1)
                h = np.bincount(at, bend, wide * BINS).reshape(wide, BINS).cumsum(1)
                c = np.bincount(at, minlength=wide * BINS).reshape(wide, BINS).cumsum(1)
                gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
                gain = g ** 2 / (h + SHRINK) + (gt - g) ** 2 / (ht - h + SHRINK) - gt ** 2 / (ht + SHRINK)
                gains[f] = np.where((c >= LEAF_ROWS) & (ct - c >= LEAF_ROWS), gain, 0)
            for k in range(wide):
                f, b = np.unravel_index(gains[:, k].argmax(), (width, BINS))
                if gains[f, k, b] > 1e-9 and b < len(edges[f]):
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        value[t] = rate * g / (h + SHRINK)
        score += value[t, leaf]
    return Model(base, feature, threshold, value)


def evaluate(model: Model, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row; all rows walk a tree one level at a time."""
    score, inner = np.full(len(x), model.base), model.feature.shape[1]
    every = np.arange(len(x))
    for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
        node = np.zeros(len(x), np.int64)
        while len(node) and node[0] < inner:
            node = 2 * node + 1 + (x[every, feature[node]] > threshold[node])
        score += value[node - inner]
    return 1 / (1 + np.exp(-score))


def fit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``sample_rows`` labelled rows, chosen by a hash of the id. Null labels are left out."""
    # more than a hash picks on average, so that the limit, taken in hash order, seldom binds
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("y"))
    total = known.count()
    if total > sample_rows:
        known = known.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(0.95 * sample_rows / total * (1 << 30)))
    # the sample is bounded by ``sample_rows``
    sample = documents.select(F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("text")).join(F.broadcast(known), "__id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch.column(0)):
                x = statistics(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), pa.list_(pa.float64())), batch.column(1)[part.first:part.first + len(x)],
                     batch.column(2)[part.first:part.first + len(x)]], names=["x", "y", "h"])

    rows = (sample.select("text", "y", F.xxhash64("__id").alias("h")).mapInArrow(describe, "x array<double>, y int, h long")
            .orderBy("h", "x").limit(sample_rows).collect())
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(STATISTICS))
    return train(x, np.array([r["y"] for r in rows], float))


def score(documents: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """All columns of ``documents`` with ``score`` (0 to 1), but for the text unless ``keep_text`` asks for it, which then
    comes back as it went in and as a last column before the score.

    Null texts are scored as empty ones, by the model. A column named score is replaced.
    """
    kept = [c for c in documents.columns if c not in (text, "score")]
    # bounded by the number of trees and their depth
    shared = documents.sparkSession.sparkContext.broadcast(tuple(model))
    shown = [*kept, text] if keep_text else kept

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Model(*shared.value)
        for batch in batches:
            # a batch of long texts is passed on in pieces, so that no copy of the whole batch is made
            for part in W.slices(batch.column(0)):
                rows = batch.slice(part.first, len(part.offsets) - 1)
                texts = [rows.column(0)] if keep_text else []
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[1:], *texts, pa.array(evaluate(trees, statistics(part)), pa.float64())], names=[*shown, "score"])

    asked = documents.select(F.col(text).cast("string").alias("__text"), *kept)
    types = {**{f.name: f.dataType for f in documents.schema}, text: T.StringType()}
    schema = T.StructType([*(T.StructField(c, types[c]) for c in shown), T.StructField("score", T.DoubleType())])
    return asked.mapInArrow(apply, schema)


def keep(documents: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """Documents with a score of at least ``least``, all of their columns unchanged."""
    names = documents.columns
    # the text goes to the workers once, and comes back from them
    plain = [f"c{i}" for i in range(len(names))]
    passed = documents.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(names, plain, strict=True)])
    scored = score(passed, model, plain[names.index(text)], keep_text=True)
    return scored.where(F.col("score") >= least).select(*[
        F.col(p).cast(documents.schema[c].dataType).alias(c) for c, p in zip(names, plain, strict=True)])
