"""Benchmark decontamination: word windows of test items found in training documents.

Test windows (normalised n-grams) become sorted arrays of 64-bit hashes that every task gets; documents are
scanned once. Each hit is verified on the words themselves, so a hash collision never counts. The broadcast
holds at most ``block_windows`` windows of ``block_bytes`` bytes: a larger benchmark is split into blocks of items, each block is one
more scan of the documents, and the hits of a document are united afterwards.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from graphloom.llm import words as W
from graphloom.llm.common import materialise

WINDOW = 10
BLOCK_WINDOWS = 2_000_000
BLOCK_BYTES = 64 << 20
_FILTER_BITS = 22

FOUND = "doc_id {id}, n_words long, hits binary, items array<string>, digest binary"


def test_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, length, words): each distinct window of each item; an item with fewer words is one window."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item_id"),
        F.filter(F.split(F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                         r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), lambda w: w != "").alias("w"))
    length = F.least(F.size("w"), F.lit(window))
    return (items.where(F.size("w") > 0)
            .select("item_id", length.alias("length"),
                    F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - length + 1),
                                          lambda i: F.array_join(F.slice("w", i, length), " "))).alias("words"))
            .distinct())


def scan(documents: DataFrame, windows: list, doc_id: str, text: str) -> DataFrame:
    """Hits of one block of windows: (doc_id, n_words, hits, items, digest). ``hits`` has one byte a word."""
    spark = documents.sparkSession
    by_length: dict[int, dict[bytes, list[str]]] = {}
    for item, length, phrase in windows:
        by_length.setdefault(length, {}).setdefault(phrase.encode(), []).append(item)
    kept = []
    for length, phrases in sorted(by_length.items()):
        joined = b" ".join(phrases)
        data = np.frombuffer(joined, np.uint8)
        found = W.words(data, np.array([0, len(data)]), W.ALNUM)
        hashes = W.window_hashes(W.span_hashes(data, found.starts, found.ends), length)[::length]
        coarse = np.zeros(1 << _FILTER_BITS, bool)
        coarse[hashes >> np.uint64(64 - _FILTER_BITS)] = True
        kept.append((length, np.sort(hashes), np.packbits(coarse), phrases))
    shared = spark.sparkContext.broadcast(kept)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = [(n, h, np.unpackbits(c).astype(bool), p) for n, h, c, p in shared.value]
        for batch in batches:
            counts, hits, items, digests = [], [], [], []
            for part in W.slices(batch.column(1)):
                low = W.LOWER[part.data]
                found = W.words(low, part.offsets, W.ALNUM)
                mark = np.zeros(len(found.starts), np.uint8)
                occurring: dict[int, set[str]] = {}
                hashes = W.span_hashes(low, found.starts, found.ends)
                for length, wanted, coarse, phrases in lengths:
                    run = W.window_hashes(hashes, length)
                    maybe = np.flatnonzero(coarse[run >> np.uint64(64 - _FILTER_BITS)])
                    maybe = maybe[W.within_rows(found.rows, length)[maybe]]
                    at = np.searchsorted(wanted, run[maybe])
                    maybe = maybe[wanted[np.minimum(at, len(wanted) - 1)] == run[maybe]]
                    rows = np.searchsorted(found.rows, maybe, "right") - 1
                    for i, row in zip(maybe.tolist(), rows.tolist(), strict=True):
                        phrase = b" ".join(low[found.starts[j]:found.ends[j]].tobytes() for j in range(i, i + length))
                        if phrase in phrases:
                            mark[i:i + length] = 1
                            occurring.setdefault(row, set()).update(phrases[phrase])
                size = np.diff(found.rows)
                counts.append(size)
                for row, (a, b) in enumerate(zip(found.rows[:-1].tolist(), found.rows[1:].tolist(), strict=True)):
                    hits.append(mark[a:b].tobytes() if row in occurring else b"")
                    # an item without an id comes last, as Spark sorts arrays
                    items.append(sorted(occurring.get(row, ()), key=lambda x: (x is None, x or "")))
                    text_of = part.data[part.offsets[row]:part.offsets[row + 1]]
                    digests.append(hashlib.sha256(text_of.tobytes()).digest() if row in occurring else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                 pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(digests, pa.binary())],
                names=["doc_id", "n_words", "hits", "items", "digest"])

    kind = dict(documents.dtypes)[doc_id]
    return documents.select(doc_id, F.col(text).cast("string")).mapInArrow(find, FOUND.format(id=kind))


def contamination(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, hits, items, digest) per document row: ``hits`` is empty, or has a 1 for each hit word.

    ``digest`` is the SHA-256 of a text that has hits: hits depend on the text alone, so id and digest tell which rows
    they belong to where ids repeat or are missing. An item without an id is one item, the last of ``items``.

    Null and empty texts have no words and no hits; items without words are never found; an empty benchmark
    gives documents without hits. Rows that repeat a doc_id are rows of their own, however many blocks the benchmark
    takes. Other columns are ignored.
    """
    spark = documents.sparkSession
    windows = materialise(test_windows(benchmark, item_id, item_text, window), "test-windows")
    # a phrase takes its words and its items' names
    total, size = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(
        F.octet_length("words").cast("long") + F.coalesce(F.octet_length("item_id"), F.lit(0))), F.lit(0))).first()
    share = max(total / block_windows, size / block_bytes)
    if share <= 1:
        return scan(documents, [tuple(r) for r in windows.collect()], doc_id, text)
    blocks = math.ceil(share) * 2
    # the blocks' hits meet again by row: ids may repeat
    rows = materialise(documents.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                                        F.col(text).cast("string").alias("text")), "scanned")
    found = None
    for block in range(blocks):
        # by item too, as any number of items can share a phrase
        part = windows.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block)
        hits = scan(rows, [tuple(r) for r in part.collect()], "row", "text")
        found = hits if found is None else found.unionByName(hits)
    # one byte a word, 0 or 1: the union of equally long marks is the greatest byte at each place
    united = found.groupBy(F.col("doc_id").alias("row"), "n_words").agg(
        F.collect_list(F.when(F.octet_length("hits") > 0, F.col("hits"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("digest").alias("digest"))
    return rows.select("row", "doc_id").join(united, "row").select("doc_id", "n_words", _united("all").alias("hits"), "items", "digest")


@F.udf(T.BinaryType())
def _united(marks):
    if not marks:
        return b""
    return np.maximum.reduce([np.frombuffer(m, np.uint8) for m in marks]).tobytes()


def items_digest(items) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _with_hits(documents: DataFrame, found: DataFrame, doc_id: str, text: str, how: str) -> DataFrame:
    """``documents`` joined with the hits (``__hits``) of their own id and text, no id equal to no id."""
    hit = found.where(F.octet_length("hits") > 0).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("hits").alias("__hits"))
    mine = F.unhex(F.sha2(F.col(text).cast("string"), 256))
    return documents.join(hit.dropDuplicates(["__id", "__digest"]),
                          F.col(doc_id).eqNullSafe(F.col("__id")) & (mine == F.col("__digest")), how)


def remove_documents(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without any hit."""
    return _with_hits(documents, found, doc_id, text, "left_anti").select(documents.columns)


def remove_spans(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 **options) -> DataFrame:
    """Documents with hit words, and what lies between two hit words of a run, cut out of their texts."""
    found = contamination(documents, benchmark, doc_id, text, **options)
    joined = _with_hits(documents, found, doc_id, text, "left")
    clean = F.when(F.col("__hits").isNull(), F.col(text)).otherwise(_without(text, "__hits"))
    return joined.withColumn(text, clean).select(documents.columns)


@F.udf(T.StringType())
def _without(text, hits):
    if not text or not hits:
        return text
    data = np.frombuffer(text.encode(), np.uint8)
    found = W.words(W.LOWER[data], np.array([0, len(data)]), W.ALNUM)
    mark = np.frombuffer(hits, np.uint8).astype(bool)
    cut = np.zeros(len(data) + 1, np.int64)
    np.add.at(cut, found.starts[mark], 1)
    np.add.at(cut, found.ends[mark], -1)
    runs = np.flatnonzero(mark[:-1] & mark[1:]) if len(mark) > 1 else np.empty(0, np.int64)
    np.add.at(cut, found.ends[runs], 1)
    np.add.at(cut, found.starts[runs + 1], -1)
    return data[np.cumsum(cut)[:-1] == 0].tobytes().decode()
