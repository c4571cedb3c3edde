"""Removal of repeated byte strings by prefix-free parsing and sorted phrase suffixes.

A string of ``WIDTH`` bytes has one trigger: the place in it where the hash of the next ``TRIGGER`` bytes is least. The
strings of a text that have a trigger in common, taken together, are a phrase, so consecutive phrases overlap by
``WIDTH`` - 1 bytes and equal strings always lie in phrases with equal triggers. The parse of a text is its row of
phrases; the dictionary holds each distinct phrase once with the least document that has it.

1. Parse: every text gives its phrases as (trigger, phrase digest), met by trigger. A phrase that a smaller document
   has too is repeated as a whole; this settles nearly all of a highly repetitive corpus.
2. Dictionary: only where a trigger has several phrases can strings repeat in part. Those phrases' suffixes are sorted by
   their first ``WIDTH`` bytes (the dictionary's suffix array as far as equality of such strings needs it), and equal
   ones get the least of their documents.
3. Parse and order together say which strings of a text start in a smaller document; their bytes are removed.

Triggers and phrases are combined within ``SLICE`` bytes of texts before they are sent, so a passage that is in most
documents sends one row a slice. A trigger with more than ``HOT`` phrases in a slice is not gathered anywhere: its
phrases are cut into single suffixes, which are dealt by their own content.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from graphloom.llm import words as W
from graphloom.llm.common import materialise, parts_for, text_bytes

WIDTH = 50
TRIGGER = 20
SLICE = 4 << 20
HOT = 64
BUCKET_BYTES = 8 << 20
_PIECE = 1 << 19
_REACH = WIDTH - TRIGGER + 1
_LAST = np.iinfo(np.int64).max
_C = W.mix(np.arange(1, 4, dtype=np.uint64)) | np.uint64(1)
#: Bytes of a trigger hash and of a phrase digest that are sent.
_H, _X = 5, 6


class Phrases(NamedTuple):
    row: np.ndarray
    first: np.ndarray       # the strings of phrase i start at first[i] .. last[i]
    last: np.ndarray
    trigger: np.ndarray     # 64-bit hash
    digest: np.ndarray      # of the phrase's bytes, 48 bits


def phrases(part: W.Slice) -> Phrases:
    data, offsets = part.data, part.offsets
    count = len(data) - WIDTH + 1
    if count <= 0:
        none = np.empty(0, np.int64)
        return Phrases(none, none, none, none.view(np.uint64), none.view(np.uint64))
    whole = np.ones(count, bool)
    for back in range(1, WIDTH):
        at = offsets[1:-1] - back
        whole[at[(at >= 0) & (at < count)]] = False
    first, last, trigger, at = [], [], [], []
    for a in range(0, count, _PIECE):
        b = min(count, a + _PIECE)
        bytes_ = np.concatenate([data[a:b + WIDTH - 1], np.zeros(8, np.uint8)])
        n = b - a + WIDTH - TRIGGER
        eight = np.ndarray((len(bytes_) - 7,), "<u8", bytes_.tobytes(), strides=(1,))
        hashed = W.mix(eight[:n] * _C[0] + eight[8:8 + n] * _C[1] + eight[TRIGGER - 8:TRIGGER - 8 + n] * _C[2])
        key = (hashed & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64)
        wide = 1
        while 2 * wide <= _REACH:
            key = np.minimum(key[:len(key) - wide], key[wide:])
            wide *= 2
        rest = _REACH - wide
        least = np.minimum(key[:b - a], key[rest:rest + b - a]) & np.uint64((1 << 24) - 1)
        here = whole[a:b]
        new, end = here.copy(), here.copy()
        change = least[1:] != least[:-1]
        new[1:] &= change | ~here[:-1]
        end[:-1] &= change | ~here[1:]
        begins = np.flatnonzero(new)
        first.append(begins + a)
        last.append(np.flatnonzero(end) + a)
        trigger.append(hashed[least[begins].astype(np.int64)])
        at.append(least[begins].astype(np.int64) + a)
    first, last, trigger, at = (np.concatenate(c) for c in (first, last, trigger, at))
    # a phrase that a piece's end cut in two is one phrase: where pieces end depends on what else is in the slice
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != last[:-1] + 1) | (at[1:] != at[:-1])
    first, last, trigger = first[new], last[np.append(new[1:], True)], trigger[new]
    digest = W.span_hashes(data, first, last + WIDTH) & np.uint64((1 << 8 * _X) - 1)
    return Phrases(np.searchsorted(offsets, first, "right") - 1, first, last, trigger, digest)


def _low(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _wide(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, W.Slice]]:
    """Slices of texts (column 1) with their rows of the batch."""
    for batch in batches:
        for part in W.slices(batch.column(1), SLICE):
            yield batch.slice(part.first, len(part.offsets) - 1), part


def _by_document(ids: np.ndarray, *columns: tuple[np.ndarray, int]) -> tuple[np.ndarray, list[list[bytes]]]:
    """Distinct ids, and for each column the packed values of every id."""
    if not len(ids):
        return ids, [[] for _ in columns]
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(_runs(ids[order]))
    ends = np.append(starts[1:], len(ids))
    packed = []
    for values, size in columns:
        data = _low(values[order], size)
        packed.append([data[a * size:b * size] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return ids[order][starts], packed


# --- 1. parse -------------------------------------------------------------------------------------------------------

ASKED = "bucket int, doc_id long, counts binary, ids binary, triggers binary, digests binary, hot binary, full binary, loose binary"


def _asked(**columns) -> pa.RecordBatch:
    n = len(columns["bucket"])
    kinds = {"bucket": pa.int32(), "doc_id": pa.int64()}
    names = [c.split()[0] for c in ASKED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(c, [None] * n), kinds.get(c, pa.binary())) for c in names], names=names)


def parse(buckets: int):
    """Function from (doc_id, text) to the phrases of a slice by bucket, and what the slice settles by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, part in _texts(batches):
            found = phrases(part)
            if not len(found.row):
                continue
            ids = rows.column(0).to_numpy()[found.row]
            order = np.lexsort((ids, found.digest, found.trigger))
            ids, trigger, digest = ids[order], found.trigger[order], found.digest[order]
            new = _runs(trigger, digest)
            least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
            full = ids > least
            ids_full, digest_full = ids[full], digest[full]
            ids, trigger, digest = ids[new], trigger[new], digest[new]
            run_of = np.cumsum(_runs(trigger)) - 1
            hot = np.bincount(run_of)[run_of] > HOT
            for name, (i, d) in (("full", (ids_full, digest_full)), ("loose", (ids[hot], digest[hot]))):
                documents, (packed,) = _by_document(i, (d, _X))
                if len(documents):
                    yield _asked(bucket=(documents % buckets).astype(np.int32), doc_id=documents, **{name: packed})
            place = ((trigger >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
            marks, marked = np.unique(trigger[hot]), np.empty(0, np.int64)
            if len(marks):
                marked = ((marks >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
            ids, trigger, digest, place = ids[~hot], trigger[~hot], digest[~hot], place[~hot]
            order = np.lexsort((ids, place))
            ids, trigger, digest, place = ids[order], trigger[order], digest[order], place[order]
            out = {c: [] for c in ("bucket", "counts", "ids", "triggers", "digests", "hot")}
            for bucket in np.union1d(place, marked).tolist():
                a, b = np.searchsorted(place, (bucket, bucket + 1))
                documents, counts = np.unique(ids[a:b], return_counts=True)
                out["bucket"].append(bucket)
                out["counts"].append(counts.astype("<u4").tobytes())
                out["ids"].append(documents.astype("<i8").tobytes())
                out["triggers"].append(_low(trigger[a:b], _H))
                out["digests"].append(_low(digest[a:b], _X))
                out["hot"].append(_low(marks[marked == bucket], _H))
            yield _asked(**out)

    return run


MET = "doc_id long, full binary, mixed binary, loose binary"


def _met(ids, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), *[pa.array(columns.get(c, [None] * len(ids)), pa.binary()) for c in ("full", "mixed", "loose")]],
        names=["doc_id", "full", "mixed", "loose"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each bucket (column 0) of a stream that is sorted by it."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if keys[a] != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(x for x in column.to_pylist() if x)


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of a bucket: phrases that a smaller one has, phrases whose trigger has others, loose phrases."""
    for table in _buckets(batches):
        settled = table.filter(pa.compute.is_valid(table.column("doc_id")))
        if settled.num_rows:
            yield _met(settled.column("doc_id"), full=settled.column("full").to_pylist(), loose=settled.column("loose").to_pylist())
        ids = np.repeat(np.frombuffer(_joined(table.column("ids")), "<i8"), np.frombuffer(_joined(table.column("counts")), "<u4"))
        trigger, digest = _wide(_joined(table.column("triggers")), _H), _wide(_joined(table.column("digests")), _X)
        if not len(ids):
            continue
        hot = np.unique(_wide(_joined(table.column("hot")), _H))
        order = np.lexsort((ids, digest, trigger))
        ids, trigger, digest = ids[order], trigger[order], digest[order]
        new = _runs(trigger, digest)
        least = ids[new][np.cumsum(new) - 1]
        full = ids > least
        documents, (packed,) = _by_document(ids[full], (digest[full], _X))
        yield _met(documents, full=packed)
        ids, trigger, digest = ids[new], trigger[new], digest[new]
        loose = np.isin(trigger, hot)
        documents, (packed,) = _by_document(ids[loose], (digest[loose], _X))
        yield _met(documents, loose=packed)
        starts = np.flatnonzero(_runs(trigger))
        several = np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts)
        mixed = np.repeat(several, np.diff(np.append(starts, len(ids)))) & ~loose
        documents, (packed,) = _by_document(ids[mixed], (digest[mixed], _X))
        yield _met(documents, mixed=packed)


# --- 2. dictionary --------------------------------------------------------------------------------------------------

ITEMS = "bucket int, doc_id long, digest long, mask int, ids binary, digests binary, places binary, sizes binary, bytes binary"


def _members(packed: list[bytes] | None) -> np.ndarray:
    return _wide(b"".join(packed or []), _X)


def _chosen(found: Phrases, marks: list, rows: int) -> np.ndarray:
    """Which phrases are among the marked digests of their row."""
    out = np.zeros(len(found.row), bool)
    begin = np.searchsorted(found.row, np.arange(rows + 1))
    for row, packed in enumerate(marks):
        if packed:
            a, b = begin[row], begin[row + 1]
            out[a:b] = np.isin(found.digest[a:b], _members(packed))
    return out


def _cut(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """data[start:start + size] of all spans, one after another."""
    ends = np.cumsum(sizes)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


def suffix_order(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the strings of WIDTH bytes at ``starts`` in byte order, and where a different one begins."""
    padded = np.zeros((len(starts), -(-WIDTH // 8) * 8), np.uint8)
    padded[:, :WIDTH] = data[starts[:, None] + np.arange(WIDTH)]
    keys = [k.astype(np.uint64) for k in padded.view(">u8").T]
    order = np.lexsort(keys[::-1])
    return order, _runs(*[k[order] for k in keys])


def _once(at: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """One of the places ``at`` for each combination of keys there."""
    order = at[np.lexsort([k[at] for k in keys])]
    return np.sort(order[_runs(*[k[order] for k in keys])])


def dictionary(buckets: int):
    """Function from (doc_id, text, mixed, loose) to phrases by bucket of their trigger, suffixes by their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, part in _texts(batches):
            found = phrases(part)
            n = rows.num_rows
            ids = rows.column(0).to_numpy()[found.row]
            mixed = _chosen(found, rows.column(2).to_pylist(), n)
            loose = _chosen(found, rows.column(3).to_pylist(), n)
            # a phrase that a text has twice is wanted once
            at = _once(np.flatnonzero(mixed), ids, found.digest)
            place = ((found.trigger[at] >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
            yield from _send(part.data, place, ids[at], found.digest[at], np.zeros(len(at), np.int64), found.first[at],
                             found.last[at] - found.first[at] + WIDTH)
            at = _once(np.flatnonzero(loose), ids, found.digest)
            if not len(at):
                continue
            many = found.last[at] - found.first[at] + 1
            of = np.repeat(at, many)
            offset = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            start = found.first[of] + offset
            hashed = W.span_hashes(part.data, start, start + WIDTH)
            order = np.lexsort((ids[of], hashed))
            of, offset, start, hashed = of[order], offset[order], start[order], hashed[order]
            new = _runs(hashed)
            least = ids[of][new][np.cumsum(new) - 1]
            # the least document may have a string in several phrases or places: all of them meet the other slices
            keep = ids[of] == least
            known = ~keep
            k = int(known.sum())
            if k:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[of][known] % buckets, pa.int32()), pa.array(ids[of][known]), pa.array(found.digest[of][known].view(np.int64)),
                     pa.array((1 << offset[known]).astype(np.int32)), *[pa.nulls(k, pa.binary())] * 5], names=[c.split()[0] for c in ITEMS.split(", ")])
            of, offset, start, hashed = of[keep], offset[keep], start[keep], hashed[keep]
            yield from _send(part.data, (hashed % np.uint64(buckets)).astype(np.int64), ids[of], found.digest[of], offset, start,
                             np.full(len(of), WIDTH))

    return run


def _send(data, place, ids, digest, offset, start, size) -> Iterator[pa.RecordBatch]:
    order = np.argsort(place, kind="stable")
    out = {c.split()[0]: [] for c in ITEMS.split(", ")}
    begins = np.flatnonzero(_runs(place[order])) if len(place) else np.empty(0, np.int64)
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(place)], strict=False):
        at = order[a:b]
        for name, value in (
                ("bucket", place[at[0]]), ("doc_id", None), ("digest", None), ("mask", None), ("ids", ids[at].astype("<i8").tobytes()),
                ("digests", _low(digest[at], _X)), ("places", offset[at].astype(np.uint8).tobytes()),
                ("sizes", size[at].astype(np.uint8).tobytes()), ("bytes", _cut(data, start[at], size[at]).tobytes())):
            out[name].append(value)
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
    if out["bucket"]:
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))


REPEATED = "doc_id long, digests binary, masks binary"


def sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of a bucket: its phrases some of whose strings start in a smaller document, a bit a string."""
    for table in _buckets(batches):
        known = table.filter(pa.compute.is_valid(table.column("doc_id")))
        ids, digest, mask = [], [], []
        if known.num_rows:
            ids.append(known.column("doc_id").to_numpy())
            digest.append(known.column("digest").to_numpy().view(np.uint64))
            mask.append(known.column("mask").to_numpy().view(np.uint32).astype(np.uint64))
        size = np.frombuffer(_joined(table.column("sizes")), np.uint8).astype(np.int64)
        if len(size):
            data = np.frombuffer(_joined(table.column("bytes")), np.uint8)
            item_ids = np.frombuffer(_joined(table.column("ids")), "<i8")
            item_digests = _wide(_joined(table.column("digests")), _X)
            place = np.frombuffer(_joined(table.column("places")), np.uint8).astype(np.int64)
            many = size - WIDTH + 1
            of = np.repeat(np.arange(len(size)), many)
            offset = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            order, new = suffix_order(data, (np.cumsum(size) - size)[of] + offset)
            starts = np.flatnonzero(new)
            least = np.repeat(np.minimum.reduceat(item_ids[of[order]], starts), np.diff(np.append(starts, len(order))))
            order = order[item_ids[of[order]] > least]
            bits = np.uint64(1) << (place[of[order]] + offset[order]).astype(np.uint64)
            total = np.zeros(len(size), np.uint64)
            np.bitwise_or.at(total, of[order], bits)
            hit = np.flatnonzero(total)
            ids.append(item_ids[hit])
            digest.append(item_digests[hit])
            mask.append(total[hit])
        if ids:
            documents, (digests, masks) = _by_document(np.concatenate(ids), (np.concatenate(digest), _X), (np.concatenate(mask), 4))
            yield pa.RecordBatch.from_arrays([pa.array(documents), pa.array(digests, pa.binary()), pa.array(masks, pa.binary())],
                                             names=["doc_id", "digests", "masks"])


# --- 3. removal -----------------------------------------------------------------------------------------------------

REMOVED = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, full, digests, masks) -> what is left of each text and what is not."""
    for rows, part in _texts(batches):
        n = rows.num_rows
        full, digests, masks = (rows.column(c).to_pylist() for c in (2, 3, 4))
        cover = np.zeros(len(part.data) + 1, np.int32)
        if any(full) or any(digests):
            found = phrases(part)
            whole = _chosen(found, full, n)
            np.add.at(cover, found.first[whole], 1)
            np.add.at(cover, found.last[whole] + WIDTH, -1)
            begin = np.searchsorted(found.row, np.arange(n + 1))
            for row in range(n):
                if not digests[row]:
                    continue
                a, b = begin[row], begin[row + 1]
                known, bits = _members(digests[row]), _wide(b"".join(masks[row]), 4)
                order = np.argsort(known, kind="stable")
                known, bits = known[order], bits[order]
                starts = np.flatnonzero(_runs(known))
                known, bits = known[starts], np.bitwise_or.reduceat(bits, starts)
                at = np.minimum(np.searchsorted(known, found.digest[a:b]), len(known) - 1)
                mine = np.flatnonzero(known[at] == found.digest[a:b])
                for k in range(_REACH):
                    start = found.first[a:b][mine[(bits[at[mine]] >> np.uint64(k)) & np.uint64(1) == 1]] + k
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + WIDTH, -1)
        gone = np.cumsum(cover)[:-1] > 0
        spans, kept = [], []
        for a, b in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), strict=True):
            here = gone[a:b]
            edges = np.flatnonzero(np.diff(here, prepend=False, append=False)).tolist() if here.any() else []
            spans.append([{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2], strict=True)])
            kept.append(part.data[a:b][~here].tobytes() if edges else part.data[a:b].tobytes())
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(np.diff(part.offsets), pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) per document row: texts as bytes, without what smaller documents have.

    A byte is removed if it lies in a string of ``WIDTH`` bytes that also starts in a document with a smaller id; strings
    are judged on the input. Null and empty texts, and texts shorter than ``WIDTH`` bytes, stay as they are. Rows with
    equal ids are parts of one document and remove nothing from each other. A row without an id counts as the
    greatest. An empty table gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    size = text_bytes(documents, text)
    buckets = parts_for(spark, size, BUCKET_BYTES)
    rows = documents.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("doc_id"),
                            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    met = (rows.mapInArrow(parse(buckets), ASKED).repartition(buckets, "bucket").sortWithinPartitions("bucket")
           .mapInArrow(meet, MET))
    marks = materialise(met.groupBy("doc_id").agg(
        *[F.collect_list(c).alias(c) for c in ("full", "mixed", "loose")]), "marks")
    asked = rows.join(marks.where((F.size("mixed") > 0) | (F.size("loose") > 0)).select("doc_id", "mixed", "loose"), "doc_id")
    repeated = (asked.select("doc_id", "text", "mixed", "loose").mapInArrow(dictionary(buckets), ITEMS)
                .repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(sort_suffixes, REPEATED))
    masks = repeated.groupBy("doc_id").agg(F.collect_list(F.struct("digests", "masks")).alias("m")).select(
        "doc_id", F.col("m.digests").alias("digests"), F.col("m.masks").alias("masks"))
    settled = (marks.where(F.size("full") > 0).select("doc_id", "full").join(masks, "doc_id", "full"))
    done = rows.join(settled, "doc_id", "left").select("doc_id", "text", "full", "digests", "masks").mapInArrow(remove, REMOVED)
    return done.withColumn("doc_id", F.when(F.col("doc_id") != _LAST, F.col("doc_id")))
