"""Token ids in length-delimited binary records with masked checksums and a separate offset index.

A record is: length of the payload (unsigned 64 bits), masked CRC-32 of those 8 bytes (32 bits), payload, masked
CRC-32 of the payload; all little-endian. A payload is: bytes a token id, 2 or 4 (8 bits), 1 if there is a document id
and 0 if it is null (8 bits), the id (signed 64 bits), the token ids (unsigned). The mask turns a checksum right by 15 bits and
adds a constant, so that checksums of data that hold checksums stay useful.

Each task writes one file under a name that no other attempt uses, and returns one index row a record. Spark
commits the index of exactly one attempt of each task, and readers open only files that the index names, so a
lost executor or a second attempt leaves at most a file that nobody reads.
"""

from __future__ import annotations

import itertools
import re
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from graphloom.llm import words as W
from graphloom.llm.common import parts_for, shared_folder, text_bytes

END_ID = 2
FILE_BYTES = 16 << 20
KNOWN_PIECES = 250_000
SLICE_BYTES = 1 << 20

INDEX = "file string, part int, place long, doc_id long, offset long, length long, n_tokens long"
HEAD, CHECK, LEAD = "<Q", "<I", "<BBq"
#: Fixed value of the mask.
MASK = 0xA282EAD8


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int = 4) -> bytes:
    payload = struct.pack(LEAD, width, doc_id is not None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack(HEAD, len(payload))
    return b"".join((size, struct.pack(CHECK, masked(size)), payload, struct.pack(CHECK, masked(payload))))


def parse(size: bytes, read) -> tuple[int | None, np.ndarray]:
    """(document id, ids as unsigned 32 bits) of the record whose first 8 bytes are ``size``; ``read(n)`` gives the rest."""
    if struct.unpack(CHECK, read(4))[0] != masked(size):
        raise ValueError("a record's length is damaged")
    payload = read(struct.unpack(HEAD, size)[0])
    if struct.unpack(CHECK, read(4))[0] != masked(payload):
        raise ValueError("a record is damaged")
    width, known, doc_id = struct.unpack_from(LEAD, payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(LEAD)).astype("<u4")
    return doc_id if known else None, ids


class WordEncoder:
    """Ids of whole texts; each distinct word of a slice is encoded once, and known words not again.

    For tokenizers that drop white space and letter case and never join words, nor letters and marks: the ids of a text
    are those of its pieces in a row. A piece is a word in small letters, its closing ASCII marks taken off as a piece of
    their own where they follow an ASCII letter or digit. Pieces of plain small letters go to the library's merging
    step directly; all others go through all its steps. The library looks for special tokens before it makes letters
    small, so what reads like one in small letters keeps its own letters in its piece. Pieces are told apart by 64-bit hashes, computed a slice
    at a time. What is known is three arrays, which are dropped when they hold ``KNOWN_PIECES`` pieces.
    """

    PLAIN = re.compile(r"[a-zß-öø-ÿ]+").fullmatch
    #: ASCII marks without the apostrophe, which opens contractions, and without those that special tokens end in.
    MARKS = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"))

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        special = [re.escape(low) for t in self.tokenizer.get_added_tokens_decoder().values()
                   if (low := W.LOWER[np.frombuffer(t.content.encode(), np.uint8)].tobytes())]
        # all places, overlapping ones too
        self.special = [re.compile(b"(?=(" + s + b"))") for s in special]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        # the byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)         # hashes, ascending
        self.first = np.empty(0, np.int64)          # of each, where its ids begin in ``ids``
        self.count = np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        if len(self.known) + len(hashes) > KNOWN_PIECES:
            self.forget()
        lists: list[list[int]] = []
        other = []
        tokenize, alphabet = self.model.tokenize, self.alphabet
        for piece in pieces:
            if self.PLAIN(text := piece.decode()):
                lists.append([t.id for t in tokenize(text if text.isascii() else piece.decode("latin-1").translate(alphabet))])
            else:
                other.append(len(lists))
                lists.append([])
        found = self.tokenizer.encode_batch_fast([pieces[i].decode() for i in other], add_special_tokens=False)
        for i, encoding in zip(other, found, strict=True):
            lists[i] = encoding.ids
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(itertools.chain.from_iterable(lists), "<u4", int(count.sum()))
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])[order]
        self.count, self.known = np.concatenate([self.count, count])[order], known[order]
        self.ids = np.concatenate([self.ids, flat])

    def pieces(self, part: W.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, ends, row bounds) of the pieces of all texts."""
        low = W.LOWER[part.data]
        small = low.tobytes()
        for special in self.special:
            for found in special.finditer(small):
                a, b = found.span(1)
                low[a:b] = part.data[a:b]
        words = W.words(low, part.offsets, W.NONSPACE)
        ends = words.ends.copy()
        while True:
            closing = (ends > words.starts + 1) & self.MARKS[low[ends - 1]]
            if not closing.any():
                break
            ends -= closing
        plain = W.ALNUM[low[ends - 1]] & (low[ends - 1] < 128)
        ends = np.where(plain, ends, words.ends)
        closed = ends < words.ends
        place = np.arange(len(ends)) + np.cumsum(closed) - closed
        total = len(ends) + int(closed.sum())
        starts, stops = np.empty(total, np.int64), np.empty(total, np.int64)
        starts[place], stops[place] = words.starts, ends
        starts[place[closed] + 1], stops[place[closed] + 1] = ends[closed], words.ends[closed]
        return low, starts, stops, np.append(place, total)[words.rows]

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a column, in order."""
        for part in W.slices(column, SLICE_BYTES):
            low, starts, ends, rows = self.pieces(part)
            hashes, where, which = np.unique(W.span_hashes(low, starts, ends), return_index=True, return_inverse=True)
            at = np.searchsorted(self.known, hashes)
            new = np.ones(len(hashes), bool)
            if len(self.known):
                new = self.known[np.minimum(at, len(self.known) - 1)] != hashes
            if new.any():
                if len(self.known) + int(new.sum()) > KNOWN_PIECES:
                    new[:] = True
                data = low.tobytes()
                self.learn(hashes[new], [data[a:b] for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)])
                at = np.searchsorted(self.known, hashes)
            first, count = self.first[at][which], self.count[at][which]
            total = np.zeros(len(which) + 1, np.int64)
            np.cumsum(count, out=total[1:])
            ids = self.ids[np.arange(total[-1]) + np.repeat(first - total[:-1], count)]
            bounds = total[rows].tolist()
            yield from (ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker, kept from task to task."""
    kept = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders")).__dict__
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def write_records(documents: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                  end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all documents, by ascending doc_id, as record files in ``folder``; returns the index, written too.

    Null texts are empty and give the end id alone; null ids come first; rows with equal ids are ordered by text and
    are records of their own; an empty table gives an empty index. Other columns are ignored.
    """
    spark = documents.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        words, end = encoder(tokenizer), np.array([end_id], "<u4")
        part, out, at, place, name = TaskContext.get().partitionId(), None, 0, 0, ""
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, path = fs.FileSystem.from_uri(folder)
                store.create_dir(path, recursive=True)
                name = f"records-{part:06d}-{uuid.uuid4().hex}.bin"
                out = store.open_output_stream(f"{path}/{name}")
            offsets, sizes, counts = [], [], []
            keys = batch.column(0).to_pylist()
            for key, ids in zip(keys, words.encode(batch.column(1)), strict=True):
                out.write(record := frame(key, np.concatenate([ids, end]), words.width))
                offsets.append(at)
                sizes.append(len(record))
                counts.append(len(ids) + 1)
                at += len(record)
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.string()), pa.array([part] * n, pa.int32()),
                 pa.array(range(place, place + n), pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=["file", "part", "place", "doc_id", "offset", "length", "n_tokens"])
            place += n
        if out is not None:
            out.close()

    parts = parts_for(spark, text_bytes(documents, text), file_bytes)
    (documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
     .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(write, INDEX).write.parquet(f"{folder}/index"))
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Per record of all files: (doc_id, start, n_tokens, ids_crc32); ``start`` counts the ids of all records before.

    Files are read as streams, one record in memory at a time. Damaged files raise an error.
    """
    files = (read_index(spark, folder).groupBy("part", "file")
             .agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("records"))
             # one row a file
             .withColumn("start", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
             .select("file", "records", F.coalesce("start", F.lit(0)).alias("start")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(folder)
                start, rows, left = row["start"], [], row["records"]
                with store.open_input_stream(f"{path}/{row['file']}", buffer_size=1 << 20) as stream:
                    while size := stream.read(8):
                        key, ids = parse(size, stream.read)
                        rows.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        left -= 1
                        if len(rows) == 8192:
                            yield _table(rows)
                            rows = []
                if left:
                    raise ValueError(f"{row['file']} has {-left} records more than its index")
                yield _table(rows)

    return files.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file").mapInArrow(read, READ)


def _table(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


def fetch_records(index: DataFrame, folder: str) -> DataFrame:
    """(doc_id, ids) of the index rows given, in any order: a shuffled read of single records."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            keys, ids = [], []
            for row in sorted(batch.to_pylist(), key=lambda r: (r["file"], r["offset"])):
                store, path = fs.FileSystem.from_uri(folder)
                with store.open_input_file(f"{path}/{row['file']}") as source:
                    source.seek(row["offset"])
                    key, data = parse(source.read(8), source.read)
                keys.append(key)
                ids.append(data.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return index.select("file", "offset").mapInArrow(fetch, "doc_id long, ids array<long>")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
