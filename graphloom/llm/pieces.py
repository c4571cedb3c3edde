"""SentencePiece (BPE) encoding in vectorised merge rounds, and decoding.

A slice of texts becomes words: a word begins with the blanks before it, and no piece of the vocabulary has a blank after
another character, so no merge crosses words. Equal words of a slice are encoded once. A word is also cut between
two characters that no piece holds side by side, which keeps texts without blanks short.

All words' characters lie in one flat array of symbols. A round finds the best rank of a pair of neighbours of
each word (segmented minimum), merges that pair wherever it stands in the word, from the left and without overlaps, takes
the vanished symbols out and looks up the pairs that changed; words without a pair are done. One merge at a time,
best rank first and leftmost among equals, is what the format asks for, and a round gives the same: it differs only if a
merge makes a pair of a rank no worse than its own. Pieces that can do so are known beforehand, by
looking for a piece that holds them, ranks no worse and splits there; for those only the leftmost place is merged.

Characters outside the vocabulary become the pieces of their bytes.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from graphloom.llm import words as W

SLICE_BYTES = 2 << 20
BLANK = "▁"
_NONE = np.int32(np.iinfo(np.int32).max)


class Pieces:
    """Tables of a model: symbols (pieces and single characters) and the pairs of symbols that merge."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        odd = [i for i in range(size) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)]
        rules = self._unsupported()
        if rules:
            raise ValueError(f"this model has {rules}, which merge rounds do not cover")
        self.bytes = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        text = {lib.id_to_piece(i): i for i in range(size) if i not in set(odd)}
        scores = sorted({lib.get_score(i) for i in text.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        rank = {p: rank_of[lib.get_score(i)] for p, i in text.items()}
        symbol = dict(text)                         # a piece is its id; other characters follow
        for c in sorted({c for p in text for c in p} - set(text)):
            symbol[c] = size + len(symbol) - len(text)
        self.many = size + len(symbol) - len(text) + 1
        self.other = self.many - 1                  # any character that no piece holds
        self.outside = size                         # symbols from here on are no pieces
        self.of_char = np.full(0x110000, self.other, np.int32)
        for c, s in symbol.items():
            if len(c) == 1:
                self.of_char[ord(c)] = s

        pairs, beside, hasty = {}, set(), set()
        for piece, own in text.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                beside.add(ord(piece[cut - 1]) << 21 | ord(piece[cut]))
                if left in symbol and right in symbol:
                    pairs[symbol[left] * self.many + symbol[right]] = (rank[piece], own)
                    for part in (left, right):
                        if part in rank and rank[piece] <= rank[part]:
                            hasty.add(symbol[part])
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.hasty = np.zeros(self.many, bool)
        self.hasty[list(hasty)] = True
        self.beside = np.array(sorted(beside), np.int64)

    def _unsupported(self) -> str:
        """What merge rounds cannot do: other model types, unused or user-defined pieces, other text rules."""
        lib = self.library
        asked = " a  b 　Ａ\t "
        if lib.normalize(asked) != BLANK + asked.replace(" ", BLANK) or lib.normalize("") != "":
            return "other rules for the text than a blank in front and visible blanks"
        size = lib.get_piece_size()
        if any(lib.is_unused(i) for i in range(size)):
            return "unused pieces"
        if any(lib.piece_to_id(f"<0x{b:02X}>") == lib.unk_id() for b in range(256)):
            return "no pieces for bytes"
        if any(BLANK in p.lstrip(BLANK) for p in map(lib.id_to_piece, range(size))):
            return "pieces with a blank inside"
        return ""

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs; the worst rank where there is none."""
        key = left.astype(np.int64) * self.many + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE), self.merged[at]

    def merge(self, chars: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, bounds of words) after all merges of words that begin at ``begins`` in ``chars`` (code points).

        Symbols that are no pieces give the place of their character, as a negative number less one."""
        symbol = self.of_char[chars]
        start = np.zeros(len(chars) + 1, bool)
        start[begins] = True
        start[-1] = True
        # neighbours that no piece holds together are words of their own
        key = chars[:-1].astype(np.int64) << 21 | chars[1:]
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        cut = start[:-1].copy()
        cut[1:] |= self.beside[at] != key
        of_part = np.cumsum(cut) - 1
        out = np.where(symbol < self.outside, symbol, -1 - np.arange(len(symbol), dtype=np.int64))
        stays = np.ones(len(chars), bool)

        place = np.arange(len(chars))
        rank = np.full(len(chars), _NONE)           # of the pair that begins here
        into = np.zeros(len(chars), np.int32)
        inner = np.flatnonzero(~cut[1:])
        rank[inner], into[inner] = self._look_up(symbol[inner], symbol[inner + 1])
        part, symbol = of_part, symbol.copy()
        while len(place):
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            length = np.diff(np.append(first, len(part)))
            best = np.minimum.reduceat(rank, first)
            if (best == _NONE).any():
                # words without a pair are done
                going = np.repeat(best != _NONE, length)
                out[place[~going]] = np.where(symbol[~going] < self.outside, symbol[~going], -1 - place[~going])
                place, part, symbol, rank, into = (a[going] for a in (place, part, symbol, rank, into))
                if not len(place):
                    break
                length, best = length[best != _NONE], best[best != _NONE]
                first = np.cumsum(length) - length
            hit = rank == np.repeat(best, length)
            where = np.flatnonzero(hit)
            # of overlapping places every second one, from the left
            opens = np.concatenate([[True], where[1:] != where[:-1] + 1])
            number = np.arange(len(where))
            chosen = (number - np.maximum.accumulate(np.where(opens, number, 0))) % 2 == 0
            new_word = np.concatenate([[True], part[where[1:]] != part[where[:-1]]])
            chosen &= new_word | ~self.hasty[into[where]]
            where = where[chosen]
            symbol[where] = into[where]
            gone = where + 1
            stays[place[gone]] = False
            keep = np.ones(len(place), bool)
            keep[gone] = False
            # a merged symbol's own pair and that of the symbol before it change
            changed = np.zeros(len(place), bool)
            changed[where] = True
            place, part, symbol, rank, into, changed = (a[keep] for a in (place, part, symbol, rank, into, changed))
            changed[:-1] |= changed[1:]
            now = np.flatnonzero(changed)
            rank[now] = _NONE
            now = now[now + 1 < len(part)]
            now = now[part[now] == part[now + 1]]
            rank[now], into[now] = self._look_up(symbol[now], symbol[now + 1])
        bounds = np.concatenate([[0], np.cumsum(stays)])
        return out[stays], bounds[np.append(begins, len(chars))]

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of words, given as bytes with plain blanks."""
        text = words.cast(pa.large_binary())
        _, where, data = text.buffers()
        offsets = np.frombuffer(where, np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
        leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        begins = leads[offsets[:-1] - offsets[0]]
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        chars[chars == 32] = ord(BLANK)
        ids, bounds = self.merge(chars, begins)
        unknown = np.flatnonzero(ids < 0)
        if not len(unknown):
            return ids, bounds
        point = chars[-1 - ids[unknown]]
        count = np.ones(len(ids), np.int64)
        count[unknown] = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        total = np.concatenate([[0], np.cumsum(count)])
        full = np.repeat(ids, count)
        spelled = np.frombuffer("".join(map(chr, point.tolist())).encode(), np.uint8)
        full[full < 0] = self.bytes[spelled]
        return full, total[bounds]

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a column of strings, in order; null is an empty text."""
        # a visible blank in a text is a blank; and a text that is not empty begins with one more
        column = pa.compute.replace_substring(column.cast(pa.large_string()).fill_null(""), BLANK, " ")
        full = pa.compute.greater(pa.compute.binary_length(column), 0)
        column = pa.compute.if_else(full, pa.compute.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string())), column)
        for part in W.slices(column, SLICE_BYTES):
            data, offsets = part.data, part.offsets
            if not len(data):
                yield from [np.empty(0, np.int64)] * (len(offsets) - 1)
                continue
            blank = data == 32
            begins = blank.copy()
            begins[1:] &= ~blank[:-1]
            begins[offsets[:-1][offsets[:-1] < len(data)]] = True
            where = np.append(np.flatnonzero(begins), len(data)).astype(np.int64)
            words = pa.Array.from_buffers(pa.large_binary(), len(where) - 1, [None, pa.py_buffer(where), pa.py_buffer(np.ascontiguousarray(data))])
            words = words.dictionary_encode()
            ids, bounds = self.word_ids(words.dictionary)
            code = words.indices.to_numpy()
            first, count = bounds[:-1][code], np.diff(bounds)[code]
            total = np.concatenate([[0], np.cumsum(count)])
            ids = ids[np.arange(total[-1]) + np.repeat(first - total[:-1], count)]
            cuts = total[np.searchsorted(where, offsets)].tolist()
            yield from (ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def pieces(path: str) -> Pieces:
    """One set of tables for each Python worker, kept from task to task."""
    kept = sys.modules.setdefault("_sentence_pieces", types.ModuleType("_sentence_pieces")).__dict__
    if path not in kept:
        kept[path] = Pieces(path)
    return kept[path]


def encode(documents: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", batch_texts: int = 2048) -> DataFrame:
    """(doc_id, ids) of every row: the ids that the SentencePiece model ``model``, a file that every worker has, gives
    its text, without begin and end.

    Null and empty texts have no ids. Rows keep their ids, whatever they are: null, repeated or not numeric. An empty table
    gives an empty result; other columns are ignored. A model whose pieces or text rules the merge rounds do not
    cover is refused with a ValueError. A word of n characters that cannot be cut takes up to n rounds, each over
    what is left of it; words of n characters, not texts, are what should be short.
    """
    kind = documents.schema[doc_id].dataType.simpleString()
    asked = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_texts):
                some = batch.slice(at, batch_texts)
                ids = list(tables.encode(some.column(1)))
                bounds = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], names=["doc_id", "ids"])

    return asked.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str, ids: str = "ids", out: str = "decoded", batch_texts: int = 512) -> DataFrame:
    """``encoded`` with the text that the library makes of each row's ids; null ids give an empty text."""
    names = [n for n in encoded.columns if n != out]
    asked = encoded.select(*[F.col(f"`{n}`") for n in names])
    at = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = pieces(model).library
        for batch in batches:
            for begin in range(0, batch.num_rows, batch_texts):
                some = batch.slice(begin, batch_texts)
                texts = [library.decode(i) if i else "" for i in some.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.string())], names=[*names, out])

    return asked.mapInArrow(run, StructType([*asked.schema, StructField(out, StringType())]))
