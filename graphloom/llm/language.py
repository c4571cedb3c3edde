"""Language identification by compression: the dictionary that compresses a text best names its language.

For each language a zstandard raw-content dictionary is filled with pieces of training texts. A text is compressed
with each; the smallest output wins, and a narrow margin to the second can be rejected. Letter case, digits and ASCII
marks are left out on both sides. Long texts are compressed in pieces, as a text that is longer than the dictionary
would otherwise mostly be compressed by its own past.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Bounds of the training sample: documents a language, characters a document.
SAMPLE_DOCUMENTS = 1000
SAMPLE_CHARS = 2000
DICTIONARY_BYTES = 64 << 10
PIECE_BYTES = 16 << 10
LEVEL = 6
UNKNOWN = "und"
#: Predictions whose second smallest output is less than this share larger are rejected.
LEAST_MARGIN = 0.01

#: Small ASCII letters and everything outside ASCII stay, the rest becomes a space.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

PREDICTED = "lang_pred string, score double, margin double, rejected boolean"


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        sample_documents: int = SAMPLE_DOCUMENTS) -> dict[str, bytes]:
    """Dictionaries by language, from a sample of at most ``sample_documents`` documents a language.

    A document gives one piece of at most ``SAMPLE_CHARS`` characters, from a place set by a hash of the text.
    The sample is a fixed share of the hash range, so it needs a count by language but no sort.
    """
    known = documents.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    hashed = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"),
                          (F.pmod(F.xxhash64(F.col(doc_id), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)).alias("h"))
    counts = {r["lang"]: r["count"] for r in hashed.groupBy("lang").count().collect()}
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(0.8 * sample_documents / n))]) if counts else F.lit(None)
    start = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)) + 1
    rows = (hashed.where(F.col("h") < share[F.col("lang")] if counts else F.lit(False))
            .select("lang", F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("piece"))
            .distinct().withColumn("h", F.xxhash64("piece"))
            .orderBy("lang", "h", "piece").collect())
    pieces: dict[str, list[bytes]] = {k: [] for k in sorted(counts)}
    for r in rows:
        pieces[r["lang"]].append(letters_of(r["piece"]))
    return {k: _fill(v) for k, v in pieces.items()}


def letters_of(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode().translate(LETTERS).split())


def _fill(pieces: list[bytes]) -> bytes:
    """A part of every piece, as long for each as the size of a dictionary allows; what short ones leave goes to longer ones."""
    each, spare = 0, DICTIONARY_BYTES - len(pieces)         # a space between two
    for left, size in zip(range(len(pieces), 0, -1), sorted(map(len, pieces)), strict=True):
        each = min(size, spare // left)
        if each < size:
            break
        spare -= size
    return b" ".join(p[:each] for p in pieces if p)[:DICTIONARY_BYTES].ljust(16)


def predict(documents: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
            least_margin: float = LEAST_MARGIN) -> DataFrame:
    """All columns of ``documents`` but the text, with the predicted language, score, margin and rejection.

    ``margin`` is how much larger the second smallest output is, as a share of it; ``score`` is 0 for a tie and
    rises to 1; a margin below ``least_margin`` sets ``rejected``, beside the prediction. Null texts and texts without a letter are ``und``
    with score 0. Equal outputs go to the first language by name. Columns named like a result are replaced.
    """
    names = sorted(dictionaries)
    results = ["lang_pred", "score", "margin", "rejected"]
    kept = [c for c in documents.columns if c != text and c not in results]
    # the dictionaries' size is bounded by DICTIONARY_BYTES for each label
    shared = documents.sparkSession.sparkContext.broadcast([dictionaries[n] for n in names])

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        by = []
        for content in shared.value:
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False))
        for batch in batches:
            n = batch.num_rows
            size = np.zeros((max(1, len(by)), n))
            for row, value in enumerate(batch.column(0)):
                whole = letters_of(value.as_py())
                for i in range(0, len(whole), PIECE_BYTES):
                    piece = whole[i:i + PIECE_BYTES]
                    for k, c in enumerate(by):
                        size[k, row] += len(c.compress(piece))
            best = size.argmin(axis=0)
            least = size.min(axis=0)
            second = np.partition(size, 1, axis=0)[1] if len(by) > 1 else least * 2
            margin = (second - least) / np.maximum(least, 1)
            letters = np.array(batch.column(1).to_numpy(zero_copy_only=False), bool) & bool(by)
            found = [names[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
            margin = np.where(letters, margin, 0.0)
            columns = [pa.array(found, pa.string()), pa.array(1 - np.exp(-20 * margin)), pa.array(margin),
                       pa.array(letters & (margin < least_margin), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *columns], names=[*kept, *results])

    schema = T.StructType([documents.schema[c] for c in kept] + T.StructType.fromDDL(PREDICTED).fields)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return documents.select(F.col(text).alias("__text"), letters.alias("__letters"), *kept).mapInArrow(compress, schema)
