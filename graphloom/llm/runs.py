"""Periodic runs of words by seeds that are extended along diagonals.

A run is a stretch of consecutive words with smallest period q, at least ``max(LEAST, 2 * q)`` words long, that no
neighbouring word extends. On the diagonal of lag q (word i against word i + q) it is a row of at least
``max(q, LEAST - q)`` equal pairs, so it holds an equal pair of k-grams at lag q for every k up to that number:

* lags below ``SHORT_LAGS`` share k-grams of ``LEAST // 2`` words;
* lags from K to 2 K - 1 share k-grams of K words, for K = ``SHORT_LAGS``, 2 ``SHORT_LAGS``, ...

For each class of lags the k-grams of all texts of a slice are indexed by sorting their hashes, and pairs of places of one
text whose lag is in the class become seeds. Places of one k-gram that lie at most K / 2 apart form a chain: the k-gram
has a short period there. A seed is needed only where one of its places opens its chain, for the first k-gram of
a run's row of equal pairs does: were both places inside their chains, the pair of words before would be equal too. And
both places in one chain mean a shorter period. So a text gives a number of seeds in proportion to its words for each
class, however often one word or phrase comes again. Only k-grams that occur twice in a text are looked at in the next class.

Seeds are extended word by word, lag by lag; a table of the furthest word covered on each lag keeps a stretch
from being extended again. Whether words are equal is decided on the words, never on hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from graphloom.llm import words as W

LEAST = 12
SHORT_LAGS = 8
#: Words that are indexed together; a longer text is indexed alone.
SLICE_WORDS = 1 << 17

_BASE = 0xD1342543DE82EF95
_UNBASE = pow(_BASE, -1, 1 << 64)
_RUN = "struct<start: long, length: long, period: long>"


def _equal(codes: np.ndarray, i: int, j: int, most: int, step: int) -> int:
    """How many words from ``i`` and ``j`` on (``step`` 1) or back (-1) are equal, at most ``most``."""
    done, block = 0, 16
    while done < most:
        size = min(block, most - done)
        if step > 0:
            same = codes[i + done:i + done + size] == codes[j + done:j + done + size]
        else:
            same = (codes[i - done - size + 1:i - done + 1] == codes[j - done - size + 1:j - done + 1])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done += size
        block *= 4
    return done


def _spread(first: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, member) of all ranges first[x] .. upto[x] - 1."""
    many = np.maximum(upto - first, 0)
    owner = np.repeat(np.arange(len(first)), many)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + first[owner]


class _Grams:
    """Hashes of the k-grams of a slice's texts, which no two texts share."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray) -> None:
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.end = bounds[1:][self.text]
        self.total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(W.mix(codes.astype(np.uint64) + np.uint64(1)) * W.powers(_BASE, len(codes)), out=self.total[1:])

    def repeated(self, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(group, place) of the k-grams at ``places`` that their text has at least twice, in this order."""
        places = places[places + k <= self.end[places]]
        if not len(places):
            return places, places
        hashed = (self.total[places + k] - self.total[places]) * W.powers(_UNBASE, len(self.text) + 1)[places]
        hashed = W.mix(hashed + W.mix(self.text[places].astype(np.uint64)))
        order = np.argsort(hashed, kind="stable")
        places, hashed = places[order], hashed[order]
        new = np.ones(len(places), bool)
        new[1:] = hashed[1:] != hashed[:-1]
        group = np.cumsum(new) - 1
        twice = np.bincount(group)[group] > 1
        return group[twice], places[twice]


def _short_seeds(group: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lags, starts = [], []
    for ahead in range(1, SHORT_LAGS):
        lag = place[ahead:] - place[:-ahead]
        near = (group[ahead:] == group[:-ahead]) & (lag < SHORT_LAGS)
        lags.append(lag[near])
        starts.append(place[:-ahead][near])
    return np.concatenate(lags), np.concatenate(starts)


def _long_seeds(group: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of lags k .. 2 k - 1 of which one place opens its chain and that lie in two chains."""
    width = int(place.max()) + 2 * k + 1
    key = group * width + place
    opens = np.ones(len(key), bool)
    opens[1:] = key[1:] - key[:-1] > k // 2
    opens[1:] |= group[1:] != group[:-1]
    chain = np.cumsum(opens)
    openers, others = np.flatnonzero(opens), np.flatnonzero(~opens)
    owner, member = _spread(np.searchsorted(key, key[openers] + k), np.searchsorted(key, key[openers] + 2 * k))
    left, right = openers[owner], member
    owner, member = _spread(np.searchsorted(key[openers], key[others] + k), np.searchsorted(key[openers], key[others] + 2 * k))
    left, right = np.concatenate([left, others[owner]]), np.concatenate([right, openers[member]])
    apart = chain[left] != chain[right]
    left, right = left[apart], right[apart]
    return place[right] - place[left], place[left]


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Runs of texts whose words are ``codes[bounds[t]:bounds[t + 1]]``: rows of (text, start, length, period), ascending."""
    found: list[tuple[int, int, int, int]] = []
    if len(codes) >= LEAST:
        grams = _Grams(codes, bounds)
        k, place = LEAST // 2, np.arange(len(codes))
        longest = int(np.diff(bounds).max())
        while True:
            short = k < SHORT_LAGS
            group, place = grams.repeated(place, k)
            if not len(place):
                break
            lags, starts = _short_seeds(group, place) if short else _long_seeds(group, place, k)
            found += _extended(codes, bounds, grams.text, lags, starts, k)
            place = np.sort(place)
            k = SHORT_LAGS if short else 2 * k
            if 2 * k > longest:
                break
    if not found:
        return np.empty((0, 4), np.int64)
    runs = np.array(found, np.int64)
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    # one stretch with several periods: the smallest one counts, the others are its multiples
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _extended(codes, bounds, text, lags, starts, k) -> list[tuple[int, int, int, int]]:
    order = np.lexsort((starts, lags))
    lags, starts = lags[order], starts[order]
    fresh = np.ones(len(lags), bool)
    # a seed that touches the one before it lies in the same row of equal pairs
    fresh[1:] = (lags[1:] != lags[:-1]) | (starts[1:] > starts[:-1] + k)
    out, furthest = [], {}
    for lag, i in zip(lags[fresh].tolist(), starts[fresh].tolist(), strict=True):
        if i < furthest.get(lag, -1):
            continue
        own = int(text[i])
        begin, end = int(bounds[own]), int(bounds[own + 1])
        upto = i + _equal(codes, i, i + lag, end - i - lag, 1)
        furthest[lag] = max(upto, i + 1)
        since = i - _equal(codes, i - 1, i - 1 + lag, i - begin, -1)
        if upto - since >= max(lag, LEAST - lag):
            out.append((own, since - begin, upto - since + lag, lag))
    return out


def collapse(runs: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` words stay: all but those of a run after its first period."""
    cover = np.zeros(count + 1, np.int64)
    np.add.at(cover, runs[:, 1] + runs[:, 3], 1)
    np.add.at(cover, runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(cover)[:-1] == 0


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of some rows at a time."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for name, text in zip(batch.column(0), batch.column(1), strict=True):
            ids.append(name)
            # bytes.split() parts at the six ASCII white space characters only
            texts.append((text.as_buffer().to_pybytes() if text.is_valid else b"").split())
            held += len(texts[-1])
            if held >= SLICE_WORDS:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def periodic_runs(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs by start and period, and its words without those that
    a run repeats, joined by one space.

    Rows are judged by themselves and keep their ids, whatever they are: null, repeated or not numeric. Null and empty texts
    have no words, no runs and an empty ``collapsed``; an empty table gives an empty result; other columns are ignored.
    One text is one unit of work, for a period may be half of it; its work grows with its words times the logarithm
    of their number, and with the length of its runs.
    """
    kind = documents.schema[doc_id].dataType
    asked = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            count = np.fromiter(map(len, texts), np.int64, len(texts))
            bounds = np.concatenate([[0], np.cumsum(count)])
            whole = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
            runs = find_runs(whole.indices.to_numpy().astype(np.int64), bounds)
            first = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
            kept = []
            for t, words in enumerate(texts):
                own = runs[first[t]:first[t + 1]]
                if len(own):
                    words = [words[i] for i in np.flatnonzero(collapse(own, len(words))).tolist()]
                kept.append(b" ".join(words))
            lists = pa.ListArray.from_arrays(
                pa.array(first, pa.int32()), pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, ids[0].type), pa.array(count), lists, pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return asked.mapInArrow(run, f"doc_id {kind.simpleString()}, n_words long, runs array<{_RUN}>, collapsed string")
