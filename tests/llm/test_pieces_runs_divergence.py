"""Operators 11 to 13 against the library, against sums over all pairs and against a search over all periods."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from graphloom.llm import divergence, pieces, queries, runs

SF_DIR = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
CLASHING = "doc_id long, text string, lang string, source string, n int, docs int, term string, ids int, decoded string, runs int"
RANDOM = random.Random(11)


def clashing(rows):
    return [(*r, 1, 2, "x", 3, "y", 4) for r in rows]


TEXTS = [None, "", " ", "  \n\t ", "one", "aaaa" * 90, "é" * 70, "▁ ▁x", "x\x00y", "🙂 日本語のテキスト", "a  b   c    d",
         "one two three " * 30, "x " * 400, "un deux " * 7 + "trois", " ".join(map(str, range(3000)))]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(TEXTS)]
    rows += [rows[11], rows[11], (None, "one two three four", None, None), (None, None, "en", "s1")]
    return spark.createDataFrame(clashing(rows), CLASHING).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], CLASHING)


# --- 11 --------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def odd_text(rng, vocabulary):
    kind = rng.randrange(7)
    if kind == 0:
        return "".join(rng.choice("ab ") for _ in range(rng.randint(0, 60)))
    if kind == 1:
        return "".join(chr(rng.choice([rng.randint(0, 127), rng.randint(0, 0xD7FF), rng.randint(0x10000, 0x10FFFF)])) for _ in range(50))
    if kind == 2:
        return "".join(rng.choice(vocabulary) for _ in range(60))
    if kind == 3:
        return rng.choice("aeiox= -▁n0あ") * rng.randint(1, 300)
    if kind == 4:
        return "".join(rng.choice("aeinrst") for _ in range(200))
    if kind == 5:
        return "".join(rng.choice(vocabulary).strip() for _ in range(3)) * rng.randint(1, 20)
    return "  ".join("".join(rng.choice(vocabulary).strip() for _ in range(rng.randint(1, 5))) for _ in range(30))


@pytest.mark.parametrize("limit", [1 << 20, 200])
def test_merge_rounds_give_the_ids_of_the_library(library, monkeypatch, limit):
    monkeypatch.setattr(pieces, "SLICE_BYTES", limit)
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    texts = [odd_text(random.Random(i), vocabulary) for i in range(1500)] + [t for t in TEXTS if t is not None]
    got = [ids.tolist() for ids in pieces.Pieces(MODEL).encode(pa.array([*texts, None]))]
    assert got == [*library.encode(texts), []]


def test_a_piece_that_merges_again_at_once_is_merged_from_the_left_only():
    """ab ranks after aba: ababa is aba + b + a one merge at a time, where merging both ab first would give ab + aba."""
    table = pieces.Pieces.__new__(pieces.Pieces)
    names = ["a", "b", "ab", "aba"]
    table.many, table.outside, table.other = 5, 4, 4
    table.of_char = np.full(0x110000, 4, np.int32)
    table.of_char[[97, 98]] = 0, 1
    table.beside = np.array(sorted([97 << 21 | 98, 98 << 21 | 97]))
    pairs = {0 * 5 + 1: (7, 2), 2 * 5 + 0: (3, 3)}
    table.keys = np.array(sorted(pairs))
    table.ranks = np.array([pairs[k][0] for k in sorted(pairs)], np.int32)
    table.merged = np.array([pairs[k][1] for k in sorted(pairs)], np.int32)
    table.hasty = np.array([False, False, True, False, False])
    ids, bounds = table.merge(np.frombuffer("ababa".encode("utf-32-le"), np.uint32).astype(np.int64), np.array([0]))
    assert [names[i] for i in ids] == ["aba", "b", "a"] and bounds.tolist() == [0, 3]


def test_sentencepiece_query(spark, library, edges, nothing):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    for row in queries.op11_sentencepiece(spark, SF_DIR).collect():
        ids = library.encode(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    got = pieces.decode(pieces.encode(edges, MODEL), MODEL).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter(
        (r.doc_id, tuple(library.encode(r.text or "")), library.decode(library.encode(r.text or ""))) for r in edges.collect())
    assert pieces.decode(pieces.encode(nothing, MODEL), MODEL).count() == 0


# --- 12 --------------------------------------------------------------------------------------------------------------

def plain_divergence(rows, least, top):
    """Every pair of sources over every kept term."""
    rows = [(lang or "", source or "", re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        documents, every = Counter(), Counter()
        for _, _, terms in mine:
            documents.update(set(terms))
            every.update(terms)
        kept = [t for t in every if documents[t] >= least]
        groups = {s: Counter() for _, s, _ in mine}
        for _, source, terms in mine:
            groups[source].update(t for t in terms if documents[t] >= least)

        def shares(counts):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        whole, of = shares(every), {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, of[s][t] - whole[t]) for t in kept if groups[s][t] and of[s][t] > whole[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:limit])]
    return Counter(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence(spark, monkeypatch, seed):
    monkeypatch.setattr(divergence, "PAIRS", 7)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 300)
    rng = random.Random(seed)
    words = ["the", "The", "ab", "é", "ß1", "xyz", "q", "日本", "and", "or", "rare"]
    rows = [(rng.choice(["en", "de", None, "", "xx"]), rng.choice(["a", "b", "ä", None, "c", "only"]),
             rng.choice([None, "", "12", " ".join(rng.choices(words, [9, 1, 5, 3, 2, 2, 1, 4, 7, 6, 1], k=rng.randint(0, 30)))])) for _ in range(300)]
    rows += [("zz", "a", "one word"), ("zz", "b", None), ("y", "alone", "one")]
    frame = spark.createDataFrame(clashing([(None, t, lang, s) for lang, s, t in rows]), CLASHING).repartition(5)
    got = Counter(map(tuple, divergence.divergence(frame, least_documents=6, top_terms=4).collect()))
    assert got == plain_divergence(rows, 6, 4)


def test_divergence_shares_paths():
    """Equal beginnings are one node: three rows below it give one sum with their number."""
    cell = lambda no, n: {"no": no, "n": n, "p": 10 * n, "floor": 1}
    rows = [[cell(0, 1), cell(1, 2)], [cell(0, 1), cell(1, 2), cell(2, 5)], [cell(0, 1), cell(1, 2), cell(2, 6)], [cell(0, 2)]]
    kind = pa.list_(pa.struct([("no", pa.int32()), ("n", pa.int64()), ("p", pa.int64()), ("floor", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 4), pa.array(rows, kind), pa.array([1, 2, 1, 9])], names=["lang", "row", "many"])
    (out,) = divergence.tree(iter([batch]))
    got = {(r["a"], r["b"]): r["value"] for r in out.to_pylist()}
    value = lambda x, y: abs(x - y) - abs(x - 1) - abs(1 - y)
    assert got == {(0, 1): 4 * value(10, 20), (0, 2): 2 * value(10, 50) + value(10, 60), (1, 2): 2 * value(20, 50) + value(20, 60)}


def test_divergence_of_nothing(edges, nothing):
    assert divergence.divergence(nothing).count() == 0
    assert divergence.divergence(edges).where("part = 'pair' and value <> 0").count() == 0


# --- 13 --------------------------------------------------------------------------------------------------------------

def plain_runs(words):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(12, 2 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def odd_words(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 200))]
    if kind == 1:
        a = rng.randint(1, 20)
        return [0, 1] * a + [1, 0] * a + [rng.randrange(3) for _ in range(9)] + [0] * rng.randint(0, 40)
    out = []
    while len(out) < 150:
        out += [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randint(1, 40))] * rng.randint(1, 5)
        out = out[:len(out) - rng.randint(0, 3)]
        if kind == 3 and out:
            at = rng.randrange(len(out))
            out += out[at:at + rng.randint(1, 60)] * rng.randint(1, 2)
    return out[:400]


def test_runs_of_all_periods():
    rng = random.Random(7)
    for _ in range(300):
        texts = [odd_words(rng) for _ in range(rng.randint(1, 6))]
        got = runs.find_runs(np.array([w for t in texts for w in t], np.int64), np.cumsum([0, *map(len, texts)]))
        for t, words in enumerate(texts):
            assert [tuple(r[1:]) for r in got[got[:, 0] == t].tolist()] == plain_runs(words)


def test_seeds_do_not_grow_with_the_square():
    count = 20_000
    for words in ([0] * count, [0, 1] * (count // 2), [*range(50)] * (count // 50)):
        codes = np.array(words)
        grams, place, k = runs._Grams(codes, np.array([0, count])), np.arange(count), 8
        while k < count // 2:
            group, place = grams.repeated(place, k)
            if not len(place):
                break
            assert len(runs._long_seeds(group, place, k)[0]) <= 12 * count
            k *= 2
            place = np.sort(place)


def plain_result(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    digest = zlib.crc32(str(doc_id).encode())
    n, g = len(words), digest // 10
    if digest % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_runs_query(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r) for r in queries.op13_runs(spark, SF_DIR).collect()}
    short = [r for r in documents if len(r.text or "") < 9000]
    assert len(got) == len(documents) and len(short) > 100
    for doc_id, text in short:
        assert got[doc_id] == plain_result(doc_id, text)


def test_runs_of_odd_rows(edges, nothing, monkeypatch):
    monkeypatch.setattr(runs, "SLICE_WORDS", 50)
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in runs.periodic_runs(edges).collect())
    expected = Counter()
    for r in edges.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        found = plain_runs(words) if len(words) < 2000 else []
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        expected[r.doc_id, len(words), tuple(found), " ".join(w for i, w in enumerate(words) if i not in dropped)] += 1
    assert got == expected
    assert runs.periodic_runs(nothing).count() == 0
