"""The stages of the corpus pipeline, each against a plain version on what the stage before it kept."""

import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from graphloom.llm.common import materialise
from tests.llm.test_operators import SF_DIR, plain_classes, plain_words


def test_stages(spark):
    from tokenizers import Tokenizer

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]

    def apply(name, docs):
        out = materialise(stage[name](spark, docs, SF_DIR), "stage")
        rows = {r["doc_id"]: r["text"] for r in out.collect()} if "text" in out.columns else None
        return out, rows

    before = {r["doc_id"]: r["text"] for r in documents.collect()}
    docs, kept = apply("quality classifier", documents)
    assert docs.columns == documents.columns and kept.items() <= before.items()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality is not null")
    good = labels.select("doc_id", "quality", F.col("doc_id").isin(list(kept)).cast("int").alias("kept"))
    assert good.agg(F.avg((F.col("quality") == F.col("kept")).cast("int"))).first()[0] > 0.9

    rows = sorted(kept.items())
    docs, kept = apply("n-gram Jaccard join", docs)
    assert sorted(kept) == sorted({c for _, c, _ in plain_classes(rows)})

    windows = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = plain_words(r["text"])
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def clean(text):
        w = plain_words(text)
        return not any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    wanted = sorted(i for i, t in kept.items() if clean(t))
    docs, kept = apply("benchmark decontamination", docs)
    assert sorted(kept) == wanted

    docs, mixed = apply("mixing sources to target weights", docs)
    words, sources = {}, {}
    for r in docs.collect():
        n = len(r["text"].split())
        words[r["source"]] = words.get(r["source"], 0) + n
        sources[r["source"]] = max(sources.get(r["source"], 0), n)
    assert mixed.items() <= kept.items() and set(docs.groupBy("doc_id").count().agg(F.max("count")).first()) <= {1, 2}

    got = stage["token-ID / binary output"](spark, docs, SF_DIR).orderBy("start").collect()
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for row, (key, text) in zip(got, sorted((r["doc_id"], r["text"]) for r in docs.collect()), strict=True):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert tuple(row) == (key, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
