"""A training corpus from ``documents``: quality, near duplicates, test leaks, mixing, token records.

Each stage takes (spark, docs, sf_dir) and gives the documents that it keeps, with the columns of ``documents``; the last
gives what its record files hold. ``run`` writes each stage's rows as Parquet in the shared folder and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.llm import jaccard, leaks, mixing, quality, records
from graphloom.llm.common import materialise, remainder, table

#: The stages train a classifier and sample by digests of ids; SQL cannot express that.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    model = quality.fit(docs, labels)
    return quality.keep(docs, model)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return leaks.remove_documents(docs, leaks.contamination(docs, table(spark, sf_dir, "benchmark")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the record files of the corpus hold: doc_id, start, n_tokens, ids_crc32."""
    folder = records.new_folder(spark, "records")
    records.write_records(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return records.read_records(spark, folder)


STAGES = [
    ("quality classifier", classify), ("n-gram Jaccard join", deduplicate), ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix), ("token-ID / binary output", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.split(" ")[0].strip(","))
    return docs
