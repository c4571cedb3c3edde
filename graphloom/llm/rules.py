"""Quality rules: per-text rules, and verdicts on hosts whose texts fail them too often.

A host's failure rate rests on few texts or on many, so it is shrunk towards the rate of all hosts by a beta prior
whose two parameters come from the spread of the hosts' own rates (moments). A host whose shrunk rate is above the
limit is rejected with all of its texts. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.llm.common import materialise

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
HOST_LIMIT = 0.75
SPACE = "\x20\x09\x0A\x0B\x0C\x0D"
SYMBOLS = "#*$%&|<>"


def measures(documents: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every whole text.

    Windows are compared by 64-bit hashes within their text. Positions in repeated windows come from the windows
    sorted by hash, and only texts that have some sort theirs.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = documents.select(*[c.alias(n) for n, c in keep.items()], whole.alias("text")).withColumn(
        "words", F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
    lines = split.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("words")
    window = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]))
    counted = lines.select(
        *keep, n.cast("long").alias("n_words"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.translate("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, window).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    ordered = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    sorted_ = counted.withColumn("ordered", F.when(some, ordered))
    around = lambda i: F.get("ordered", i)["h"]
    twice = F.transform(F.filter("ordered", lambda x, i: (x["h"] == around(i + 1)) | F.when(i > 0, x["h"] == around(i - 1)).otherwise(F.lit(False))),
                        lambda x: x["i"])
    placed = sorted_.withColumn("places", F.sort_array(twice)).drop("ordered", "windows")
    reach = F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - p, F.lit(WINDOW))))
    repeated = F.coalesce(F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    return placed.withColumn("n_repeat_words", repeated.cast("long")).drop("places")


def failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def host_verdicts(rows: DataFrame, host: str, fails: Column, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, rejected), one row a host; rows are summed by host before they are sent."""
    hosts = rows.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(fails.cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    spread = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    # the beta distribution with the mean and variance of the hosts' rates; without spread, as weak as one text
    strength = F.when((F.col("v") > 0) & (F.col("m") * (1 - F.col("m")) > F.col("v")),
                      F.col("m") * (1 - F.col("m")) / F.col("v") - 1).otherwise(F.lit(1.0))
    prior = spread.select((F.col("m") * strength).alias("alpha"), ((1 - F.col("m")) * strength).alias("beta"))
    shrunk = (F.col("n_failed") + F.col("alpha")) / (F.col("n_docs") + F.col("alpha") + F.col("beta"))
    # the prior is one row
    return (hosts.join(F.broadcast(prior)).withColumn("shrunk_rate", shrunk)
            .withColumn("rejected", F.col("shrunk_rate") > limit).drop("alpha", "beta"))


def judge(documents: DataFrame, host: Column, doc_id: str = "doc_id", text: str = "text", limit: float = HOST_LIMIT) -> DataFrame:
    """Per document row: doc_id, host, the measures, base_failed, shrunk_rate of its host, kept.

    ``kept`` is false if the text fails a rule or its host is rejected. Null and empty texts have no words and fail; a
    null host is a host of its own; rows with equal ids are rows of their own; an empty table gives an empty result.
    """
    rows = materialise(measures(documents, text, {"doc_id": F.col(doc_id), "host": host})
                       .withColumn("base_failed", failed()), "measures")
    verdicts = host_verdicts(rows, "host", F.col("base_failed"), limit).select(F.col("host").alias("__host"), "shrunk_rate", "rejected")
    return (rows.join(verdicts, F.col("host").eqNullSafe(F.col("__host")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~F.col("rejected")).drop("__host", "rejected"))
