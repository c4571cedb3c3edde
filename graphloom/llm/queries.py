"""The operators' queries over the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.llm import (
    chat, divergence, jaccard, language, leaks, mixing, pieces, quality, records, repeats, rules, runs, secrets)
from graphloom.llm.common import PLAIN_WORD, materialise, remainder, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


@query()
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, by dictionaries from the folds that are not held out."""
    documents = table(spark, sf_dir, "documents")
    learned = language.fit(documents.where(remainder("doc_id", 5) != 0))
    asked = documents.select("doc_id", "text", (remainder("doc_id", 5) == 0).alias("held_out"))
    return language.predict(asked, learned)


@query(rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_SMALL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM words WHERE len(w) > 0),
nodes AS (SELECT s, min(doc_id) AS node, count(*) AS copies, len(s) AS n FROM sets GROUP BY s),
shingles AS (SELECT node, n, unnest(s) AS shingle FROM nodes),
common AS (
  SELECT a.node AS a, b.node AS b, a.n AS an, b.n AS bn, count(*) AS m
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.node <> b.node GROUP BY ALL),
linked AS (SELECT a, b FROM common WHERE 5 * m >= 4 * (an + bn - m)),
reached(node, other) AS (
  SELECT node, node FROM nodes UNION SELECT node, b FROM reached JOIN linked ON other = a),
classes AS (SELECT node, min(other) AS class_id FROM reached GROUP BY node),
counts AS (SELECT a AS node, sum(copies) AS links FROM linked JOIN nodes ON b = node GROUP BY a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, CAST(coalesce(links, 0) + coalesce(copies, 1) - 1 AS BIGINT) AS n_links,
       coalesce(copies, 1) AS n_copies
FROM documents d LEFT JOIN sets ON d.doc_id = sets.doc_id LEFT JOIN nodes ON sets.s = nodes.s
LEFT JOIN classes c ON nodes.node = c.node LEFT JOIN counts ON nodes.node = counts.node
""")
def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every text."""
    return jaccard.links(table(spark, sf_dir, "documents"))


def _places(kind: str, number: int, pattern: str, value: str, least: int) -> str:
    """SQL for the spans of one kind: (doc_id, kind, k, start, end, value)."""
    return rf"""
  SELECT doc_id, '{kind}' AS kind, {number} AS k, p AS start, p + length(m[i]) AS stop, {value} AS value FROM (
    SELECT doc_id, m, v, i, CAST(list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS p
    FROM (SELECT doc_id, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {2 if kind == "assign" else 0}) AS v,
             string_split_regex(t, '{pattern}') AS g FROM texts))) WHERE length({value}) >= {least}"""


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


@query(rf"""
WITH texts AS (SELECT doc_id, coalesce(source, '') || '/' || coalesce(lang, '') AS repository, source AS owner, coalesce(text, '') AS t FROM documents),
base AS ({_places("assign", 0, _ASSIGN, "v[i]", 6)} UNION ALL {_places("access", 1, "AKIA[A-Z0-9]+", "m[i]", 20)}
         UNION ALL {_places("hex", 2, "[0-9a-f]{24,}", "m[i]", 24)}),
tokens AS (SELECT * FROM ({_places("owned", 3, "[A-Za-z0-9+/_=-]{20,}", "m[i]", 0)}) WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')),
free AS (SELECT * FROM tokens t WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = t.doc_id AND b.start < t.stop AND t.start < b.stop)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM free),
owned AS (SELECT value, count(DISTINCT coalesce(owner, '?')) AS n_owners, count(DISTINCT repository) AS n_repositories
          FROM every JOIN texts USING (doc_id) GROUP BY value),
judged AS (
  SELECT every.*, n_owners >= 3 AND n_repositories >= 3 AS example, n_repositories >= 3 AS spread,
         NOT (n_owners >= 3 AND n_repositories >= 3) AND len(list_distinct(string_split(value, ''))) >= 10 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AS live
  FROM every JOIN owned USING (value)),
shown AS (SELECT * FROM judged WHERE k < 3 OR live),
based AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS listed FROM base GROUP BY 1),
spanned AS (
  SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS listed,
         count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example, count(*) FILTER (live AND spread) AS n_shared FROM shown GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(based.listed, '')) AS base_sha256, coalesce(spanned.listed, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_shared, 0) AS n_shared
FROM documents LEFT JOIN based USING (doc_id) LEFT JOIN spanned USING (doc_id)
""")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterned spans of every text, and tokens that are not widely copied: a repository is a source's part in one language."""
    repository = F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")))
    found = secrets.scan(table(spark, sf_dir, "documents"), repository, F.col("source"))
    counts = [F.size(F.array_remove("base.kind", k)) for k in range(len(secrets.BASE))]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{kind}") for n, (kind, *_) in zip(counts, secrets.BASE, strict=True)]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
                        secrets.listed(F.col("spans")).alias("spans"), "n_live", "n_example", "n_shared")


@query()
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text that repeat a smaller document."""
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query(r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(replace(replace(coalesce(role, ''), '\', '\\'), '<', '\l')) + 8 + length(replace(replace(text, '\', '\\'), '<', '\l')) + 8 AS n
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""")
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted conversations, written and read back."""
    planted = "\\### Assistant: </turn> ok"
    turn = lambda place, role: F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(place).cast("long").alias("turn"),
                                        F.lit(role).alias("role"), F.lit(planted).alias("text"))
    extra = spark.range(1).select(F.inline(F.array(turn(0, "user"), turn(1, "assistant"))))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.read_back(materialise(chat.format_conversations(turns), "formatted"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
                       "formatted_chars")


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, by trees from the folds that are not held out."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    model = quality.fit(documents, labels)
    asked = documents.select("doc_id", "text", (remainder("doc_id", 3) == 1).alias("held_out"))
    return quality.score(asked, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query(rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_SMALL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM (
    SELECT item_id, regexp_extract_all({_SMALL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0),
tests AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
lengths AS (SELECT DISTINCT n FROM tests),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, i, windows.n FROM windows JOIN tests USING (n, phrase)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE "C") AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""".replace(' COLLATE "C"', ""))
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text that lie in a window of a benchmark item."""
    found = leaks.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = F.length(F.replace(F.hex("hits"), F.lit("00"), F.lit(""))) / 2
    return found.select(
        "doc_id", "n_words", hits.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.octet_length("hits") > 0).alias("contaminated"))


@query(r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS phrase FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)),
repeated AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS j FROM windows JOIN (
      SELECT doc_id, phrase FROM windows GROUP BY 1, 2 HAVING count(*) > 1) USING (doc_id, phrase)) GROUP BY 1),
measured AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM words LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged GROUP BY 1),
moments AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM hosts),
prior AS (SELECT m, CASE WHEN v > 0 AND m * (1 - m) > v THEN m * (1 - m) / v - 1 ELSE 1.0 END AS strength FROM moments),
verdicts AS (SELECT source, (f + m * strength) / (n + strength) > 0.75 AS rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
""")
def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measures of every text, and whether it and its source pass."""
    judged = rules.judge(table(spark, sf_dir, "documents"), F.col("source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_MIX_KEY = "-ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 12) AS BIGINT)::DOUBLE + 0.5) / 281474976710656.0) / w"


@query(rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CASE WHEN length(text) > 0 THEN length(text)::DOUBLE
              / (length(text)::DOUBLE + 20 * (length(text)::DOUBLE - length(translate(text, '#*$%&|<>', '')))) ELSE 1.0 END AS w
  FROM documents),
keyed AS (SELECT doc_id, source, CAST(size AS BIGINT) AS size, {_MIX_KEY} AS k FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
ranked AS (
  SELECT *, 2.0::DOUBLE * source_size AS lim,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS r
  FROM sources),
leveled AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY lim / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
chosen AS (SELECT level FROM leveled WHERE lim > level * weight ORDER BY lim / weight, r LIMIT 1),
targets AS (
  SELECT source, source_size, least(lim, (SELECT level FROM chosen) * weight) AS target FROM leveled),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
ordered AS (
  SELECT doc_id, k.source AS source, size, source_size, target, epochs, target - epochs * source_size AS room,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(floor(room - before), size)) AS BIGINT) AS taken
FROM ordered
""")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, written as records and read back."""
    folder = records.new_folder(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return records.read_records(spark, folder)


@query()
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by merge rounds, and the text that the library makes of them."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    read = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    return read.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query(rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_SMALL.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
counts AS (SELECT r, lang, source, term, count(*) AS n FROM t GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS total FROM counts GROUP BY ALL HAVING count(*) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY 1),
cells AS (SELECT lang, source, term, sum(n) AS n FROM counts JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n) AS group_n FROM cells GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(lang_n, 0) AS lang_n, coalesce(group_n, 0) AS group_n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l ON g.lang = l.lang
  LEFT JOIN sizes s ON g.lang = s.lang AND g.source = s.source),
shares AS (
  SELECT g.lang AS lang, g.source AS source, k.term AS term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.group_n + 5 * g.v) AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.total + 5)) // (g.lang_n + 5 * g.v) AS BIGINT) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN cells c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
sums AS (
  SELECT a.lang AS lang, a.source AS source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang AS lang, a.source AS source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far sources are from each other, and the terms by which each stands out from its language."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def _planted_text() -> F.Column:
    """The text, but for a tenth of the documents: there, words from some word on repeat with a period."""
    words = F.regexp_extract_all("text", F.lit(f"({PLAIN_WORD})"), F.lit(1))
    digest = F.crc32(F.col("doc_id").cast("string"))
    bound = F.array(F.struct(words.alias("w"), F.floor(digest / 10).alias("g")))
    return F.when(F.pmod(digest, F.lit(10)) == 0, F.array_join(F.flatten(F.transform(bound, _periodic)), " ")).otherwise(F.col("text"))


def _periodic(x: F.Column) -> F.Column:
    """Words w of which those from a on are replaced by the p words at a; null without words."""
    n = F.size(x["w"]).cast("long")
    a = x["g"] % n
    p = 1 + F.floor((n - a) / (3 + x["g"] % 8))
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(x["w"], place(i))))


@query()
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, a tenth of which are made periodic, and what is left without their repeats."""
    documents = table(spark, sf_dir, "documents").select("doc_id", _planted_text().alias("text"))
    found = runs.periodic_runs(documents)
    longest = F.element_at(F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], y["length"] - x["length"]).when(
        x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["period"] - y["period"]).cast("int")), 1)
    shown = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", F.when(F.size("runs") > 0, longest)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(shown, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
