"""Secret scans: patterned and free-standing credentials, told apart by who else has them.

Every text gives its patterned spans (assignments, access keys, hexadecimal keys) and its long mixed tokens. The digests
of all their values are counted by distinct repositories and owners. A value that several owners have is a copied
example; a long token that one or two owners have, and that looks random enough, is added as a span of kind
``owned``. Patterned spans always stay. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.llm.common import materialise

#: Fixed patterns: kind, pattern, group of the value, least length of the value in characters.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
OWNED = "owned"
KINDS = (*(kind for kind, *_ in BASE), OWNED)
#: A value of this many owners is an example.
EXAMPLE_OWNERS = 3
#: A value of fewer owners in at least this many repositories is a key that its owner shares between them.
EXAMPLE_REPOSITORIES = 3
#: A token looks live with this many different characters, a digit and a letter.
LIVE_CHARACTERS = 10


def _spans(text: str, matches: str, values: str, kind: str, pattern: str, least: int) -> Column:
    """array<struct<start, kind, end, value>> in code points, from what lies between the matches."""
    gaps = F.transform(F.split(F.col(text), pattern, -1), F.length)
    sizes = F.transform(F.col(matches), F.length)
    steps = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), sizes.alias("size"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(steps, state, lambda s, x: F.struct(
        (s["at"] + x["gap"] + x["size"]).alias("at"),
        F.concat(s["starts"], F.array(s["at"] + x["gap"])).alias("starts")))["starts"]
    found = F.transform(F.arrays_zip(starts.alias("start"), sizes.alias("size"), F.col(values).alias("value")), lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (x["start"] + x["size"]).alias("end"),
        x["value"].alias("value")))
    kept = F.filter(found, lambda s: F.length(s["value"]) >= least)
    return F.when(F.size(matches) > 0, kept).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))


def _digested(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.unhex(F.sha2(s["value"], 256)).alias("digest"),
        ((F.size(F.array_distinct(F.split(s["value"], ""))) >= LIVE_CHARACTERS)
         & s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")).alias("live")))


def listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(documents: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    """One row a document: ``keep``, ``base`` spans and free-standing ``tokens``, both with digests of their values."""
    scanned = documents.select(*[c.alias(n) for n, c in keep.items()], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    for kind, pattern, group, _ in (*BASE, (OWNED, TOKEN, 0, 0)):
        scanned = scanned.withColumn(f"m_{kind}", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        if group:
            scanned = scanned.withColumn(f"v_{kind}", F.regexp_extract_all("text", F.lit(pattern), F.lit(group)))
    base = F.array_sort(F.concat(*[
        _spans("text", f"m_{k}", f"v_{k}" if g else f"m_{k}", k, p, n) for k, p, g, n in BASE]))
    tokens = F.filter(_spans("text", f"m_{OWNED}", f"m_{OWNED}", OWNED, TOKEN, 0),
                      lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return scanned.select(*keep, _digested(base).alias("base"), _digested(tokens).alias("tokens"))


def ownership(found: DataFrame) -> DataFrame:
    """(digest, n_repositories, n_owners) from rows (digest, repository, owner); null is a repository or owner too."""
    return (found.select("digest", "owner", "repository").distinct()
            .groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("digest").agg(F.sum("n").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")))


def scan(documents: DataFrame, repository: Column, owner: Column, doc_id: str = "doc_id", text: str = "text",
         example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """(doc_id, base, spans, n_live, n_example, n_shared) per document row; spans are structs of start, kind and end.

    ``spans`` are the patterned spans and owner-specific tokens that overlap none of them, by start and kind.
    ``n_example`` counts spans whose value at least ``example_owners`` owners have in at least ``example_repositories``
    repositories, ``n_live`` the others that look random, and ``n_shared`` those of them that fewer owners have in as many
    repositories: one key in several places. Null texts are empty and have no spans; rows with equal ids are rows of their own; an empty table gives an
    empty result. Other columns are ignored.
    """
    rows = materialise(candidates(documents, text, {
        "row": F.monotonically_increasing_id(), "doc_id": F.col(doc_id), "repository": repository, "owner": owner}), "candidates")
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    every = (rows.select("row", "repository", "owner", F.explode(F.concat("base", free)).alias("s"))
             .select("row", "repository", "owner", "s.*"))
    judged = every.join(ownership(every), "digest")
    spread = F.col("n_repositories") >= example_repositories
    example = (F.col("n_owners") >= example_owners) & spread
    added = (F.col("kind") == KINDS.index(OWNED)) & ~example & F.col("live")
    shown = (F.col("kind") != KINDS.index(OWNED)) | added
    by_row = judged.where(shown).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"),
        F.sum(example.cast("long")).alias("n_example"),
        F.sum((~example & F.col("live")).cast("long")).alias("n_live"),
        F.sum((~example & F.col("live") & spread).cast("long")).alias("n_shared"))
    plain = F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return rows.join(by_row, "row", "left").select(
        "doc_id", plain.cast("array<struct<start:int,kind:int,end:int>>").alias("base"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("spans"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_example", "n_shared")))


def masked(documents: DataFrame, spans: str, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``documents`` with the spans of a column cut out of the texts and ``mark`` in their places."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(F.col(spans), state, lambda s, x: F.when(x["start"] >= s["at"], F.struct(
        x["end"].alias("at"), F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, x["start"] - s["at"]), F.lit(mark)).alias("out")))
        .otherwise(F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out"))))
    rest = F.concat(done["out"], F.substring(F.col(text), done["at"] + 1, F.length(F.col(text))))
    return documents.withColumn(text, F.when(F.size(spans) > 0, rest).otherwise(F.col(text)))
