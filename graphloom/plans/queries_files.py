"""Driver queries: files, paths, identity and discovery."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from graphloom.functions import ids, paths
from graphloom.plans.catalog import REPOSITORY, query, table
from graphloom.session import shared_folder
from graphloom.sources import discovery

# Exclusion rules applied to page addresses: languages as directories.
_URL_RULES = {"directories": ("de", "fr"), "filenames": ("",), "suffixes": ("#top", "&ref=x")}
_URL_REASON_SQL = """
    with parts as (
        select page_id, regexp_replace(url, '^https?://', '') as path,
               string_split(regexp_replace(url, '^https?://', ''), '/') as p
        from pages)
    select page_id, path,
           case when list_contains(p, 'de') then 'excluded_directory:de'
                when list_contains(p, 'fr') then 'excluded_directory:fr'
                when p[-1] = '' then 'excluded_filename:'
                when ends_with(p[-1], '#top') or ends_with(p[-1], '&ref=x') then 'generated_file'
           end as reason
    from parts"""


def _url_path():
    return F.regexp_replace("url", "^https?://", "")


def _url_reason():
    return paths.exclusion_reason(paths.path_parts(F.col("path")), **_URL_RULES)


@query("""
    with f as (
        select 'corpus' as repository, source || '/' || lang || '/' || doc_id || '.txt' as path, text
        from documents)
    select sha256(repository || ':' || path) as file_id, path,
           octet_length(encode(text))::bigint as size_bytes,
           (length(text) - length(replace(text, chr(10), ''))
            + case when text <> '' and not ends_with(text, chr(10)) then 1 else 0 end)::bigint as line_count,
           sha256(text) as content_sha256
    from f""")
def file_manifest(spark, sf_dir):
    path = F.concat_ws("\\", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select(
        F.lit(REPOSITORY).alias("repository"), path.alias("path"),
        F.col("text").cast("binary").alias("content"))
    return discovery.with_identity(files).select(
        "file_id", "path", "size_bytes", F.col("line_count").cast("long").alias("line_count"),
        "content_sha256")


@query(_URL_REASON_SQL)
def path_exclusion(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", _url_path().alias("path")).withColumn(
        "reason", _url_reason())


@query(f"""
    select count(*) as all_python_files, count(*) filter (reason is null) as selected_python_files,
           count(*) filter (reason is not null) as excluded_python_files
    from ({_URL_REASON_SQL})""")
def discovery_summary(spark, sf_dir):
    listing = table(spark, sf_dir, "pages").select(_url_path().alias("path"))
    return discovery.discovery_summary(listing, _url_reason())


@query(f"select reason, count(*) as files from ({_URL_REASON_SQL}) where reason is not null group by reason")
def excluded_by_reason(spark, sf_dir):
    listing = table(spark, sf_dir, "pages").select(_url_path().alias("path"))
    return discovery.excluded_by_reason(listing, _url_reason())


@query("select regexp_replace(url, '^https?://', '') as path from pages order by string_split(path, '/')")
def path_order(spark, sf_dir):
    return discovery.in_part_order(table(spark, sf_dir, "pages").select(_url_path().alias("path")))


@query("""
    select page_id, replace(regexp_replace(url, '^https?://[^/]+', ''), 'en', '..') as path,
           (starts_with(replace(regexp_replace(url, '^https?://[^/]+', ''), 'en', '..'), '/')) as escapes_root,
           (starts_with(replace(regexp_replace(url, '^https?://[^/]+/', ''), 'en', '..'), '../')
            or replace(regexp_replace(url, '^https?://[^/]+/', ''), 'en', '..') = '..') as relative_escapes
    from pages""")
def path_guard(spark, sf_dir):
    absolute = F.regexp_replace(F.regexp_replace("url", "^https?://[^/]+", ""), "en", "..")
    relative = F.regexp_replace(F.regexp_replace("url", "^https?://[^/]+/", ""), "en", "..")
    return table(spark, sf_dir, "pages").select(
        "page_id", absolute.alias("path"), paths.escapes_root(absolute).alias("escapes_root"),
        paths.escapes_root(relative).alias("relative_escapes"))


@query("""
    select doc_id, sha256('corpus:' || doc_id || ':' || lang || ':3:0:' || text) as error_id,
           sha256('corpus:' || doc_id) as file_id
    from documents""")
def text_ids(spark, sf_dir):
    doc = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        ids.error_id(F.concat(F.lit(f"{REPOSITORY}:"), doc), F.col("lang"), F.lit(3), F.lit(0),
                     F.col("text")).alias("error_id"),
        ids.file_id(F.lit(REPOSITORY), doc).alias("file_id"))


@query(f"""
    select sha256('{REPOSITORY}:' || path) as file_id, path
    from (select source || '/' || lang || '/' || doc_id || '.txt' as path from documents)""")
def manifest_scan(spark, sf_dir):
    """A manifest of the documents as JSON lines, every third without an id and with blank lines between, read again."""
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    named = table(spark, sf_dir, "documents").select("doc_id", path.alias("path")).withColumn(
        "file_id", F.when(F.col("doc_id") % 3 > 0, ids.file_id(F.lit(REPOSITORY), F.col("path"))))
    line = F.concat(F.to_json(F.struct("file_id", "path")), F.when(F.col("doc_id") % 5 == 0, "\n  \n").otherwise(""))
    target = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    named.select(line.alias("value")).write.text(target)
    return discovery.read_manifest(spark, target, REPOSITORY)
