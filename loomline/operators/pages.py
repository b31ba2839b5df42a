"""Markdown pages: their headers in many layouts, blocks, tags and irregularities.

Every field is found by its own line-anchored expression, so a header whose comment is closed
wrongly, wrapped in a fence or an element, or split into one comment a line is read alike; a header
that is one line of JSON is the fallback. All of it is one projection within the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import FENCE_LANGUAGES

# The keys of a page header.
HEADER_KEYS = ("source", "domain", "task", "language", "source_filename", "document_name", "page_number", "page_id", "product", "version", "timestamp", "fidelity")


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def _field_lines(text: Column) -> Column:
    """The lines and JSON members of a page that may hold a header field, found in one reading of the page."""
    names = "|".join(HEADER_KEYS)
    lines = F.regexp_extract_all(text, F.lit(rf"(?m)^[^\S\n]*(?:<!--[^\S\n]*)?(?:{names}):.*$"), F.lit(0))
    members = F.regexp_extract_all(text, F.lit(rf'"(?:{names})"\s*:\s*"[^"\n]*"'), F.lit(0))
    return F.array_join(F.concat(lines, members), "\n")


def _field(lines: Column, key: str) -> Column:
    """The first value of ``key`` among :func:`_field_lines` without outer blanks, null where there is none or a blank one."""
    line = F.regexp_extract(lines, rf"(?m)^[^\S\n]*(?:<!--[^\S\n]*)?{key}:[^\S\n]*(.*?)[^\S\n]*(?:-->)?[^\S\n]*$", 1)
    json = F.regexp_extract(lines, rf'"{key}"\s*:\s*"([^"\n]*)"', 1)
    return F.coalesce(*[F.when(F.trim(v) != "", F.trim(v)) for v in (line, json)])


def header(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the twelve header fields as text, and ``page`` as a number; nulls where a page lacks a field or has no text."""
    own = df.select(key, _field_lines(unix_lines(F.col(text))).alias("lines"))
    out = own.select(key, *[_field(F.col("lines"), k).alias("ts" if k == "timestamp" else k) for k in HEADER_KEYS])
    return out.withColumn("page", F.expr("try_cast(page_number AS INT)"))


def normalised_headers(df: DataFrame) -> DataFrame:
    """Rows of header fields with unified spellings: lower-case language without remark, hyphenated document names, numeric pages, real times. One row a ``page_id``."""
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    language = F.regexp_extract(F.lower(F.col("language")), r"^\s*([a-z]{2})", 1)
    when = F.coalesce(*[F.try_to_timestamp(blank(F.col("ts")), F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm", "dd.MM.yyyy HH:mm", "yyyy-MM-dd")])
    out = df.select(
        blank(F.col("page_id")).alias("page_id"), F.when(language != "", language).alias("language"), F.regexp_replace(F.lower(blank(F.col("document_name"))), r"[\s_]+", "-").alias("document_name"),
        F.expr("try_cast(trim(page_number) AS INT)").alias("page"), blank(F.col("version")).alias("version"), when.alias("made_at"),
    )
    return out.where("page_id is not null").groupBy("page_id").agg(*[F.max(c).alias(c) for c in ("language", "document_name", "page", "version", "made_at")])


def block_stats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and counts of headings, fence marks, table rows, list items, images, and whether the fences are unbalanced."""
    t = unix_lines(F.coalesce(F.col(text), F.lit("")))
    count = lambda p: F.regexp_count(F.col("t"), F.lit(p)).cast("bigint")
    own = df.select(key, t.alias("t"))
    fences = count(r"(?m)^[ \t]*```")
    return own.select(
        key, count(r"(?m)^#{1,6}[ \t]+\S").alias("n_headings"), fences.alias("n_fences"), count(r"(?m)^[ \t]*\|.*\|[ \t]*$").alias("n_table_rows"),
        count(r"(?m)^[ \t]*(?:[-*+]|\d+[.)])[ \t]+\S").alias("n_list_items"), count(r"!\[[^\]\n]*\]\(").alias("n_images"), (fences % 2 == 1).alias("unbalanced"),
    )


def blocks(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, line, kind, level, content``: the headings, fences, table rows, list items and images of each page by line from 0."""
    lines = df.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(unix_lines(F.col(text)), "\n")).alias("line", "content"))
    kind = (
        F.when(F.col("content").rlike(r"^#{1,6}\s+\S"), "heading").when(F.col("content").rlike(r"^\s*```"), "fence").when(F.col("content").rlike(r"^\s*\|.*\|\s*$"), "table_row")
        .when(F.col("content").rlike(r"!\[[^\]]*\]\("), "image").when(F.col("content").rlike(r"^\s*(?:[-*+]|\d+[.)])\s+\S"), "list_item")
    )
    level = F.when(F.col("kind") == "heading", F.length(F.regexp_extract("content", r"^(#{1,6})", 1)))
    return lines.withColumn("kind", kind).where("kind is not null").select(key, "line", "kind", level.alias("level"), "content")


def fence_languages(df: DataFrame, text: str = "text") -> DataFrame:
    """``language, n_fences``: the languages of code fences by their unified name; openers without language are left out."""
    found = df.select(F.explode(F.regexp_extract_all(unix_lines(F.col(text)), F.lit(r"(?m)^[ \t]*```[ \t]*([A-Za-z][\w#+.-]*)[ \t]*$"), F.lit(1))).alias("l"))
    low = F.lower("l")
    name = low
    for spelling, canonical in FENCE_LANGUAGES.items():
        name = F.when(low == spelling, canonical).otherwise(name)
    return found.groupBy(name.alias("language")).agg(F.count("*").alias("n_fences"))


def tags(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, tag``: the distinct tags of all tags comments of a page, bracketed or plain, on one line or several."""
    comments = F.regexp_extract_all(unix_lines(F.col(text)), F.lit(r"<!--\s*tags:\s*\[?([^\]]*?)\]?\s*(?:keywords:|-->)"), F.lit(1))
    parts = F.array_distinct(F.filter(F.transform(F.split(F.array_join(comments, "\n"), r"[,\n]"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != ""))
    return df.where(F.col(text).isNotNull()).select(key, F.explode(parts).alias("tag"))


def irregularities(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: pages with each of the irregularities a parser must survive."""
    t = F.coalesce(F.col(text), F.lit(""))
    fences = F.regexp_count(t, F.lit(r"(?m)^[ \t]*```"))
    return df.agg(
        F.count("*").alias("n_pages"), F.count_if(F.contains(t, F.lit("\r"))).alias("n_carriage_returns"), F.count_if(fences % 2 == 1).alias("n_unbalanced"),
        F.count_if(F.contains(t, F.lit("�"))).alias("n_replacement"), F.count_if(t.rlike(r"(?i)\[unclear\]")).alias("n_unclear"),
        F.count_if(F.contains(F.lower(t), F.lit("example.com"))).alias("n_example_links"), F.count_if(F.contains(F.lower(t), F.lit("all rights"))).alias("n_footers"),
        F.count_if(~t.rlike(r"page_id")).alias("n_without_page_id"),
    )


def section_of(path: Column) -> Column:
    """The directory of ``.../<section>/page_<digits>.md``."""
    return F.regexp_extract(path, r"([^/]+)/page_\d+\.md$", 1)


def page_of(path: Column) -> Column:
    """The page number in a path; numbers of three or four digits sort as numbers."""
    return F.regexp_extract(path, r"page_(\d+)\.md$", 1).try_cast("int")
