"""Site-relative line frequency: lines on a large share of a host's pages are boilerplate.

For every host and line the pages that hold the line are counted, and divided by
the pages of the host.  Lines are counted by a 128-bit hash, so texts are not
shuffled.  A host with lines of A per page on average has at most A / ratio lines above the ratio,
so its list of boilerplate lines is small whatever the size of the host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.staging import stage

RATIO = 0.1
MIN_PAGES = 3


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; empty for a text that is none, NULL for NULL."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def visible_text(html: Column) -> Column:
    """Text of a page with a line per block: no comments, scripts, styles or tags."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?is)<(?:script|style)\b.*?</(?:script|style)\s*>", "")
    out = F.regexp_replace(out, r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"<[^>]*>", "")
    return F.regexp_replace(out, r"[ \t\r]*\n[ \t\r\n]*", "\n")


def _has_word(line: Column) -> Column:
    """Reads a line only up to its first visible character."""
    return F.ltrim(line, F.lit(" \t\r\x0b\x0c")) != ""


def _hash(line: Column) -> Column:
    """128 bits of a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(lines: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """host and hashes of its boilerplate lines, from rows of host and lines; pages of one text count once with ``copies_once``."""
    hashes = F.transform(F.filter(F.array_distinct("lines"), _has_word), _hash)
    if copies_once:
        lines = lines.select("host", _hash(F.array_join("lines", "\n")).alias("text"), hashes.alias("hashes")).groupBy("host", "text").agg(F.first("hashes").alias("hashes"))
        lines, hashes = stage(lines, "texts"), F.col("hashes")
    each = lines.select("host", F.explode(hashes).alias("line"))
    counts = stage(each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages), "lines")
    totals = stage(lines.groupBy("host").agg(F.count("*").alias("pages")), "hosts").withColumnRenamed("host", "same_host")
    found = counts.join(totals, F.col("host").eqNullSafe(F.col("same_host"))).where(F.col("n") > ratio * F.col("pages"))
    return stage(found.groupBy("host").agg(F.collect_list("line").alias("dropped")), "boilerplate")


def drop_boilerplate(
    pages: DataFrame,
    host: Column,
    text: Column,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    copies_once: bool = False,
    name: str = "cleaned",
) -> DataFrame:
    """All columns of ``pages`` and a last column ``name`` = (text, n_lines, n_dropped); ``pages`` must not have a column of that name.

    Lines are cut at \\n and compared whole; those without a visible character are neither counted nor dropped.
    A line is dropped if more than ``ratio`` of the pages of its host, and at least ``min_pages``, hold
    it.  A page counts once per line; repeated rows are pages of their own, but with ``copies_once`` all pages of a host with
    the same text are one page, so copies do not make their lines boilerplate.  NULL texts stay NULL with no lines;
    pages without a host are one host.
    """
    if name.lower() in map(str.lower, pages.columns):
        raise ValueError(f"the table has a column {name} already")
    names = [f"c{i}" for i in range(len(pages.columns))]
    frame = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("page"), host.alias("host"), F.split(text, "\n").alias("lines"))
    marked = boilerplate(frame.select("host", F.coalesce("lines", F.array().cast("array<string>")).alias("lines")), ratio, min_pages, copies_once)
    marked = marked.withColumnRenamed("host", "same_host")
    joined = frame.join(marked, F.col("host").eqNullSafe(F.col("same_host")), "left").drop("same_host")
    dropped = F.coalesce(F.col("dropped"), F.array().cast(marked.schema["dropped"].dataType))
    kept = F.when(F.size(dropped) == 0, F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~(_has_word(line) & F.array_contains(dropped, _hash(line))))
    )
    out = joined.select("page", "lines", kept.alias("kept"))
    cleaned = F.struct(
        F.array_join("kept", "\n").alias("text"),
        F.coalesce(F.size(F.filter("lines", _has_word)).cast("long"), F.lit(0)).alias("n_lines"),
        F.coalesce((F.size("lines") - F.size("kept")).cast("long"), F.lit(0)).alias("n_dropped"),
    )
    flat = out.select(*[F.col("page").getField(c).alias(n) for c, n in zip(pages.columns, names, strict=True)], cleaned.alias("cleaned"))
    return flat.toDF(*pages.columns, name)
