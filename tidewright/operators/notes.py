"""Linked notes: links, orphans and the log of a collection of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIKI_LINK = r"\[\[([^\]|#]+)"
# [[target#part|alias]] with an optional part and alias, and a ! before it where the page is embedded; no line breaks inside.
FULL_LINK = r"(!?\[\[[^\[\]\n]+\]\])"
LINK_FIELDS = r"^(!?)\[\[([^#|]*)(?:#([^|]*))?(?:\|(.*))?\]\]$"
HREF = r'href="([^"]*)"'
LOG_LINE = r"^## \[(\d{4}-\d{2}-\d{2})\] (\S+) \| (.*)$"


def links(pages: DataFrame, key: str, text: str, pattern: str = WIKI_LINK) -> DataFrame:
    """One row per link as (key, position, target)."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("position", "target"))


def url_path(url: Column) -> Column:
    """Path of a URL without scheme, host, query, fragment and closing slash; empty path is ``/``."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    short = F.regexp_replace(path, r"/+$", "")
    return F.when(short == "", "/").otherwise(short)


def orphans(pages: DataFrame, key: str, address: Column, link_df: DataFrame) -> DataFrame:
    """Pages no other page links to. Targets are made distinct before the join, so a popular page costs one row."""
    asked = pages.withColumn("_a", address)
    inbound = link_df.select(F.col("target").alias("_a"), F.col(key).alias("_from"))
    # Two distinct sources are enough to know that one of them is another page.
    sources = inbound.groupBy("_a").agg(F.min("_from").alias("_lo"), F.max("_from").alias("_hi"))
    linked = asked.join(sources, "_a").filter((F.col("_lo") != F.col(key)) | (F.col("_hi") != F.col(key)))
    return asked.join(linked.select(key), key, "left_anti").drop("_a")


def name_key(name: Column) -> Column:
    """A page's name as links are compared by: without case, surrounding blanks, leading ./ or /, and .md; blanks run together, slashes forward."""
    plain = F.regexp_replace(F.lower(F.translate(name, "\\", "/")), r"\s+", " ")
    return F.regexp_replace(F.regexp_replace(F.trim(plain), r"^(\./|/)+", ""), r"\.md$", "")


def wiki_links(pages: DataFrame, key: str, text: str) -> DataFrame:
    """One row per wiki link: (key, position, target, part, alias, embedded). A link to a part of its own page has the target ``''``."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(FULL_LINK), F.lit(1))).alias("position", "_link"))
    field = lambda i: F.regexp_extract("_link", LINK_FIELDS, i)
    return found.select(
        key, "position", F.trim(field(2)).alias("target"), F.nullif(F.trim(field(3)), F.lit("")).alias("part"),
        F.nullif(F.trim(field(4)), F.lit("")).alias("alias"), (field(1) == "!").alias("embedded"),
    )


def page_names(pages: DataFrame, key: str, path: str, title: str, aliases: str) -> DataFrame:
    """(name, page): what a link may call a page. A path beats a file name, that a title, that an alias; then the lesser key wins."""
    stem = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    ways = [(0, F.array(path)), (1, F.array(stem)), (2, F.array(title)), (3, F.coalesce(F.col(aliases), F.array().cast("array<string>")))]

    def called(rank: int, names: Column) -> Column:
        return F.transform(names, lambda n: F.struct(name_key(n).alias("name"), F.lit(rank).alias("rank")))

    calls = F.flatten(F.array(*[called(rank, names) for rank, names in ways]))
    rows = pages.select(F.col(key).alias("page"), F.inline(calls)).where("name <> ''")
    return rows.groupBy("name").agg(F.min(F.struct("rank", "page")).alias("best")).select("name", "best.page")


def resolve(link_df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """The links with ``page``, the key of the page they lead to, null where they are broken.

    Names are unique, so a popular page is one row of the smaller side; the links' side of the join may be split.
    """
    named = link_df.withColumn("name", name_key(F.col("target")))
    found = named.join(names.select("name", "page"), "name", "left")
    return found.withColumn("page", F.when(F.col("name") == "", F.col(key)).otherwise(F.col("page"))).drop("name")


def without_inbound(pages: DataFrame, key: str, resolved: DataFrame) -> DataFrame:
    """Pages no other page links to: an anti join with the distinct pages that links between two pages lead to."""
    linked = resolved.where(F.col("page").isNotNull() & (F.col("page") != F.col(key))).select(F.col("page").alias(key)).distinct()
    return pages.join(linked, key, "left_anti")


def parse_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """Entries ``## [date] operation | title``; other lines drop out."""
    text = F.col(line)
    return lines.filter(text.rlike(LOG_LINE)).withColumns({
        "day": F.regexp_extract(text, LOG_LINE, 1), "operation": F.regexp_extract(text, LOG_LINE, 2),
        "title": F.regexp_extract(text, LOG_LINE, 3),
    })
