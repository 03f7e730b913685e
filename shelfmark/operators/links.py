"""Links of stored index pages: extraction, page-local dedup, page counts, page URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.html import anchors, page_text
from shelfmark.functions.text import blank_to_null, let, strict_int
from shelfmark.functions.urls import (
    LISTING_WORDS,
    is_listing_link,
    key_from_url,
    key_patterns,
    page_number,
    page_url,
    page_url_alternate,
    resolve_href,
)


def page_links(
    pages: DataFrame,
    base: Column,
    keep: Sequence[str] = ("page_id",),
    words: Sequence[str] | None = LISTING_WORDS,
    exclude: Sequence[str] = (),
    html: str = "html",
    dedup: bool = False,
) -> DataFrame:
    """One row per link of each page: ``pos, url, title, id`` next to the ``keep`` columns.

    Anchors without an address are skipped, relative ones resolved against ``base``; the
    title is the link text, or the ``title`` attribute when there is no text.  ``words``
    limits the result to listing links (None keeps every link).

    With ``dedup`` only the first link per address and page remains.  A page is one row, so
    this happens inside its array and needs no shuffle: links are sorted by (url, pos) and
    each one equal to its left neighbour goes.
    """
    resolved = F.transform(
        anchors(html),
        lambda a: F.struct(
            resolve_href(a["href"], F.col("_base")).alias("url"),
            a["pos"].alias("pos"),
            F.coalesce(blank_to_null(a["text"]), a["title"]).alias("title"),
        ),
    )
    links = F.filter(resolved, lambda a: a["url"] != "")
    if words is not None:
        links = F.filter(links, lambda a: is_listing_link(a["url"], words, exclude))
    out = pages.select(*keep, html, base.alias("_base"))
    if dedup:
        ordered = out.select(*keep, F.sort_array(links).alias("_links"))
        links = F.filter(
            F.col("_links"),
            lambda a, i: (i == 0) | (a["url"] != F.get(F.col("_links"), i - 1)["url"]),
        )
        out = ordered
    exploded = out.select(*keep, F.explode(links).alias("_l"))
    return exploded.select(
        *keep, "_l.pos", "_l.url", "_l.title", key_from_url("_l.url", key_patterns(words or LISTING_WORDS)).alias("id")
    )


def link_urls(links: DataFrame) -> DataFrame:
    return links.select("url")


def page_counts(pages: DataFrame, site: Column, html: str = "html", own_url: str | None = None) -> DataFrame:
    """Number of index pages per site, at least 1.

    The greatest page number in any link address or all-digit link text; where a page has
    none, the last number of a ``1 2 3 4 5 ... n`` line in its text.  ``own_url`` adds the
    page number in the page's own address.
    """
    per_link = F.transform(
        # An anchor that leads nowhere names no page, whatever its text.
        F.filter(anchors(html), lambda a: a["href"].isNotNull()),
        lambda a: F.greatest(page_number(a["href"]), strict_int(F.regexp_extract(a["text"], r"\A\d+\z", 0))),
    )
    listed = F.array_max(per_link)
    if own_url:
        listed = F.greatest(listed, page_number(own_url))
    # Fixed value: how a page writes its list of pages.
    line = F.regexp_extract(page_text(html), r"\d+\s+\d+\s+\d+\s+\d+\s+\d+\s*\.\.\.\s*(\d+)", 1).try_cast("bigint")
    # The text is read only where the links name no page.
    number = let(listed, lambda n: F.when(n > 0, n).otherwise(line))
    per_page = pages.select(site.alias("site"), number.alias("_n"))
    return per_page.groupBy("site").agg(F.coalesce(F.max("_n"), F.lit(1)).cast("bigint").alias("pages"))


def index_urls(counts: DataFrame, site: str = "site", pages: str = "pages") -> DataFrame:
    """Every index page address of each site, with its alternate form.

    The number of pages is read from page text and may be anything, so no array is as long as
    it: pages come in blocks of a million, and blocks of blocks where there are more.
    """
    rows = counts.select(site, F.lit(0).cast("bigint").alias("_from"), F.col(pages).alias("_n"))
    for width in (1 << 40, 1 << 20):
        first = F.sequence(F.col("_from"), F.col("_from") + F.greatest(F.col("_n"), F.lit(1)) - 1, F.lit(width).cast("bigint"))
        rows = rows.where("_n > 0").select(site, "_from", "_n", F.explode(first).alias("_at"))
        rows = rows.select(site, F.col("_at").alias("_from"), F.least(F.col("_from") + F.col("_n") - F.col("_at"), F.lit(width)).alias("_n"))
    page = F.explode(F.sequence(F.col("_from") + 1, F.col("_from") + F.col("_n")))
    return rows.select(site, page.alias("page")).select(
        site, "page", page_url(site, "page").alias("url"), page_url_alternate(site, "page").alias("alternate_url")
    )
