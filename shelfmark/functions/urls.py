"""URL helpers: link test, key, page number, host, resolving."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import _col, blank_to_null, let, trim_space

# Words that, followed by digits, mark a link to one listing.
LISTING_WORDS = ("profile", "user", "id", "listing")
LISTING_KEY = r"listing(\d+)\.htm"

# The parts of a URL that exclude it when an exclusion is asked for.
EXCLUDED_PARTS = (
    "page=", "p=", "category", "search", "filter", "sort", "login", "register",
    "contact", "about", "help", "javascript:", "mailto:", "tel:", "#",
)

# What precedes a page number in a link.
PAGE_MARKS = ("page=", "p=", "страница=")


def is_listing_link(url: Column | str, words: Sequence[str] = LISTING_WORDS, exclude: Sequence[str] = ()) -> Column:
    """True when the lower-cased URL has one of ``words`` directly followed by digits.

    The test is unanchored, so ``/covid19`` passes through ``id``.  ``exclude`` is off by default.
    """
    low = F.lower(_col(url))
    keep = low.rlike(f"(?:{'|'.join(words)})\\d+")
    for part in exclude:
        keep = keep & ~low.contains(part)
    return keep


def key_patterns(words: Sequence[str] = LISTING_WORDS) -> list[str]:
    """Patterns tried in order for a key: each word plus digits, then a numeric last path part."""
    return [rf"{w}(\d+)" for w in words] + [r"/(\d+)/?\z"]


def key_from_url(url: Column | str, patterns: Sequence[str] | None = None) -> Column:
    """Group 1 of the first pattern that matches, '' when none does (case-sensitive)."""
    url = _col(url)
    found = [blank_to_null(F.regexp_extract(url, p, 1)) for p in (patterns or key_patterns())]
    return F.coalesce(*found, F.lit(""))


def listing_key(url: Column | str, pattern: str = LISTING_KEY) -> Column:
    return F.regexp_extract(_col(url), pattern, 1)


def resolve_href(href: Column | str, base: Column | str) -> Column:
    """Absolute form: ``/x`` and ``x`` go under the base, ``http…`` stays; blank gives ''."""
    base = _col(base)
    return let(
        trim_space(href),
        lambda x: F.when(x == "", F.lit(""))
        .when(x.startswith("/"), F.concat(base, x))
        .when(x.startswith("http"), x)
        .otherwise(F.concat(base, F.lit("/"), x)),
    )


def page_number(href: Column | str, marks: Sequence[str] = PAGE_MARKS) -> Column:
    """Number after the first page mark in a link as BIGINT, NULL when there is none."""
    marks_re = "|".join(re.escape(m) for m in marks)
    return F.regexp_extract(_col(href), rf"(?iu)(?:{marks_re})(\d+)", 1).try_cast("bigint")


def site_base(url: Column | str) -> Column:
    """``scheme://host`` of a URL."""
    return F.regexp_extract(_col(url), r"\A(https?://[^/?#]+)", 1)


def page_url(base: Column | str, n: Column | str) -> Column:
    """URL of index page ``n``: the base itself for page 1, ``base/?page=n`` after it."""
    base, n = _col(base), _col(n)
    return F.when(n == 1, base).otherwise(F.concat(base, F.lit("/?page="), n.cast("string")))


def page_url_alternate(base: Column | str, n: Column | str) -> Column:
    """The other form of an index page URL, for when the first does not answer."""
    return F.concat(_col(base), F.lit("/p"), _col(n).cast("string"))
