"""Page to nested listing record.

The page is parsed once by :func:`shelfmark.functions.markup.select_elements`; every rule
below is a Spark expression over the selected elements.  Selectors, labels and words are
parameters of :class:`SiteRules`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.markup import Select, select_elements
from shelfmark.functions.text import (
    blank_to_null,
    checked_int,
    date_from_text,
    keyword_class,
    let,
    longer_than,
    parse_price,
    strict_int,
    trim_space,
)
from shelfmark.functions.urls import LISTING_KEY, listing_key
from shelfmark.schemas import PRICE_KEYS

# Fixed value: what date_from_text looks for, ASCII digits only.
DATE_PATTERN = r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}"


@dataclass(frozen=True)
class SiteRules:
    """Where a site keeps each field of a listing."""

    key_pattern: str = LISTING_KEY
    title: str = "h1.breadcrumbs > span"
    numbers: dict[str, str] = field(default_factory=lambda: {"width": "#attr-width", "height": "#attr-height"})
    strings: dict[str, str] = field(default_factory=lambda: {"color": "#attr-color", "material": "#attr-material"})
    contact: str = "#contact a"
    price_rows: str = "table.table-price table.table-price-inner tr"
    onsite_row: int = 2
    offsite_row: int = 3
    currency: str = "RUB"
    strip_price_spaces: bool = False
    tag_links: str = "table.tags a[href]"
    skipped_tag_class: str = "noservice"
    city: str = "#place-city"
    default_city: str = "Moscow"
    station_links: str = "a[href*='metro']"
    district_links: str = "a[href*='district']"
    # Row labels and page words, matched as plain text.
    station_label: str = "Метро"
    district_label: str = "Район"
    onsite_word: str = "апартаменты"
    offsite_word: str = "выезд"
    visit_word: str = "принимаю"
    rows: str = "table tr"
    description: str = "p.description"
    description_cells: str = "table tr td[colspan='2']"
    description_bytes: int = 50
    station_bytes: int = 2
    updated_cells: str = "tr.noprint td"
    cells: str = "table tr td"
    image_prefix: str = ""

    def selects(self) -> list[Select]:
        one = {
            "title": self.title, "tags": self.tag_links, "city": self.city, "stations": self.station_links,
            "districts": self.district_links,
        }
        one |= {f"num_{k}": v for k, v in self.numbers.items()} | {f"str_{k}": v for k, v in self.strings.items()}
        return [
            *(Select(n, s) for n, s in one.items()),
            Select("description", self.description, "first"),
            Select("updated", self.updated_cells, "last"),
            Select("prices", self.price_rows, "price_rows", wanted=(self.onsite_row, self.offsite_row)),
            Select("station_row", self.rows, "labelled", self.station_label, self.station_bytes),
            Select("district_row", self.rows, "labelled", self.district_label),
            Select("description_cell", self.description_cells, "longest", least_bytes=self.description_bytes),
            Select("dated_cell", self.cells, "last_match", DATE_PATTERN),
            Select("low", kind="text"),
            Select("contact", self.contact, "flag"),
        ]


def _all_text(nodes: Column) -> Column:
    """Text of all matches, joined and trimmed; '' without a match."""
    return trim_space(F.array_join(F.transform(nodes, lambda n: n["text"]), ""))


def _texts(nodes: Column) -> Column:
    return F.transform(nodes, lambda n: trim_space(n["text"]))


def _prices(rows: Column, rules: SiteRules) -> Column:
    """Cells 1 to 4 of the on-site and the off-site row under the fixed keys; absent is 0."""
    cells = [(r, c) for r in (0, 1) for c in range(1, 5)]
    values = [parse_price(F.coalesce(F.get(F.get(rows, F.lit(r)), F.lit(c)), F.lit("")), rules.strip_price_spaces) for r, c in cells]
    return F.map_from_arrays(F.array(*(F.lit(k) for k in PRICE_KEYS)), F.array(*values))


def _stations(names: Column, n_bytes: int) -> Column:
    return F.filter(names, lambda s: longer_than(s, n_bytes))


def _place(m: Column, low: Column, rules: SiteRules) -> Column:
    linked = _stations(_texts(m["stations"]), rules.station_bytes)
    listed = m["station_row"]["links"]
    districts = F.filter(_texts(m["districts"]), lambda s: s != "")
    district = F.coalesce(
        F.try_element_at(districts, F.lit(-1)),
        m["district_row"]["text"],
        F.lit(""),
    )
    return F.struct(
        let(linked, lambda names: F.when(F.size(names) > 0, names).otherwise(F.coalesce(listed, names))).alias("stations"),
        district.alias("district"),
        # An element with only white space gives a blank city, one without text the default.
        F.when(F.exists(m["city"], lambda n: n["text"] != ""), _all_text(m["city"]))
        .otherwise(F.lit(rules.default_city))
        .alias("city"),
        low.contains(rules.offsite_word).alias("offsite"),
        (low.contains(rules.onsite_word) | low.contains(rules.visit_word)).alias("onsite"),
    )


def _description(m: Column, rules: SiteRules) -> Column:
    """The first description element, even an empty one; else the longest wide cell."""
    return F.coalesce(trim_space(m["description"]), m["description_cell"], F.lit(""))


def _last_updated(m: Column) -> Column:
    """Date in the last marked cell, else the last date found in any table cell."""
    marked = date_from_text(F.coalesce(m["updated"], F.lit("")))
    return F.coalesce(blank_to_null(marked), m["dated_cell"], F.lit(""))


def _number_map(m: Column, names) -> Column:
    """Strict integers by element; 0 when the text is none."""
    if not names:
        return F.create_map().cast("map<string,int>")
    pairs = []
    for n in names:
        value = checked_int(strict_int(_all_text(m[f"num_{n}"])), 32, signed=True, policy="wrap")
        pairs += [F.lit(n), F.coalesce(value, F.lit(0)).cast("int")]
    return F.create_map(*pairs)


def _string_map(m: Column, names) -> Column:
    if not names:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*(x for n in names for x in (F.lit(n), _all_text(m[f"str_{n}"]))))


def select_from_pages(pages: DataFrame, selects: list[Select], html: str = "html", partitions: int | None = None) -> DataFrame:
    """Pages with a struct column ``_m`` of selected elements.

    ``partitions`` spreads the pages first; useful when few large files hold them, since
    parsing is the costly step.
    """
    if partitions:
        pages = pages.repartition(partitions)
    return pages.withColumn("_m", select_elements(F.col(html), selects))


def extract_listings(
    pages: DataFrame,
    rules: SiteRules = SiteRules(),
    url: str = "url",
    html: str = "html",
    images: str | None = None,
    scraped_at: str | None = None,
    partitions: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One nested listing per page, and the ``keep`` columns of the page as they are.

    ``images`` names a column of parsed image records (see :func:`shelfmark.sources.pages.image_records`),
    ``scraped_at`` the event-time column of the page.
    """
    m = F.col("_m")
    low = m["low"]
    photos = F.transform(F.col(images), lambda i: F.concat(F.lit(rules.image_prefix), i["BIMG"])) if images else F.array()
    parsed = select_from_pages(pages, rules.selects(), html, partitions)
    return parsed.select(
        listing_key(url, rules.key_pattern).alias("id"),
        _all_text(m["title"]).alias("title"),
        F.struct(_number_map(m, rules.numbers).alias("num"), _string_map(m, rules.strings).alias("str")).alias("attrs"),
        m["contact"].alias("has_contact"),
        F.struct(
            _prices(m["prices"], rules).alias("duration_prices"),
            F.create_map().cast("map<string,int>").alias("service_prices"),
            F.lit(rules.currency).alias("currency"),
        ).alias("pricing"),
        F.struct(
            F.transform(
                F.filter(
                    m["tags"],
                    lambda n: (trim_space(n["text"]) != "")
                    & ~F.array_contains(F.split(n["class"], r"\s+"), rules.skipped_tag_class),
                ),
                lambda n: trim_space(n["text"]),
            ).alias("available"),
            F.array().cast("array<string>").alias("additional"),
            F.array().cast("array<string>").alias("restrictions"),
            keyword_class(low, rules.onsite_word, rules.offsite_word).alias("meeting_type"),
        ).alias("tags"),
        _place(m, low, rules).alias("location"),
        _description(m, rules).alias("description"),
        _last_updated(m).alias("last_updated"),
        photos.cast("array<string>").alias("photos"),
        F.col(url).alias("source_url"),
        (F.col(scraped_at) if scraped_at else F.lit(None)).cast("timestamp").alias("scraped_at"),
        *keep,
    )
