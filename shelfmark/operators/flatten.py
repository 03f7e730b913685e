"""Nested listing to one flat row: prefixed columns, price ladder, defaults, casts.

The projection is generated as Spark SQL text, one expression per table column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.collections import array_or_empty, bucketize, size_of
from shelfmark.functions.text import sql_text
from shelfmark.schemas import FLAT_LISTING, PRICE_KEYS, zero_sql

# Per derived price, the structured keys tried first (only above zero) and
# the older duration labels tried next (any value).  A day reuses the two-hour keys.
PRICE_LADDERS = {
    "price_hour": (("apartments_day_hour", "outcall_day_hour"), ("час", "hour")),
    "price_2_hours": (("apartments_day_2hour", "outcall_day_2hour"), ("2 часа", "2 hours")),
    "price_night": (("apartments_night_hour", "outcall_night_hour"), ("ночь", "night")),
    "price_day": (("apartments_day_2hour", "outcall_day_2hour"), ("день", "day")),
}
BASE_PRICE_KEY = "base"


def _get(prices: str, key: str) -> str:
    return f"try_element_at({prices}, {sql_text(key)})"


def ladder_sql(prices: str, positives: Sequence[str], fallbacks: Sequence[str]) -> str:
    above_zero = [f"CASE WHEN {_get(prices, k)} > 0 THEN {_get(prices, k)} END" for k in positives]
    return f"coalesce({', '.join([*above_zero, *(_get(prices, k) for k in fallbacks), '0L'])})"


def price_ladder(prices: str, positives: Sequence[str], fallbacks: Sequence[str]) -> Column:
    """First positive value among ``positives``, else the first present ``fallbacks`` key, else 0.

    ``prices`` names a map column.
    """
    return F.expr(ladder_sql(prices, positives, fallbacks))


def ladders_sql(prices: str, ladders: dict | None = None) -> dict[str, str]:
    out = {name: ladder_sql(prices, *keys) for name, keys in (ladders or PRICE_LADDERS).items()}
    base = sql_text(BASE_PRICE_KEY)
    out["price_base"] = (
        f"CASE WHEN map_contains_key({prices}, {base}) THEN {_get(prices, BASE_PRICE_KEY)} ELSE {out['price_hour']} END"
    )
    return out


def ladder_columns(prices: str, ladders: dict | None = None) -> dict[str, Column]:
    """The derived prices of one price map column; the base price is its key, else the hour price."""
    return {name: F.expr(sql) for name, sql in ladders_sql(prices, ladders).items()}


def _unsigned_sql(value: str, bits: int, policy: str) -> str:
    wide = f"CAST({value} AS BIGINT)"
    if policy == "wrap":
        return f"pmod({wide}, {1 << bits}L)"
    if policy == "null":
        return f"CASE WHEN {wide} BETWEEN 0 AND {(1 << bits) - 1}L THEN {wide} END"
    raise ValueError(f"unknown policy {policy!r}")


def _unsigned_map_sql(m: str, bits: int = 32, policy: str = "null") -> str:
    cast = f"transform_values({m}, (k, v) -> {_unsigned_sql('v', bits, policy)})"
    return f"coalesce({cast}, CAST(map() AS MAP<STRING, BIGINT>))"


def unsigned_map(m: str, bits: int = 32, policy: str = "null") -> Column:
    """Values of a map column widened from signed to unsigned; an empty map for NULL."""
    return F.expr(_unsigned_map_sql(m, bits, policy))


def range_error() -> Column:
    """Message for a nested listing whose numbers do not fit their unsigned widths, else NULL.

    Meant for :func:`shelfmark.sources.quality.with_outcome`, so that such listings become
    dead letters instead of rows with missing prices.
    """

    def outside(m: str, bits: int) -> Column:
        bad = F.exists(F.map_values(F.col(m)), lambda v: ~v.cast("bigint").between(0, (1 << bits) - 1))
        return F.coalesce(bad, F.lit(False))

    return (
        F.when(outside("attrs.num", 16), F.lit("attribute out of range"))
        .when(outside("pricing.duration_prices", 32), F.lit("duration price out of range"))
        .when(outside("pricing.service_prices", 32), F.lit("service price out of range"))
        .when(size_of(F.col("photos")) >= 1 << 16, F.lit("too many photos"))
    )


def flatten(
    listings: DataFrame,
    currency: str = "RUB",
    city: str = "Unknown",
    policy: str = "null",
    version: str | None = "scraped_at",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Flat listing rows in table order, then the ``keep`` columns as they are.

    ``version`` names the event-time column stamped into the three time columns, so a
    re-run gives the same rows; NULL there, or ``version=None``, stamps the query time.
    ``policy`` rules numbers outside their unsigned width: ``wrap`` around, or ``null``, where
    the number counts as missing (split such listings off first with :func:`range_error`).
    """
    stamp = f"coalesce(CAST({version} AS TIMESTAMP), current_timestamp())" if version else "current_timestamp()"
    values = {
        "id": "id",
        **dict.fromkeys(("created_at", "updated_at", "last_scraped"), stamp),
        "source_url": "source_url",
        "title": "title",
        "attr_num": _unsigned_map_sql("attrs.num", 16, policy),
        "attr_str": "attrs.str",
        "has_contact": "has_contact",
        # Without pricing the currency stays blank; the default applies to blank text only.
        "pricing_currency": f"CASE WHEN pricing IS NOT NULL THEN coalesce(nullif(pricing.currency, ''), {sql_text(currency)}) END",
        **{f"price_{k}": _get("_prices", k) for k in PRICE_KEYS},
        **ladders_sql("_prices"),
        "pricing_duration_prices": "_prices",
        "pricing_service_prices": _unsigned_map_sql("pricing.service_prices", 32, policy),
        **{f"tags_{n}": f"tags.{n}" for n in ("available", "additional", "restrictions", "meeting_type")},
        **{f"location_{n}": f"location.{n}" for n in ("stations", "district", "offsite", "onsite")},
        "location_city": f"coalesce(nullif(location.city, ''), {sql_text(city)})",
        "description": "description",
        "last_updated": "last_updated",
        "photos": "photos",
        "photos_count": _unsigned_sql("coalesce(size(photos), 0)", 16, policy),
    }
    columns = []
    for f in FLAT_LISTING.fields:
        sql = f"CAST({values[f.name]} AS {f.dataType.simpleString()})"
        if values[f.name] != stamp:
            sql = f"coalesce({sql}, {zero_sql(f.dataType)})"
        columns.append(f"{sql} AS {f.name}")
    # The cast price map becomes a column first: the ladder reads it many times.
    cast_prices = f"{_unsigned_map_sql('pricing.duration_prices', 32, policy)} AS _prices"
    return listings.selectExpr("*", cast_prices).selectExpr(*columns, *keep)


def with_computed(
    df: DataFrame,
    bands: dict[str, tuple[str, Sequence, Sequence[str]]],
    description: str = "description",
    photos: str | None = "photos",
    contact: Column | None = None,
) -> DataFrame:
    """Add ``description_length`` (bytes), ``has_photos``, ``has_contact`` and band columns.

    ``bands`` maps a new column to (source column, edges, labels); there are no default edges.
    """
    extra = {"description_length": F.coalesce(F.octet_length(F.col(description)), F.lit(0)).cast("bigint")}
    if photos:
        extra["has_photos"] = F.size(array_or_empty(photos)) > 0
    if contact is not None:
        extra["has_contact"] = contact
    for name, (source, edges, labels) in bands.items():
        extra[name] = bucketize(F.col(source), edges, labels)
    return df.withColumns(extra)
