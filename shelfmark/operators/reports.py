"""Ready reports over the flat listing table.

Each takes all stored versions and reports on the latest per (id, city) unless
``latest_only=False``, which counts every stored version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.collections import bucketize
from shelfmark.operators import analytics, filters
from shelfmark.operators.versions import latest

KEYS = ("id", "location_city")
VERSION = "updated_at"
# Of equal versions the last loaded counts, where the rows say so (see shelfmark.sources.tables.read).
LOAD = "load_seq"


def current(listings: DataFrame, latest_only: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows a report counts; ``columns`` narrows them before the versions are compared."""
    loaded = [LOAD] if LOAD in listings.columns else []
    if columns is not None:
        listings = listings.select(*dict.fromkeys((*KEYS, VERSION, *loaded, *columns)))
    return latest(listings, KEYS, VERSION, loaded) if latest_only else listings


def summary(listings: DataFrame, attribute: str | None = None) -> DataFrame:
    """Totals, completeness counts, average price with zeros, number of cities; for a numeric attribute its count above zero and average."""
    needed = ("has_contact", "photos_count", "price_hour", "description", *(["attr_num"] if attribute else []))
    return analytics.listing_summary(current(listings, columns=needed), attribute)


def average_price_by_city(listings: DataFrame, latest_only: bool = True) -> DataFrame:
    """Average positive hour price and listing count per city, dearest first."""
    rows = current(listings, latest_only, ["price_hour"])
    price = F.col("price_hour")
    out = analytics.grouped(rows, ["location_city"], price, gate=price > 0)
    return analytics.ranked(out, "avg_value", "location_city")


def attribute_distribution(
    listings: DataFrame, attribute: str, edges: Sequence, labels: Sequence[str], latest_only: bool = True
) -> DataFrame:
    """Listing count and average hour price per band of a numeric attribute above zero."""
    value = F.element_at("attr_num", F.lit(attribute))
    rows = current(listings, latest_only, ["attr_num", "price_hour"])
    out = analytics.grouped(rows, {"band": bucketize(value, edges, labels)}, F.col("price_hour"), gate=value > 0)
    return analytics.ranked(out, "n", "band")


def price_ranges(listings: DataFrame, edges: Sequence, labels: Sequence[str], latest_only: bool = True) -> DataFrame:
    """Count, lowest and highest positive hour price per price band."""
    rows, price = current(listings, latest_only, ["price_hour"]), F.col("price_hour")
    band = {"price_range": bucketize(price, edges, labels)}
    return analytics.grouped(rows, band, price, ("count", "min", "max"), gate=price > 0)


def tagged(
    listings: DataFrame, tag: str, city: str, low: int, high: int, latest_only: bool = True, attribute: str | None = None
) -> DataFrame:
    """Listings in one city that carry a tag and cost between two prices, both included, with a numeric attribute if one is named."""
    # City is part of the key, so it may narrow the versions that are compared.
    needed = ["tags_available", "price_hour", *(["attr_num"] if attribute else [])]
    rows = current(listings.filter(F.col("location_city") == city), latest_only, needed)
    found = filters.tagged_in_range(rows, "tags_available", tag, "location_city", city, "price_hour", low, high)
    more = [F.coalesce(F.element_at("attr_num", F.lit(attribute)), F.lit(0)).alias(attribute)] if attribute else []
    return found.select("id", *more, "price_hour", "location_city")


def station_popularity(listings: DataFrame, limit: int | None = 20, latest_only: bool = True) -> DataFrame:
    """The stations named by most listings with their average hour price."""
    rows = current(listings, latest_only, ["location_stations", "price_hour"])
    return analytics.element_popularity(rows, "location_stations", F.col("price_hour"), "station", limit)


def listings_per_month(listings: DataFrame, first_seen: bool = True) -> DataFrame:
    """New listings and average hour price per month.

    A listing counts in the month it was first stored, with its newest price.  Every re-read
    stores a new creation time, so ``first_seen=False``, which counts stored rows by that
    time, counts re-reads as new.
    """
    if first_seen:
        newest = F.struct(VERSION, *([LOAD] if LOAD in listings.columns else []))
        listings = listings.groupBy("id").agg(
            F.min("created_at").alias("created_at"), F.max_by("price_hour", newest).alias("price_hour")
        )
    return analytics.monthly(listings, "created_at", F.col("price_hour"))


def daily_city_stats(listings: DataFrame) -> DataFrame:
    """Count, average, lowest and highest hour price per day and city."""
    by = {"day": F.to_date("created_at"), "location_city": F.col("location_city")}
    return analytics.grouped(listings, by, F.col("price_hour"), ("count", "avg", "min", "max"))
