"""Summary and grouped statistics.

Averages go through :func:`shelfmark.functions.collections.mean`; pass DECIMAL columns for
results that do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.collections import array_or_empty, mean
from shelfmark.functions.text import yyyymm


def _rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def summary(
    df: DataFrame,
    counts: dict[str, Column] | None = None,
    averages: dict[str, Column] | None = None,
    distinct: dict[str, Column] | None = None,
    positive_only: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """One row: total, conditional counts, averages and exact distinct counts.

    Averages include zeros unless ``positive_only``; over no rows they are NULL.
    """
    aggs = [F.count("*").alias("total")]
    aggs += [F.count_if(cond).alias(name) for name, cond in (counts or {}).items()]
    for name, c in (averages or {}).items():
        aggs.append(_rounded(mean(F.when(c > 0, c) if positive_only else c), digits).alias(name))
    aggs += [F.count_distinct(c).alias(name) for name, c in (distinct or {}).items()]
    return df.agg(*aggs)


def listing_summary(latest_listings: DataFrame, attribute: str | None = None) -> DataFrame:
    """Summary of the flat listing table (give it :func:`latest` rows).

    With a numeric ``attribute``: also how many listings have it above zero, and its average with zeros.
    """
    value = F.coalesce(F.element_at("attr_num", F.lit(attribute)), F.lit(0)) if attribute else None
    return summary(
        latest_listings,
        counts={
            "with_contact": F.col("has_contact"),
            "with_photos": F.col("photos_count") > 0,
            "with_price": F.col("price_hour") > 0,
            "with_description": F.length("description") > 0,
            **({f"with_{attribute}": value > 0} if attribute else {}),
        },
        averages={"avg_price": F.col("price_hour"), **({f"avg_{attribute}": value} if attribute else {})},
        distinct={"cities": F.col("location_city")},
    )


def grouped(
    df: DataFrame,
    by: dict[str, Column] | Sequence[str],
    value: Column,
    stats: Sequence[str] = ("count", "avg"),
    gate: Column | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Statistics of ``value`` per group, over the rows that pass ``gate``.

    ``stats`` picks from count, avg, min, max, sum.
    """
    by = by if isinstance(by, dict) else {c: F.col(c) for c in by}
    make = {
        "count": lambda: F.count("*").alias("n"),
        "avg": lambda: _rounded(mean(value), digits).alias("avg_value"),
        "min": lambda: F.min(value).alias("min_value"),
        "max": lambda: F.max(value).alias("max_value"),
        "sum": lambda: F.sum(value).alias("sum_value"),
    }
    if gate is not None:
        df = df.filter(gate)
    return df.groupBy(*(c.alias(n) for n, c in by.items())).agg(*(make[s]() for s in stats))


def ranked(df: DataFrame, by: str, *ties: str, limit: int | None = None) -> DataFrame:
    """Order by ``by`` descending with ``ties`` ascending; with ``limit`` a top-k without a full sort."""
    out = df.orderBy(F.col(by).desc(), *(F.col(c).asc() for c in ties))
    return out if limit is None else out.limit(limit)


def element_popularity(
    df: DataFrame, array: str | Column, value: Column, name: str = "element", limit: int | None = 20
) -> DataFrame:
    """Count and average of ``value`` per non-empty array element, the most frequent first.

    Rows with an empty array drop out.  Elements are counted per task before the shuffle.
    """
    exploded = df.select(F.explode(array_or_empty(array)).alias(name), value.alias("_v")).filter(F.col(name) != "")
    return ranked(grouped(exploded, [name], F.col("_v")), "n", name, limit=limit)


def monthly(df: DataFrame, ts: str, value: Column) -> DataFrame:
    """Row count and average per month, in month order."""
    return grouped(df, {"yyyymm": yyyymm(ts)}, value).orderBy("yyyymm")


def daily(df: DataFrame, ts: str, by: str, value: Column) -> DataFrame:
    """Count, average, minimum and maximum per day and group."""
    return grouped(df, {"day": F.to_date(ts), by: F.col(by)}, value, ("count", "avg", "min", "max"))


def run_counters(df: DataFrame, ok: Column, by: Sequence[str] = ()) -> DataFrame:
    """Processed, succeeded and failed rows with the success rate in percent."""
    return (
        df.groupBy(*by)
        .agg(F.count("*").alias("processed"), F.count_if(ok).alias("succeeded"))
        .withColumn("failed", F.col("processed") - F.col("succeeded"))
        .withColumn("success_rate", F.try_divide(F.col("succeeded") * 100.0, F.col("processed").cast("double")))
    )


def event_summary(events: DataFrame, event_type: str = "event_type", source: str = "source") -> DataFrame:
    """Events per (type, source)."""
    return events.groupBy(F.col(event_type).alias("event_type"), F.col(source).alias("source")).agg(
        F.count("*").cast("double").alias("metric_value")
    )


def as_metrics(summary_df: DataFrame, name: str = "events_per_minute", at: Column | None = None) -> DataFrame:
    """Shape an event summary as metric rows with a label map."""
    at = F.current_timestamp() if at is None else at
    return summary_df.select(
        F.uuid().alias("id"),
        at.alias("timestamp"),
        F.lit(name).alias("metric_name"),
        "metric_value",
        F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("source"), F.col("source")).alias("labels"),
        at.alias("created_at"),
    )
