"""Versioned rows: latest per key, first occurrence, first seen, new keys only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key.  Spark prunes to one row per key and task before the shuffle
    (partial WindowGroupLimit), so a hot key costs one row per map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], version: str, tiebreak: str | Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``version`` per key; ``tiebreak`` columns decide equal versions.

    Filter on keys before this, on anything else after it: a non-key filter before it would
    bring older versions back.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    return _first_by(df, keys, [F.col(c).desc() for c in (version, *ties)])


def first_occurrence(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The first row per key in the given order; later duplicates are dropped."""
    order = [order] if isinstance(order, str) else list(order)
    return _first_by(df, keys, [F.col(c).asc() for c in order])


def lookup(df: DataFrame, key: str, value, version: str, tiebreak: str | Sequence[str] = ()) -> DataFrame:
    """Latest version of one key, no row when it is unknown.

    The equality reaches the scan and the single survivor is found by a top-1, without a shuffle
    of the matching rows.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    found = df.filter(F.col(key) == F.lit(value))
    return found.orderBy(*(F.col(c).desc() for c in (version, *ties))).limit(1)


def first_seen(df: DataFrame, keys: Sequence[str], version: str, name: str = "first_seen") -> DataFrame:
    """Earliest version per key, so a later re-read does not count as new."""
    return df.groupBy(*keys).agg(F.min(version).alias(name))


def new_only(incoming: DataFrame, seen: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """First occurrence of every key of ``incoming`` that ``seen`` does not hold.

    Both sides are reduced to one row per key before they meet, so no key is hot in the join;
    Spark broadcasts the seen keys only while they measure below its threshold.
    """
    fresh = first_occurrence(incoming, keys, order)
    return fresh.join(seen.select(*keys).distinct(), list(keys), "left_anti")
