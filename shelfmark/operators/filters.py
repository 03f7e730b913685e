"""Row predicates: recency, retention, array-and-range search."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.collections import has_element
from shelfmark.functions.text import _col


def _instant(as_of) -> Column:
    """A fixed instant, or the query's own time for None."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def recent(df: DataFrame, ts: str, width: dt.timedelta = dt.timedelta(minutes=1), as_of=None) -> DataFrame:
    """Rows at most ``width`` older than ``as_of``.

    The bound is computed on the constant side, so the comparison is on the bare column
    and reaches the scan.
    """
    return df.filter(F.col(ts) >= _instant(as_of) - F.lit(width))


def retain(df: DataFrame, ts: str, days: int, as_of=None, month: str | None = None) -> DataFrame:
    """Rows not yet expired: ``ts + days`` lies after ``as_of``.

    ``month`` names a ``yyyymm`` partition column derived from ``ts``; whole expired months
    are then skipped without being listed.
    """
    bound = _instant(as_of) - F.lit(dt.timedelta(days=days))
    kept = df.filter(F.col(ts) > bound)
    if month:
        kept = kept.filter(F.col(month) >= (F.year(bound) * 100 + F.month(bound)))
    return kept


def tagged_in_range(df: DataFrame, array: str | Column, element, place: str, place_value, value: str, low, high) -> DataFrame:
    """Rows whose array holds ``element``, in one place, with ``value`` in [low, high]."""
    return df.filter(
        (F.col(place) == F.lit(place_value)) & F.col(value).between(low, high) & has_element(_col(array), element)
    )
