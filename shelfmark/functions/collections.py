"""Map, array and band helpers, with "missing means zero" semantics where asked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import _col


def map_get(m: Column | str, key: str, default=None) -> Column:
    """Value of ``key``; ``default`` when the map or the key is missing."""
    value = F.element_at(_col(m), F.lit(key))
    return value if default is None else F.coalesce(value, F.lit(default))


def has_key(m: Column | str, key: str) -> Column:
    return F.coalesce(F.map_contains_key(_col(m), F.lit(key)), F.lit(False))


def has_element(a: Column | str, value) -> Column:
    """array_contains that answers false, never NULL, for NULL arrays and NULL elements."""
    return F.coalesce(F.array_contains(_col(a), F.lit(value)), F.lit(False))


def array_or_empty(a: Column | str, element: str = "string") -> Column:
    return F.coalesce(_col(a), F.array().cast(f"array<{element}>"))


def size_of(a: Column | str) -> Column:
    return F.coalesce(F.size(_col(a)), F.lit(0))


def bucketize(c: Column | str, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label of the half-open band ``[edge, next edge)`` the value falls in.

    ``labels`` has one entry more than ``edges``: the first is the band below the first
    edge, the last the band from the last edge up.  NULL stays NULL.
    """
    if len(labels) != len(edges) + 1 or list(edges) != sorted(set(edges)):
        raise ValueError("need ascending edges and one label more than edges")
    c = _col(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(c < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def longest(a: Column) -> Column:
    """Element with the most UTF-8 bytes, the first of them on a tie, NULL when empty."""
    return F.reduce(
        a,
        F.lit(None).cast("string"),
        lambda best, x: F.when(best.isNull() | (F.octet_length(x) > F.octet_length(best)), x).otherwise(best),
    )


def mean(c: Column | str) -> Column:
    """Average as a double from one exact sum.

    Give a DECIMAL (or integer) column and the result does not depend on how rows were
    partitioned or on task retries, unlike a running double sum.  NULL over no rows.
    """
    c = _col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))
