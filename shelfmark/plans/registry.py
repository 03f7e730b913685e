"""Registry of the runnable queries: a Spark plan and, where there is one, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its own name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def database(spark: SparkSession) -> str:
    """A new database in the shared folder, for the tables of one query."""
    path = shared_folder(spark, "database")
    name = f"shelfmark_{path[-32:]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def money(c: str) -> Column:
    """Exact form of a two-digit amount, so sums do not depend on row order."""
    return F.col(c).cast("decimal(18,2)")


def ntz(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")
