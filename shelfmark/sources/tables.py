"""Stored tables on Parquet: create, append, upsert, read, compact, purge, cluster."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import yyyymm
from shelfmark.operators.filters import retain
from shelfmark.operators.flatten import flatten
from shelfmark.operators.versions import latest
from shelfmark.schemas import INT, LISTING, LONG, TABLES, Table, fill_defaults, plus
from shelfmark.session import drop_folder, materialize

MONTH = "yyyymm"
#: Order of loading, stored with every row; of equal versions the last loaded wins.
LOAD = "load_seq"


def _table(table: Table | str) -> Table:
    return TABLES[table] if isinstance(table, str) else table


def _writer(df: DataFrame, t: Table, mode: str, months: str) -> DataFrameWriter:
    writer = df.write.mode(mode).option("partitionOverwriteMode", months).partitionBy(MONTH)
    for c in t.bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.fpp#{c}", "0.01")
    return writer


def write_rows(df: DataFrame, table: Table | str, path: str, mode: str = "append", months: str = "static") -> None:
    """Write rows under their month.

    Replacing a table replaces all its months, whatever the session says; ``months="dynamic"`` replaces those of the rows.

    REBALANCE groups a month's rows so that each task writes few files, and lets AQE split a
    month that is too big for one task and merge small ones.  Rows are sorted inside each
    file, so row-group statistics prune on the sort key; bloom filters serve equality tests.
    """
    t = _table(table)
    out = df.withColumn(MONTH, yyyymm(t.time)).hint("rebalance", MONTH).sortWithinPartitions(MONTH, *t.sort)
    _writer(out, t, mode, months).parquet(path)


def _loaded(df: DataFrame, t: Table, load: Column | int | None) -> DataFrame:
    """Rows in table order with their place in the order of loading, by default the time of the load."""
    load = time.time_ns() // 1000 if load is None else load
    numbered = df.withColumn(LOAD, (load if isinstance(load, Column) else F.lit(load)).cast("bigint"))
    return fill_defaults(numbered, plus(t.schema, **{LOAD: LONG}))


def create(df: DataFrame, table: Table | str, path: str, load: Column | int | None = None) -> None:
    """Replace the table by these rows, with column defaults filled in."""
    t = _table(table)
    write_rows(_loaded(df, t, load), t, path, "overwrite")


def append(df: DataFrame, table: Table | str, path: str, load: Column | int | None = None) -> None:
    """Append rows with column defaults filled in.  No rows is not an error; a failed row
    fails the whole write and leaves nothing behind.

    ``load`` numbers the rows in the order of loading, as one number or a column that also orders
    the rows of one load; give what the source has (an offset, a batch number), so that a repeated
    load stores the same.  Without it the time of the load counts.
    """
    t = _table(table)
    write_rows(_loaded(df, t, load), t, path, "append")


# A newer version is a row like any other; readers pick the winner with latest().
upsert = append


def _stored(spark: SparkSession, t: Table, path: str) -> DataFrame:
    """All stored rows with their month and order of loading."""
    return spark.read.schema(plus(t.schema, **{LOAD: LONG}, yyyymm=INT)).parquet(path)


def read(spark: SparkSession, table: Table | str, path: str, since: dt.date | None = None, loads: bool = False) -> DataFrame:
    """All stored versions; ``since`` skips whole months before that day, ``loads`` adds the order of loading."""
    t = _table(table)
    df = _stored(spark, t, path)
    if since:
        df = df.filter((F.col(MONTH) >= since.year * 100 + since.month) & (F.col(t.time) >= F.lit(since).cast("timestamp")))
    return df.drop(MONTH) if loads else df.drop(MONTH, LOAD)


def read_listings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Nested listing records from Parquet, JSON or another file format with nested types."""
    return spark.read.format(fmt).schema(LISTING).load(path)


def append_listings(listings: DataFrame, path: str, **flatten_options) -> None:
    """Flatten nested listings and append them as new versions."""
    append(flatten(listings, **flatten_options), "listings", path)


def compact(
    spark: SparkSession, table: Table | str, path: str, new_path: str, keys, version: str, tiebreak=()
) -> None:
    """Write the latest versions to a new folder.  Versions are compared across months; of equal ones,
    also by ``tiebreak``, the last loaded stays."""
    t = _table(table)
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    write_rows(latest(read(spark, t, path, loads=True), keys, version, [*ties, LOAD]), t, new_path, "errorifexists")


def purge(spark: SparkSession, table: Table | str, path: str, new_path: str, as_of=None) -> None:
    """Write the rows still inside the table's retention to a new folder."""
    t = _table(table)
    if t.retention_days is None:
        raise ValueError(f"{t.name} keeps its rows forever")
    write_rows(retain(read(spark, t, path, loads=True), t.retention_column, t.retention_days, as_of), t, new_path, "errorifexists")


def _months(df: DataFrame) -> set[int]:
    return {r[0] for r in df.select(MONTH).distinct().collect()}


def _replace_months(spark: SparkSession, t: Table, path: str, kept: DataFrame, rewrite: set[int], drop: set[int]) -> None:
    """Write the ``rewrite`` months anew from ``kept``, then delete the ``drop`` months."""
    if rewrite:
        write_rows(kept.where(F.col(MONTH).isin(sorted(rewrite))).drop(MONTH), t, path, "overwrite", "dynamic")
    for month in sorted(drop):
        drop_folder(spark, f"{path}/{MONTH}={month}")


def expire(spark: SparkSession, table: Table | str, path: str, as_of=None) -> tuple[list[int], list[int]]:
    """Delete what has outlived the table's retention, in place and by the month; return the months rewritten and dropped.

    Two scans of the retention column find the months with expired and with valid rows; file statistics spare all row groups
    that are one or the other as a whole, and where rows expire by the very time they are partitioned by, months on either side
    of the bound are not listed. Months without a valid row are deleted as folders, months with both kinds written anew, the
    others are not touched. An interrupted run is finished by the next.
    """
    t = _table(table)
    if t.retention_days is None:
        raise ValueError(f"{t.name} keeps its rows forever")
    # One instant for all scans.
    as_of = as_of or spark.range(1).select(F.current_timestamp()).first()[0]
    bound = as_of - dt.timedelta(days=t.retention_days)
    rows = _stored(spark, t, path)
    valid, expired = rows.where(F.col(t.retention_column) > bound), rows.where(F.col(t.retention_column) <= bound)
    month = bound.year * 100 + bound.month
    by_time = t.retention_column == t.time
    old = _months(expired.where(F.col(MONTH) <= month) if by_time else expired)
    # A month before the bound's has no valid row, one behind it no expired one.
    both = old & _months(valid.where((F.col(MONTH) == month) if by_time else F.col(MONTH).isin(sorted(old))))
    _replace_months(spark, t, path, valid, both, old - both)
    return sorted(both), sorted(old - both)


def stale_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Places (file, row, month) of the rows that a later version replaces, from a scan of keys and versions alone.

    The newest row of a key is a maximum, combined before the shuffle; everything else is what an anti join on places leaves,
    so a key with a third of all rows loads no task.
    """
    place = ["file", "row"]
    index = rows.select(
        MONTH, *keys, *order, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    newest = index.groupBy(*keys).agg(F.max(F.struct(*order, *place)).alias("_n")).select("_n.file", "_n.row")
    return index.select(*place, MONTH).join(newest, place, "left_anti")


def compact_months(
    spark: SparkSession, table: Table | str, path: str, keys, version: str, tiebreak=(), file_bytes: int = 64 << 20
) -> tuple[list[int], list[int]]:
    """Delete replaced versions in place, rewriting only the months that hold some or many small files; return months rewritten and dropped.

    Versions are compared across months, of equal ones the last loaded stays. Which rows go is decided on keys and versions
    (:func:`stale_rows`); whole rows are read for the chosen months only, so a second run without new data reads no other column.
    An interrupted run is finished by the next.
    """
    t = _table(table)
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    rows = _stored(spark, t, path)
    stale = materialize(stale_rows(rows, list(keys), [version, *ties, LOAD]), "stale")
    gone = {r[0]: r[1] for r in stale.groupBy(MONTH).count().collect()}
    files = rows.groupBy(MONTH, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.first("_metadata.file_size").alias("bytes")
    )
    months = files.groupBy(MONTH).agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes")).collect()
    empty = {m.yyyymm for m in months if gone.get(m.yyyymm) == m.rows}
    small = {m.yyyymm for m in months if m.files > 8 * -(-m.bytes // file_bytes)}
    chosen = (set(gone) | small) - empty
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    whole = rows.where(F.col(MONTH).isin(sorted(chosen))).select("*", *place)
    kept = whole.join(stale.where(F.col(MONTH).isin(sorted(chosen))).drop(MONTH), ["file", "row"], "left_anti")
    _replace_months(spark, t, path, kept.drop("file", "row"), chosen, empty)
    return sorted(chosen), sorted(empty)


def _ordered_number(c: str, kind: T.DataType) -> Column:
    """A column as a number in its own order; of a text its first six bytes."""
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return F.col(c).cast("double")


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on a curve that interleaves the bits of its ranks in ``columns``; a null ranks first.

    Ranks are found at quantiles of the data, so a skewed column uses all its bits; the quantiles (2^bits for each column) are what
    reaches the driver.
    """
    numbers = {c: _ordered_number(c, df.schema[c].dataType) for c in columns}
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*(F.percentile_approx(n, at, 100 << bits).alias(c) for c, n in numbers.items())).first()
    place = F.lit(0).cast("long")
    for j, (c, n) in enumerate(numbers.items()):
        rank = sum((F.coalesce((n > step).cast("int"), F.lit(0)) for step in sorted(set(cuts[c] or ()))), F.lit(0))
        for b in range(bits):
            place = place + F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long"), b * len(numbers) + j)
    return place


def cluster(
    spark: SparkSession, table: Table | str, path: str, new_path: str, columns: Sequence[str] = (), group_bytes: int = 16 << 20
) -> None:
    """Write the table to a new folder ordered along :func:`curve_place` of ``columns``, by default those the table names.

    Rows near in all columns stand together, so minima and maxima of files and row groups prune by each of the columns alone. Ranges of
    (month, place) become files, which also divides a large month; ``group_bytes`` bounds a row group.
    """
    t = _table(table)
    rows = _stored(spark, t, path)
    placed = rows.withColumn("_place", curve_place(rows, list(columns) or list(t.cluster)))
    order = [MONTH, "_place", *t.sort]
    out = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_place")
    _writer(out, t, "errorifexists", "static").option("parquet.block.size", str(group_bytes)).parquet(new_path)
