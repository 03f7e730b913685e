"""Small helpers the operators share: scratch tables, group minima that survive hot keys, shipping code by value."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import materialize, shared_folder

__all__ = ["first_of_group", "in_batches", "lean", "materialize", "read_table", "salt_of", "shared_folder", "ship", "slots"]

register_pickle_by_value(sys.modules[__name__])

#: Salts a key is spread over at least; more where the session shuffles into more partitions.
SALTS = 32


def ship(module: str) -> None:
    """Send a module's functions to executors by value, so that they need no copy of this package."""
    register_pickle_by_value(sys.modules[module])


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the measure of how finely work is dealt out."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salt_of(*cols: str | Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def first_of_group(df: DataFrame, key: str, order: str, salts: int | None = None) -> DataFrame:
    """Add ``first`` (the smallest ``order`` among the rows of ``key``) and ``size`` (their number) to every row.

    The group is reduced per (key, salt) first and the answer joined back on (key, salt): no task ever holds a whole
    group, whatever its size: one in ``salts`` of its rows, by default as many as there are shuffle partitions. Rows of one ``order``
    share a salt. A null key is a group of its own. ``df`` is read twice: pass a written table or a cheap scan.
    """
    salts = salts or max(SALTS, slots(df.sparkSession))
    rows = df.withColumn("_salt", salt_of(order, salts=salts))
    parts = rows.groupBy(key, "_salt").agg(F.min(order).alias("_first"), F.count("*").alias("_size"))
    whole = parts.groupBy(key).agg(
        F.min("_first").alias("first"), F.sum("_size").alias("size"), F.collect_list("_salt").alias("_salts")
    )
    back = whole.select(F.col(key).alias("_key"), "first", "size", F.explode("_salts").alias("_with"))
    joined = rows.join(back, rows[key].eqNullSafe(back["_key"]) & (rows["_salt"] == back["_with"]))
    return joined.drop("_salt", "_key", "_with")


def in_batches(columns: list[Iterator], schema: pa.Schema) -> pa.RecordBatch:
    """Record batch of equally long Python lists or arrays."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def give_back() -> None:
    """Return memory that nothing uses to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving memory back after each batch it is handed and when it ends.

    Python workers outlive their tasks and serve other stages, so what one stage keeps is missing in the next.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            give_back()

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(read(batches))
        give_back()

    return lean_run
