"""Dead letters: rows that failed go to an error table, the rest continues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.schemas import FLAG, PARSING_ERRORS, fill_defaults, plus


def with_outcome(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add ``error_type`` and ``error_message`` from the first check that gives a message."""
    error_type, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, found in reversed(checks.items()):
        error_type = F.when(found.isNotNull(), F.lit(name)).otherwise(error_type)
        message = F.when(found.isNotNull(), found).otherwise(message)
    return df.withColumns({"error_type": error_type, "error_message": message})


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error_type").isNull()).drop("error_type", "error_message")


def error_rows(df: DataFrame, input_data: Column, source: Column, at: Column | None = None) -> DataFrame:
    """Failed rows in the shape of the error table."""
    failed = df.filter(F.col("error_type").isNotNull()).select(
        "error_type",
        "error_message",
        input_data.cast("string").alias("input_data"),
        source.cast("string").alias("source"),
        *([at.cast("timestamp").alias("timestamp")] if at is not None else []),
    )
    return fill_defaults(failed, PARSING_ERRORS)


def write_split(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write rows with an outcome once, split by it, and return (good, failed) readers.

    One pass over the input and no cache; each reader touches only its own half.
    """
    df.withColumn("failed", F.col("error_type").isNotNull()).write.partitionBy("failed").parquet(path)
    both = df.sparkSession.read.schema(plus(df.schema, failed=FLAG)).parquet(path)
    good = both.filter(~F.col("failed")).drop("failed", "error_type", "error_message")
    return good, both.filter(F.col("failed")).drop("failed")
