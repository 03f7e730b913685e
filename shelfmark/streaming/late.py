"""Rows behind the watermark, kept beside those in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.schemas import FLAG, LONG, TEXT, TIME, plus, struct
from shelfmark.streaming.sinks import BATCH, QUERY, batch_folder, for_each_batch
from shelfmark.streaming.summaries import summary_per_minute

_MARK = struct(newest=TIME, query_id=TEXT, batch_id=LONG)


def split_late(
    events: DataFrame, path: str, checkpoint: str, ts: str = "timestamp", width: str = "1 minute", delay: str = "1 minute", **options
) -> StreamingQuery:
    """Write every row of a stream once, as on time or late for windows of ``width``.

    A row is late when the watermark had passed the end of its window before its batch began: ``delay`` behind the newest event of
    all batches before, to the millisecond. Spark's own windows drop such rows, though not before one batch more has passed; here
    they are stored under ``late=true``. A row without a time belongs to no window and counts as late.

    A batch leaves its newest time, one row, beside its rows; the watermark is the greatest of those before it, so a repeated batch
    comes to the same decision and overwrites its own folder.
    """
    spark = events.sparkSession
    folder = batch_folder(spark, f"{path}/rows", checkpoint)
    # As window() counts it, which would leave out rows without a time.
    micros, long = F.unix_micros(F.col(ts).cast("timestamp")), F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {width})")
    end = F.timestamp_micros(micros - F.pmod(micros, long) + long)

    def split(batch: DataFrame, batch_id: int) -> None:
        spark, out = batch.sparkSession, folder(batch_id)
        query, mark = out.removeprefix(f"{path}/rows/{QUERY}=").partition("/")[0], out.replace(f"{path}/rows/", f"{path}/marks/")
        passed = F.lit(False)
        if batch_id:
            marks = spark.read.schema(_MARK).parquet(f"{path}/marks").where((F.col(QUERY) == query) & (F.col(BATCH) < batch_id))
            newest = marks.agg(F.date_trunc("millisecond", F.max("newest")).alias("t")).first()["t"]
            if newest is not None:
                passed = end <= F.lit(newest) - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.when(F.col(ts).isNotNull(), passed), F.lit(True))
        rows = batch.select("*", late.alias("late")).write.mode("overwrite").option("partitionOverwriteMode", "static")
        rows.partitionBy("late").parquet(out)
        # The rows as written: the batch itself is not read a second time.
        stored = spark.read.schema(plus(batch.schema, late=FLAG)).parquet(out)
        stored.agg(F.max(F.col(ts).cast("timestamp")).alias("newest")).coalesce(1).write.mode("overwrite").parquet(mark)

    return for_each_batch(events, split, checkpoint, **options)


def read_split(spark: SparkSession, path: str, schema: T.StructType, late: bool) -> DataFrame:
    """The rows written by :func:`split_late` that were late, or those that were on time."""
    stored = spark.read.schema(plus(schema, query_id=TEXT, batch_id=LONG, late=FLAG)).parquet(f"{path}/rows")
    return stored.filter(F.col("late") == F.lit(late)).select(*schema.fieldNames())


def closed_minutes(spark: SparkSession, path: str, schema: T.StructType, ts: str = "timestamp", delay: str = "1 minute", **columns) -> DataFrame:
    """Events per closed window and (type, source) over the rows that were on time."""
    newest = spark.read.schema(_MARK).parquet(f"{path}/marks").agg(F.date_trunc("millisecond", F.max("newest")).alias("t")).first()["t"]
    counted = summary_per_minute(read_split(spark, path, schema, late=False), ts=ts, **columns)
    return counted.filter(F.col("window_end") <= F.lit(newest) - F.expr(f"INTERVAL {delay}"))
