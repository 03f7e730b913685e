"""Incremental event summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.analytics import as_metrics, event_summary
from shelfmark.operators.filters import recent
from shelfmark.streaming.sinks import to_batch_table


def summary_per_minute(
    events: DataFrame,
    ts: str = "timestamp",
    event_type: str = "event_type",
    source: str = "source",
    width: str = "1 minute",
    delay: str = "1 minute",
) -> DataFrame:
    """Events per tumbling window and (type, source); works on a stream and on a table.

    On a stream a window is emitted once the watermark (``delay`` behind the newest event)
    has passed its end, and later rows for it are dropped.
    """
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_ts", delay)
    keys = [F.window("_ts", width).alias("w"), F.col(event_type).alias("event_type"), F.col(source).alias("source")]
    counted = timed.groupBy(*keys).agg(F.count("*").cast("double").alias("metric_value"))
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "source", "metric_value"
    )


def summary_per_batch(
    events: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "timestamp",
    width: dt.timedelta | None = dt.timedelta(minutes=1),
    as_of=None,
    **options,
) -> StreamingQuery:
    """Per micro-batch: metric rows over that batch's events of the last minute.

    Each batch sees only itself and appends its own counts.  ``width=None`` takes every event
    of the batch; ``as_of="newest"`` counts the minute back from the batch's newest event, where history is replayed.
    """

    def summarize(batch: DataFrame, _: int) -> DataFrame:
        at = batch.agg(F.max(F.col(ts).cast("timestamp"))).first()[0] if as_of == "newest" else as_of
        if as_of == "newest" and at is None:
            return as_metrics(event_summary(batch))
        rows = batch if width is None else recent(batch, ts, width, at)
        return as_metrics(event_summary(rows))

    return to_batch_table(events, path, checkpoint, summarize, **options)
