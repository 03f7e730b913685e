"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Topic names and their partition counts.
TOPICS = {"events": 3, "errors": 3, "metrics": 1}


def stream_source(spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | None = None, **options) -> DataFrame:
    """A streaming reader.

    File formats need ``path`` (a folder, or one file) and ``schema``.  Other formats, such as
    ``kafka``, take their options as they are and need their connector on the class path.  Unless
    the options say otherwise, a batch of a file stream takes 1000 files, so that a large folder
    is not one batch.
    """
    if path is not None and not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(options):
        options["maxFilesPerTrigger"] = "1000"
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if path is None:
        return reader.load()
    # A glob of the last path part works for a single file as well as for a folder.
    head, _, tail = path.rstrip("/").rpartition("/")
    return reader.load(f"{head}/{{{tail}}}" if head or path.startswith("/") else f"{{{tail}}}")


def topic_source(spark: SparkSession, topic: str, servers: str, **options) -> DataFrame:
    """One of the event topics as a Kafka stream (needs the Kafka connector)."""
    if topic not in TOPICS:
        raise ValueError(f"unknown topic {topic!r}")
    return stream_source(
        spark, "kafka", **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **options}
    )
