"""One stream of envelopes (topic, key, value) to the tables of its topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.schemas import EVENTS, LONG, METRICS, PARSING_ERRORS, TEXT, default_of, plus, struct
from shelfmark.sources.streams import TOPICS
from shelfmark.streaming.sinks import to_batch_table

#: Topic: the rows its values hold. Topics are those of the sources.
SCHEMAS = dict(zip(TOPICS, (EVENTS, PARSING_ERRORS, METRICS), strict=True))
_BAD = "_bad"


def _filled(value: Column, schema: T.StructType, key: Column) -> Column:
    """A parsed value with defaults for what it lacks; without an id of its own it gets the envelope's key, else a new one."""
    fields = []
    for f in schema.fields:
        own = value.getField(f.name)
        if f.name == "id":
            own = F.coalesce(F.when(own != "", own), F.when(key != "", key), F.uuid())
        fields.append(F.coalesce(own, default_of(f, {})).alias(f.name))
    return F.struct(*fields)


def route(envelopes: DataFrame) -> DataFrame:
    """Envelopes as rows of one wide table: ``target``, and one struct column for each target, filled in the row's own.

    Values are JSON objects, as text or bytes. An unknown topic, a value that is missing, is no JSON object or does not fit the topic's columns
    makes a row of the error table in its place, with the value as its input, so as many rows go out as come in.
    """
    topic, key, value = (F.col(c).cast("string") for c in ("topic", "key", "value"))
    parsed = {
        name: F.when(topic == name, F.from_json(value, plus(schema, **{_BAD: TEXT}), {"columnNameOfCorruptRecord": _BAD}))
        for name, schema in SCHEMAS.items()
    }
    rows = envelopes.select(topic.alias("topic"), key.alias("key"), value.alias("value"), *(c.alias(f"_{n}") for n, c in parsed.items()))
    fails = F.lit(False)
    for name in SCHEMAS:
        fails = fails | ((F.col("topic") == name) & (F.col(f"_{name}").isNull() | F.col(f"_{name}")[_BAD].isNotNull()))
    known = F.coalesce(F.col("topic").isin(*SCHEMAS), F.lit(False))
    problem = (
        F.when(~known, F.lit("unknown_topic"))
        .when(F.coalesce(F.trim("value"), F.lit("")) == "", F.lit("empty"))
        .when(~F.trim("value").startswith("{") | fails, F.lit("bad_value"))
    )
    rows = rows.withColumn("_problem", problem)
    letter = F.struct(
        F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.col("_problem").alias("error_type"),
        F.concat(F.lit("topic "), F.coalesce("topic", F.lit("(none)"))).alias("error_message"),
        F.col("value").alias("input_data"),
        F.lit(None).cast("string").alias("stack_trace"),
        F.lit("topics").alias("source"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )
    good = F.col("_problem").isNull()
    columns = []
    for name, schema in SCHEMAS.items():
        own = F.when(good & (F.col("topic") == name), _filled(F.col(f"_{name}"), schema, F.col("key")))
        if name == "errors":
            own = F.when(~good, _filled(letter, schema, F.lit(""))).otherwise(own)
        columns.append(own.alias(name))
    return rows.select(F.when(good, F.col("topic")).otherwise(F.lit("errors")).alias("target"), *columns)


def fan_out(envelopes: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Write a stream of envelopes to the tables of its topics, each batch in one pass over its input.

    The rows of a target lie under ``target=…`` with only its own struct filled; read them with :func:`read_topic`.
    A repeated batch overwrites what it wrote.
    """
    return to_batch_table(route(envelopes), path, checkpoint, partition_by=("target",), **options)


def read_topic(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The rows of one topic; files of others are not opened."""
    schema = struct(**{topic: SCHEMAS[topic]}, query_id=TEXT, batch_id=LONG, target=TEXT)
    return spark.read.schema(schema).parquet(path).filter(F.col("target") == topic).select(f"{topic}.*")
