"""Streaming jobs run over the given tables until they are read, then read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.collections import map_get
from shelfmark.functions.urls import site_base
from shelfmark.plans.pages import ANCHOR_SQL, LISTING_SQL, PAGE_RULES, listing_output
from shelfmark.plans.records import DIFF_SQL, MINUTE_SQL, SOURCE_SQL, events_with_source
from shelfmark.plans.registry import database, money, ntz, query, read
from shelfmark.schemas import LONG, METRICS, PARSING_ERRORS, TEXT, plus, struct
from shelfmark.session import materialize, shared_folder
from shelfmark.sources.streams import stream_source
from shelfmark.streaming import changes, late, monitor, sinks, summaries, topics


def _stream(spark, sf_dir, table):
    return stream_source(spark, "parquet", f"{sf_dir.rstrip('/')}/{table}.parquet", read(spark, sf_dir, table).schema)


def _events(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return _stream(spark, sf_dir, "events").withColumn("source", F.concat(F.lit("s"), (k % 3).cast("string")))


def _in_files(rows, name, order, files, nth=None):
    """A stream of ``rows`` that takes one of ``files`` ranges of ``order`` in each batch, or the rows numbered by ``nth``."""
    spark, path = rows.sparkSession, shared_folder(rows.sparkSession, name)
    dealt = rows.repartitionByRange(files, order).withColumn("_file", F.spark_partition_id()) if nth is None else rows.withColumn("_file", nth)
    stored = materialize(dealt, name)
    # Written one after another: a file stream takes the oldest first.
    for n in range(files):
        stored.where(F.col("_file") == n).drop("_file").coalesce(1).write.mode("append").parquet(path)
    return stream_source(spark, "parquet", path, rows.schema, maxFilesPerTrigger="1")


def _folders(spark, name):
    path = shared_folder(spark, name)
    return f"{path}/table", f"{path}/checkpoint"


@query(f"""
SELECT * FROM ({MINUTE_SQL})
WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 MINUTE
""")
def stream_per_minute(spark, sf_dir):
    """Windows the watermark has closed."""
    table, checkpoint = _folders(spark, "per-minute")
    counts = summaries.summary_per_minute(_events(spark, sf_dir), ts="ts")
    sinks.to_files(counts, table, checkpoint).awaitTermination()
    out = spark.read.schema(counts.schema).parquet(table)
    return out.withColumns({c: ntz(c) for c in ("window_start", "window_end")})


@query(f"SELECT event_type, {SOURCE_SQL} AS source, CAST(count(*) AS DOUBLE) AS metric_value FROM events GROUP BY ALL")
def stream_event_summary(spark, sf_dir):
    """Metric rows appended per micro-batch, summed over the batches."""
    table, checkpoint = _folders(spark, "per-batch")
    summaries.summary_per_batch(_events(spark, sf_dir), table, checkpoint, width=None).awaitTermination()
    metrics = sinks.read_batch_table(spark, table, METRICS)
    labels = (map_get("labels", n).alias(n) for n in ("event_type", "source"))
    return metrics.groupBy(*labels).agg(F.sum("metric_value").alias("metric_value"))


@query(f"""
WITH {ANCHOR_SQL}
SELECT page_id, pos, url, title FROM links QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY pos) = 1
""")
def stream_links(spark, sf_dir):
    """Every link of every arriving page."""
    table, checkpoint = _folders(spark, "links")
    found = monitor.monitor_links(_stream(spark, sf_dir, "pages"), site_base("url"), words=None).drop("id")
    sinks.to_files(found, table, checkpoint).awaitTermination()
    return spark.read.schema(found.schema).parquet(table)


@query(f"WITH {ANCHOR_SQL} SELECT DISTINCT href AS url FROM links")
def stream_new_links(spark, sf_dir):
    """Each link path once, by streaming state."""
    table, checkpoint = _folders(spark, "new-links")
    found = monitor.monitor_links(_stream(spark, sf_dir, "pages"), F.lit(""), words=None).select("page_id", "url")
    fresh = monitor.new_links(found).select("url")
    sinks.to_files(fresh, table, checkpoint).awaitTermination()
    return spark.read.schema(fresh.schema).parquet(table)


@query(f"""
WITH {ANCHOR_SQL}
SELECT href AS url, page_id, pos FROM links QUALIFY row_number() OVER (PARTITION BY href ORDER BY page_id, pos) = 1
""")
def stream_seen_links(spark, sf_dir):
    """Each link path once, by a keyed table of seen ones that each of five batches reads and extends."""
    table, checkpoint = _folders(spark, "seen-links")
    arriving = _in_files(read(spark, sf_dir, "pages").select("page_id", "html"), "pages", F.col("page_id"), 5)
    found = monitor.monitor_links(arriving, F.lit(""), words=None).select("url", "page_id", "pos")
    monitor.collect_new_links(found, table, checkpoint, f"{database(spark)}.seen", parts=8, buckets=4).awaitTermination()
    return sinks.read_batch_table(spark, table, found.schema)


@query(DIFF_SQL + "SELECT * FROM c")
def stream_change_log(spark, sf_dir):
    """The change log of events that arrive in five files, equal to that of the whole table."""
    events = read(spark, sf_dir, "events")
    arriving = _in_files(events, "events", F.struct("ts", "event_id"), 5)
    table, checkpoint = _folders(spark, "changes")
    keys, order = ["user_id", "event_type"], ("ts", "event_id")
    fields = {"value": money("value"), "props": F.col("props")}
    state = f"{database(spark)}.versions"
    changes.log_changes(arriving, table, checkpoint, state, keys, "ts", fields, "event_id", parts=8, buckets=4).awaitTermination()
    return changes.read_changes(spark, table, arriving, keys, *order)


def _ingest(spark, sf_dir):
    table, checkpoint = _folders(spark, "ingest")
    # The pages may come as one file; parsing them is spread over all cores.
    cores = spark.sparkContext.defaultParallelism
    pages = _stream(spark, sf_dir, "pages")
    monitor.ingest_listings(pages, table, checkpoint, PAGE_RULES, partitions=cores).awaitTermination()
    return table


@query(f"SELECT * FROM ({LISTING_SQL}) WHERE id <> ''")
def stream_pages(spark, sf_dir):
    """Arriving pages to stored listing rows; pages without a key become dead letters."""
    return listing_output(monitor.read_ingested(spark, _ingest(spark, sf_dir)))


@query("SELECT url AS source_url, 'no_key' AS error_type FROM pages WHERE NOT regexp_matches(url, '/(\\d+)\\.htm')")
def stream_dead_letters(spark, sf_dir):
    """The other half of the same ingest."""
    return monitor.read_ingested(spark, _ingest(spark, sf_dir), failed=True).select("source_url", "error_type")


@query(r"""
SELECT 'listing' AS kind, regexp_extract(url, '/(\d+)\.htm', 1) AS input, CAST(NULL AS VARCHAR) AS error_type
FROM pages WHERE page_id % 10 <> 9 AND regexp_matches(url, '/(\d+)\.htm')
UNION ALL
SELECT 'error', url, CASE WHEN page_id % 10 = 9 THEN 'status' ELSE 'no_key' END
FROM pages WHERE page_id % 10 = 9 OR NOT regexp_matches(url, '/(\d+)\.htm')
""")
def stream_ingest_bytes(spark, sf_dir):
    """Fetched bytes, a file for each of five batches, to listings and rows of the error table, in one stream."""
    kind = F.col("page_id") % 10
    fetched = read(spark, sf_dir, "pages").select(
        "url",
        F.when(kind % 2 == 1, F.concat(F.encode("html", "UTF-8"), F.lit(b"\xc3"))).otherwise(F.encode("html", "UTF-8")).alias("body"),
        F.when(kind == 9, F.lit(404)).otherwise(F.lit(200)).alias("status"),
    )
    arriving = shared_folder(spark, "fetched")
    fetched.repartition(5).write.parquet(arriving)
    table, checkpoint = _folders(spark, "ingest")
    pages = stream_source(spark, "parquet", arriving, fetched.schema, maxFilesPerTrigger="1")
    monitor.ingest_listings(pages, table, checkpoint, PAGE_RULES, body="body").awaitTermination()
    good = monitor.read_ingested(spark, table).select(F.lit("listing").alias("kind"), F.col("id").alias("input"), F.lit(None).cast("string").alias("error_type"))
    return good.union(monitor.read_errors(spark, table).select(F.lit("error"), "input_data", "error_type"))


@query("""
WITH e AS (SELECT event_id, ts, event_id % 3 AS f, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS w FROM events),
m AS (SELECT f, max(ts) AS m FROM e GROUP BY f),
marks AS (SELECT f, (SELECT date_trunc('millisecond', max(b.m)) FROM m b WHERE b.f < a.f) - INTERVAL 1 MINUTE AS mark FROM m a)
SELECT CASE WHEN w <= mark THEN 'late' ELSE 'on time' END AS kind, event_id, ts FROM e JOIN marks USING (f)
""")
def stream_late_rows(spark, sf_dir):
    """Every event once, on time or late, of three files that each span the whole time."""
    table, checkpoint = _folders(spark, "late")
    events = read(spark, sf_dir, "events")
    arriving = _in_files(events, "events", None, 3, F.col("event_id") % 3)
    late.split_late(arriving, table, checkpoint, "ts").awaitTermination()
    kinds = {"on time": False, "late": True}
    parts = [late.read_split(spark, table, events.schema, is_late).select(F.lit(k).alias("kind"), "event_id", ntz("ts").alias("ts")) for k, is_late in kinds.items()]
    return parts[0].union(parts[1])


@query(f"""
SELECT f AS batch, event_type, {SOURCE_SQL} AS source, CAST(count(*) AS DOUBLE) AS metric_value
FROM (SELECT *, event_id % 3 AS f, max(ts) OVER (PARTITION BY event_id % 3) AS newest FROM events)
WHERE ts >= newest - INTERVAL 1 MINUTE GROUP BY ALL
""")
def stream_last_minute(spark, sf_dir):
    """The event summary of the last minute of each of three batches."""
    table, checkpoint = _folders(spark, "last-minute")
    arriving = _in_files(events_with_source(spark, sf_dir), "events", None, 3, F.col("event_id") % 3)
    summaries.summary_per_batch(arriving, table, checkpoint, "ts", as_of="newest").awaitTermination()
    metrics = spark.read.schema(plus(METRICS, query_id=TEXT, batch_id=LONG)).parquet(table)
    labels = (map_get("labels", n).alias(n) for n in ("event_type", "source"))
    return metrics.select(F.col("batch_id").alias("batch"), *labels, "metric_value")


@query("""
SELECT CASE event_id % 5 WHEN 0 THEN 'metrics' WHEN 1 THEN 'events' WHEN 2 THEN 'events' ELSE 'errors' END AS target,
       CASE WHEN event_id % 5 = 4 THEN '' ELSE CAST(event_id AS VARCHAR) END AS id,
       CASE event_id % 5 WHEN 0 THEN event_type WHEN 3 THEN event_type
         WHEN 4 THEN CASE WHEN event_id % 20 IN (4, 9) THEN 'unknown_topic' WHEN event_id % 20 = 14 THEN 'bad_value' ELSE 'empty' END
         ELSE event_type END AS kind,
       CASE WHEN event_id % 5 = 0 THEN value ELSE 0 END AS metric_value,
       CASE WHEN event_id % 5 IN (1, 2) THEN props WHEN event_id % 5 = 3 THEN 'in' WHEN event_id % 20 = 14 THEN '{"id": 7, "raw_data"'
            WHEN event_id % 20 = 19 THEN '' WHEN event_id % 5 = 4 THEN '{}' ELSE '' END AS text
FROM events
""")
def stream_topics(spark, sf_dir):
    """Envelopes of three topics, some unknown, broken or empty, to three tables in one pass."""
    events = read(spark, sf_dir, "events")
    n, text = F.col("event_id") % 5, F.col("event_id").cast("string")
    value = (
        F.when(n == 0, F.to_json(F.struct(F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"))))
        .when(n < 3, F.to_json(F.struct(text.alias("id"), "event_type", F.col("props").alias("raw_data"))))
        .when(n == 3, F.to_json(F.struct(F.col("event_type").alias("error_type"), F.lit("in").alias("input_data"))))
        .when(F.col("event_id") % 20 == 14, F.lit('{"id": 7, "raw_data"'))
        .when(F.col("event_id") % 20 != 19, F.lit("{}"))
    )
    topic = F.when(n == 0, "metrics").when((n < 3) | (F.col("event_id") % 20 > 10), "events").otherwise("other")
    topic = F.when(n == 3, "errors").otherwise(topic)
    envelopes = events.select(topic.alias("topic"), text.alias("key"), value.alias("value"), "event_id")
    table, checkpoint = _folders(spark, "topics")
    topics.fan_out(_in_files(envelopes, "envelopes", F.col("event_id"), 3), table, checkpoint).awaitTermination()
    got = {t: topics.read_topic(spark, table, t) for t in topics.SCHEMAS}
    none, zero = F.lit(""), F.lit(0.0)
    # A dead letter has an id of its own, made anew by each run.
    own = F.when(F.col("source") == "topics", F.lit("")).otherwise(F.col("id"))
    parts = [
        got["events"].select(F.lit("events").alias("target"), "id", F.col("event_type").alias("kind"), zero.alias("metric_value"), F.col("raw_data").alias("text")),
        got["metrics"].select(F.lit("metrics"), "id", "metric_name", "metric_value", none),
        got["errors"].select(F.lit("errors"), own, "error_type", zero, "input_data"),
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query("""
SELECT CASE WHEN event_id % 40000 = 4 THEN 'poison' ELSE 'stored' END AS kind, event_id,
       CASE WHEN event_id % 40000 = 4 THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS cents FROM events
""")
def stream_poison(spark, sf_dir):
    """A step that raises on few rows: these become dead letters, all others are stored once."""
    table, checkpoint = _folders(spark, "isolated")
    errors = shared_folder(spark, "poison")

    def cents(batch):
        fine = F.when(F.col("event_id") % 40000 == 4, F.raise_error(F.lit("cannot be read"))).otherwise(F.round(F.col("value") * 100))
        return batch.select("event_id", fine.cast("bigint").alias("cents"))

    arriving = _stream(spark, sf_dir, "events")
    sinks.to_isolated_table(arriving, table, errors, checkpoint, cents).awaitTermination()
    good = sinks.read_isolated(spark, table, struct(event_id=LONG, cents=LONG))
    bad = sinks.read_batch_table(spark, errors, PARSING_ERRORS)
    event = F.get_json_object("input_data", "$.event_id").cast("bigint")
    return good.select(F.lit("stored").alias("kind"), "event_id", "cents").union(bad.select("error_type", event, F.lit(None).cast("bigint")))
