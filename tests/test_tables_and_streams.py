import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.urls import site_base
from shelfmark.operators import versions
from shelfmark.operators.analytics import event_summary
from shelfmark.operators.links import page_links
from shelfmark.plans.pages import PAGE_RULES
from shelfmark.plans.records import events_with_source
from shelfmark.plans.registry import database
from shelfmark.schemas import METRICS, TABLES
from shelfmark.session import shared_folder
from shelfmark.sources import tables
from shelfmark.sources.streams import stream_source, topic_source
from shelfmark.streaming import monitor, sinks, summaries


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def flat_rows(spark, *rows):
    data = [(i, c, dt.datetime(2024, m, 1), dt.datetime(2024, m, 1), p) for i, c, m, p in rows]
    return spark.createDataFrame(data, "id string, location_city string, created_at timestamp, updated_at timestamp, price_hour bigint")


def test_table_life(spark, folder):
    path = folder("listings")
    tables.create(flat_rows(spark, ("1", "A", 1, 10), ("2", "A", 1, 0)), "listings", path)
    tables.append(flat_rows(spark).limit(0), "listings", path)
    tables.upsert(flat_rows(spark, ("1", "A", 2, 20), ("1", "B", 3, 30)), "listings", path)
    stored = tables.read(spark, "listings", path)
    assert stored.count() == 4 and stored.first().pricing_currency == "RUB"
    assert tables.read(spark, "listings", path, since=dt.date(2024, 2, 1)).count() == 2
    tables.compact(spark, "listings", path, folder("compacted"), ["id", "location_city"], "updated_at")
    newest = tables.read(spark, "listings", folder("compacted"))
    assert sorted((r.id, r.location_city, r.price_hour) for r in newest.collect()) == [("1", "A", 20), ("1", "B", 30), ("2", "A", 0)]
    tables.create(flat_rows(spark, ("9", "Z", 1, 1)), "listings", path)
    assert [r.id for r in tables.read(spark, "listings", path).collect()] == ["9"]


def test_month_and_key_filters_reach_the_scan(spark, folder):
    path = folder("listings")
    tables.create(flat_rows(spark, ("1", "A", 1, 10), ("2", "B", 2, 0)), "listings", path)
    plan = tables.read(spark, "listings", path, dt.date(2024, 2, 1)).filter("location_city = 'B'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in text and "EqualTo(location_city,B)" in text
    assert plan.count() == 1


def test_purge_and_tables_without_retention(spark, folder):
    rows = [("a", dt.datetime(2024, 1, 2)), ("b", dt.datetime(2024, 1, 2, 0, 0, 1))]
    df = spark.createDataFrame([(i, t, t) for i, t in rows], "id string, timestamp timestamp, created_at timestamp")
    tables.append(df, "events", folder("events"))
    tables.purge(spark, "events", folder("events"), folder("kept"), dt.datetime(2024, 4, 1))
    assert [r.id for r in tables.read(spark, "events", folder("kept")).collect()] == ["b"]
    assert {t.name: t.retention_days for t in TABLES.values() if t.retention_days} == {
        "events": 90, "metrics": 30, "parsing_errors": 30, "listing_changes": 180,
    }
    with pytest.raises(ValueError):
        tables.purge(spark, "listings", folder("events"), folder("x"))


def test_latest_prunes_before_the_shuffle(spark, small):
    ev = spark.read.parquet(f"{small}/events.parquet")
    plan = versions.latest(ev, ["user_id"], "ts", "event_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan.split("Exchange")[-1]


def test_only_page_jobs_use_python(spark, small):
    from shelfmark.plans import QUERIES

    # page_charset also zips its pages, to have something to unzip.
    python = {"page_decode": 1, "page_elements": 1, "page_listings": 1, "detail_pages": 1, "page_charset": 2}
    for name, fn in QUERIES.items():
        if name.startswith(("stream", "table", "change_log_table", "link_export", "url_export", "dead_letters")):
            continue
        plan = fn(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name
        assert plan.count("ArrowEvalPython") == python.get(name, 0), name


@pytest.fixture
def event_files(spark, small, folder):
    """Events as four files in time order."""
    ev = events_with_source(spark, small).withColumn("ts", F.col("ts").cast("timestamp"))
    path = folder("events-in")
    for i, cut in enumerate(((1, 9), (9, 17), (17, 25), (25, 40))):
        day = F.dayofmonth("ts")
        ev.filter((day >= cut[0]) & (day < cut[1])).coalesce(1).write.mode("append").parquet(path)
    return path, ev


def stream(spark, path, df, **options):
    return stream_source(spark, "parquet", path, df.schema, maxFilesPerTrigger="1", **options)


def test_closed_minutes_equal_the_batch(spark, event_files, folder):
    path, ev = event_files
    counts = summaries.summary_per_minute(stream(spark, path, ev), ts="ts", delay="10 minutes")
    late = sinks.LateRows.attach(spark)
    query = sinks.to_files(counts, folder("out"), folder("cp"))
    query.awaitTermination()
    got = spark.read.parquet(folder("out"))
    end = ev.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    batch = summaries.summary_per_minute(ev, ts="ts").filter(F.col("window_end") <= F.lit(end))
    assert got.count() > 500 and got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert late.of(query) == 0
    spark.streams.removeListener(late)


def test_late_rows_are_dropped_and_counted(spark, folder):
    path, schema = folder("in"), "timestamp timestamp, event_type string, source string"
    # A row is late when the watermark had passed its window before the batch it came in began.
    for minute, second in ((0, 0), (60, 0), (60, 30), (0, 5)):
        t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute, seconds=second)
        spark.createDataFrame([(t, "e", "s")], schema).coalesce(1).write.mode("append").parquet(path)
    df = spark.read.parquet(path)
    late = sinks.LateRows.attach(spark)
    query = sinks.to_files(summaries.summary_per_minute(stream(spark, path, df)), folder("out"), folder("cp"))
    query.awaitTermination()
    assert [r.metric_value for r in spark.read.parquet(folder("out")).collect()] == [1.0]
    assert late.of(query) == 1
    spark.streams.removeListener(late)


def test_batch_summary_sees_only_its_batch(spark, event_files, folder):
    path, ev = event_files
    summaries.summary_per_batch(stream(spark, path, ev), folder("out"), folder("cp"), width=None).awaitTermination()
    metrics = sinks.read_batch_table(spark, folder("out"), METRICS)
    assert metrics.count() == 4 * event_summary(ev).count()
    keys = [F.col("labels")[n].alias(n) for n in ("event_type", "source")]
    summed = metrics.groupBy(*keys).agg(F.sum("metric_value").alias("metric_value"))
    assert summed.exceptAll(event_summary(ev)).count() == 0
    # Old events are outside the last minute.
    summaries.summary_per_batch(stream(spark, path, ev), folder("o2"), folder("c2"), ts="ts").awaitTermination()
    assert sinks.read_batch_table(spark, folder("o2"), METRICS).count() == 0


@pytest.fixture
def page_files(spark, small, folder):
    """Two visits of the same pages, in four files."""
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for _ in range(2):
        pages.repartition(2, "page_id").write.mode("append").parquet(folder("pages-in"))
    return folder("pages-in"), pages


def test_every_visit_emits_links_but_new_links_come_once(spark, page_files, folder):
    path, pages = page_files
    batch = page_links(pages, site_base("url"), words=None, dedup=True)
    found = monitor.monitor_links(stream(spark, path, pages), site_base("url"), words=None)
    sinks.to_files(found, folder("all"), folder("c1")).awaitTermination()
    assert spark.read.parquet(folder("all")).count() == 2 * batch.count()
    urls = batch.select("url").distinct()
    for salts in (1, 4):
        sinks.to_files(monitor.new_links(found, salts=salts), folder(f"new{salts}"), folder(f"c2{salts}")).awaitTermination()
        new = spark.read.parquet(folder(f"new{salts}")).select("url")
        assert new.count() == urls.count() and urls.exceptAll(new).count() == 0
    monitor.collect_new_links(found, folder("seen"), folder("c3"), f"{database(spark)}.seen", parts=4, buckets=2).awaitTermination()
    seen = sinks.read_batch_table(spark, folder("seen"), found.schema)
    assert seen.count() == urls.count() and urls.exceptAll(seen.select("url")).count() == 0


def test_new_links_within_a_watermark(spark, page_files, folder):
    path, pages = page_files
    found = monitor.monitor_links(
        stream(spark, path, pages).withColumn("at", F.lit("2024-01-01").cast("timestamp")), F.lit(""), words=None, keep=("page_id", "at")
    )
    fresh = monitor.new_links(found, watermark=("at", "1 hour"))
    sinks.to_files(fresh, folder("out"), folder("cp")).awaitTermination()
    got = spark.read.parquet(folder("out"))
    assert got.count() == got.select("url").distinct().count() > 0


def test_ingest_equals_batch_and_a_fresh_checkpoint_loses_nothing(spark, page_files, folder):
    path, pages = page_files
    monitor.ingest_listings(stream(spark, path, pages), folder("t"), folder("cp"), PAGE_RULES).awaitTermination()
    good, bad = monitor.read_ingested(spark, folder("t")), monitor.read_ingested(spark, folder("t"), failed=True)
    assert good.count() + bad.count() == 2 * pages.count() and bad.filter("error_type <> 'no_key'").count() == 0
    batch = monitor.ingest_rows(pages, PAGE_RULES).filter("error_type is null")
    stored = good.count()
    newest = versions.latest(good, ["source_url", "title"], "updated_at")
    assert newest.select("id", "title").exceptAll(batch.select("id", "title")).count() == 0
    # A query started anew on a fresh checkpoint counts its batches from 0 again, beside the earlier ones.
    monitor.ingest_listings(stream(spark, path, pages), folder("t"), folder("cp2"), PAGE_RULES).awaitTermination()
    assert monitor.read_ingested(spark, folder("t")).count() == 2 * stored
    # One that goes on where it was adds nothing twice.
    monitor.ingest_listings(stream(spark, path, pages), folder("t"), folder("cp2"), PAGE_RULES).awaitTermination()
    assert monitor.read_ingested(spark, folder("t")).count() == 2 * stored


def test_callback_and_counters(spark, page_files, folder):
    path, pages = page_files
    sizes = []
    watched = sinks.observed(stream(spark, path, pages), "run", F.length("html") > 1000)
    sinks.for_each_batch(watched, lambda batch, i: sizes.append((i, batch.count())), folder("cp")).awaitTermination()
    assert [i for i, _ in sizes] == [0, 1, 2, 3] and sum(n for _, n in sizes) == 2 * pages.count()


def test_sources(spark, small):
    assert stream_source(spark, "rate", rowsPerSecond="1").isStreaming
    with pytest.raises(ValueError):
        topic_source(spark, "unknown", "host:9092")


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and "/x-" in one
    assert root is None or one.startswith(root.rstrip("/") + "/")
