import datetime as dt

from pyspark.sql import functions as F

from shelfmark.operators import analytics, changes, filters, versions
from shelfmark.schemas import EVENTS, fill_defaults

ROWS = [(1, "A", 1, 10), (1, "A", 2, 20), (1, "B", 3, 30), (2, "A", 1, 0)]
SCHEMA = "id int, city string, version int, price int"


def stats(df, **options):
    return analytics.summary(
        df, {"priced": F.col("price") > 0}, {"avg_price": F.col("price")}, {"cities": F.col("city")}, **options
    ).first()


def test_latest_per_id_and_city_keeps_a_moved_listing_twice(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    both = versions.latest(df, ["id", "city"], "version")
    s = stats(both, digits=4)
    assert (s.total, s.priced, s.avg_price, s.cities) == (3, 2, 16.6667, 2)
    assert stats(both, positive_only=True).avg_price == 25
    by_id = versions.latest(df, ["id"], "version")
    assert (stats(by_id).total, stats(by_id).avg_price) == (2, 15)


def test_lookup(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert [r.price for r in versions.lookup(df, "id", 1, "version").collect()] == [30]
    assert versions.lookup(df, "id", 9, "version").collect() == []


def test_summary_of_nothing(spark):
    s = stats(spark.createDataFrame([], SCHEMA))
    assert (s.total, s.priced, s.avg_price, s.cities) == (0, 0, None, 0)


def test_latest_has_one_row_per_key_and_first_occurrence_is_idempotent(spark, small):
    ev = spark.read.parquet(f"{small}/events.parquet")
    newest = versions.latest(ev, ["user_id"], "ts", "event_id")
    assert newest.count() == ev.select("user_id").distinct().count()
    once = versions.first_occurrence(ev, ["user_id", "event_type"], ["ts", "event_id"])
    again = versions.first_occurrence(once, ["user_id", "event_type"], ["ts", "event_id"])
    assert once.exceptAll(again).count() == 0 and once.count() == again.count()


def test_equal_versions_fall_to_the_tiebreak(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b")], "id int, v int, seq int, x string")
    assert versions.latest(df, ["id"], "v", "seq").first().x == "b"


def test_new_only(spark):
    inc = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4)], "url string, pos int")
    seen = spark.createDataFrame([("b",), ("b",)], "url string")
    assert sorted(tuple(r) for r in versions.new_only(inc, seen, ["url"], "pos").collect()) == [("a", 1), ("c", 4)]


HISTORY = [(1, 1, 1, "x"), (1, 2, 1, "y"), (1, 3, 2, None)]


def test_change_rows(spark):
    df = spark.createDataFrame(HISTORY, "id int, t int, a int, b string")
    got = changes.diff_versions(df, ["id"], "t", ["a", "b"], pieces=1).collect()
    assert sorted((r.t, r.change_type, r.field_name, r.old_value, r.new_value) for r in got) == [
        (1, "insert", "a", None, "1"),
        (1, "insert", "b", None, "x"),
        (2, "update", "b", "x", "y"),
        (3, "update", "a", "1", "2"),
        (3, "update", "b", "y", None),
    ]


def test_split_history_equals_whole_history(spark, small):
    """One key holds a third of all rows; its pieces must give what the whole window gives."""
    ev = spark.read.parquet(f"{small}/events.parquet").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("user_id"))
    )
    ev = ev.withColumns({"a": F.floor(F.col("value") / 30), "ts": F.when(F.col("event_id") % 40 != 0, F.col("ts"))})
    whole = changes.diff_versions(ev, ["user_id"], "ts", ["a", "event_type"], "event_id", pieces=1)
    parts = changes.diff_versions(ev, ["user_id"], "ts", ["a", "event_type"], "event_id", hot_rows=100)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 4
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_replaying_changes_gives_the_latest_version(spark, small):
    ev = spark.read.parquet(f"{small}/events.parquet").select("event_id", "ts", "user_id", "event_type", "props")
    log = changes.diff_versions(ev, ["user_id"], "ts", ["event_type", "props"], "event_id")
    replayed = versions.latest(log, ["user_id", "field_name"], "ts", "event_id")
    wide = replayed.groupBy("user_id").pivot("field_name", ["event_type", "props"]).agg(F.first("new_value"))
    newest = versions.latest(ev, ["user_id"], "ts", "event_id").select("user_id", "event_type", "props")
    assert wide.exceptAll(newest).count() == 0 and wide.count() == newest.count()


def test_snapshots(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], "id int, v string")
    got = changes.diff_snapshots(old, new, ["id"], ["v"]).collect()
    assert sorted((r.id, r.change_type, r.old_value, r.new_value) for r in got) == [
        (2, "delete", "b", None),
        (3, "update", None, "c"),
        (4, "insert", None, "d"),
    ]
    counts = changes.change_counts(changes.diff_snapshots(old, new, ["id"], ["v"])).collect()
    assert {(r.change_type, r.changes) for r in counts} == {("delete", 1), ("update", 1), ("insert", 1)}


def test_first_seen_ignores_later_versions(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert {tuple(r) for r in versions.first_seen(df, ["id"], "version").collect()} == {(1, 1), (2, 1)}


def test_retention_bound(spark):
    at = [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 0, 0, 1)]
    df = spark.createDataFrame([(a, a.year * 100 + a.month) for a in at], "t timestamp, yyyymm int")
    for month in (None, "yyyymm"):
        kept = filters.retain(df, "t", 90, dt.datetime(2024, 4, 1), month).collect()
        assert [r.t for r in kept] == at[1:]


def test_recent_minute(spark):
    now = dt.datetime(2024, 1, 1, 0, 1)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2023, 12, 31, 23, 59, 59),)], "t timestamp")
    assert filters.recent(df, "t", as_of=now).count() == 1
    assert filters.recent(df, "t").count() == 0


def test_array_search(spark):
    df = spark.createDataFrame(
        [(["m"], "M", 5), (["m"], "M", 15), (["m"], "M", 16), (None, "M", 9), ([None], "M", 9), (["m"], "X", 9)],
        "a array<string>, city string, price int",
    )
    assert sorted(r.price for r in filters.tagged_in_range(df, "a", "m", "city", "M", "price", 5, 15).collect()) == [5, 15]


def test_popularity(spark):
    df = spark.createDataFrame([(["a", "b", ""], 10), (["a"], 20), ([], 5), (None, 7)], "s array<string>, p int")
    got = [tuple(r) for r in analytics.element_popularity(df, "s", F.col("p")).collect()]
    assert got == [("a", 2, 15.0), ("b", 1, 10.0)]


def test_run_counters(spark):
    df = spark.range(50).withColumn("ok", F.col("id") < 47)
    r = analytics.run_counters(df, F.col("ok")).first()
    assert (r.processed, r.succeeded, r.failed, r.success_rate) == (50, 47, 3, 94.0)


def test_sample_events_give_three_metric_rows(spark):
    rows = [("user_action", "web", 15, {"version": "1.0"}), ("system_event", "api", 8, {}), ("error_event", "batch", 23, {})]
    df = spark.createDataFrame(rows, "event_type string, source string, processing_time_ms int, metadata map<string,string>")
    stored = fill_defaults(df, EVENTS)
    assert stored.columns == EVENTS.fieldNames() and stored.select("id").distinct().count() == 3
    metrics = analytics.as_metrics(analytics.event_summary(filters.recent(stored, "timestamp"))).collect()
    assert {(r.metric_name, r.metric_value, r.labels["event_type"], r.labels["source"]) for r in metrics} == {
        ("events_per_minute", 1.0, t, s) for t, s, *_ in rows
    }
