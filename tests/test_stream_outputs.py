"""Side outputs of streams: late rows, topics, poison rows."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from shelfmark.schemas import PARSING_ERRORS, LONG, TEXT, struct
from shelfmark.sources.streams import stream_source
from shelfmark.streaming import late, sinks, summaries, topics

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def arriving(spark, tmp_path):
    """A stream that takes one of the given lists of rows in each batch."""

    def make(schema, *batches):
        path = str(tmp_path / "in")
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        return stream_source(spark, "parquet", path, spark.read.parquet(path).schema, maxFilesPerTrigger="1")

    return make


def again(checkpoint, batch):
    for name in (str(batch), f".{batch}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_late_rows_are_kept_and_closed_minutes_hold_the_others(spark, arriving, tmp_path):
    schema = "timestamp timestamp, event_type string, source string, n int"
    batches = [
        [(at(0), "e", "s", 1), (None, "e", "s", 2)],
        [(at(3600), "e", "s", 3)],
        # Behind, in the open window, and exactly at the mark: 3600 - 60 closes the window that ends there.
        [(at(5), "e", "s", 4), (at(3630), "e", "s", 5), (at(3539), "e", "s", 6), (at(3540), "e", "s", 7)],
        [(at(7200), "e", "s", 8)],
    ]
    rows = arriving(schema, *batches)
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        late.split_late(rows, path, checkpoint).awaitTermination()
        return [sorted(r.n for r in late.read_split(spark, path, rows.schema, k).collect()) for k in (False, True)]

    assert run() == [[1, 3, 5, 7, 8], [2, 4, 6]]
    again(checkpoint, 3)
    assert run() == [[1, 3, 5, 7, 8], [2, 4, 6]]
    # The window of the newest event is still open.
    closed = late.closed_minutes(spark, path, rows.schema).collect()
    assert sorted((r.window_start, r.metric_value) for r in closed) == [(at(0), 1.0), (at(3540), 1.0), (at(3600), 2.0)]


def test_topics_and_dead_letters(spark, arriving, tmp_path):
    good = [
        ("events", "k1", json.dumps({"id": "e1", "event_type": "click", "metadata": {"a": "b"}, "timestamp": "2024-01-01T00:00:00Z", "extra": 1})),
        ("events", "k2", json.dumps({"event_type": "view"})),
        ("metrics", "m", json.dumps({"metric_name": "x", "metric_value": 1.5, "labels": {"l": "v"}})),
        ("errors", None, json.dumps({"error_type": "range", "input_data": "in"})),
    ]
    bad = [
        ("other", "k", "{}", "unknown_topic"), (None, "k", "{}", "unknown_topic"), ("events", "k", None, "empty"), ("events", "k", " ", "empty"),
        ("events", "k", '{"id": ', "bad_value"), ("events", "k", "[1]", "bad_value"), ("events", "k", '{"processing_time_ms": "many"}', "bad_value"),
        ("metrics", "k", "plain", "bad_value"),
    ]
    path = str(tmp_path / "out")
    rows = arriving("topic string, key string, value string", good, [b[:3] for b in bad])
    topics.fan_out(rows, path, str(tmp_path / "cp")).awaitTermination()
    found = {t: topics.read_topic(spark, path, t).collect() for t in topics.SCHEMAS}
    first, second = sorted(found["events"], key=lambda r: r.id)
    assert (first.id, first.event_type, first.metadata, first.processing_time_ms, first.timestamp) == ("e1", "click", {"a": "b"}, 0, START)
    assert (second.id, second.raw_data) == ("k2", "") and second.timestamp is not None
    (metric,) = found["metrics"]
    assert (metric.id, metric.metric_value, metric.labels) == ("m", 1.5, {"l": "v"})
    own = [r for r in found["errors"] if r.source != "topics"]
    assert [(r.error_type, r.input_data) for r in own] == [("range", "in")] and own[0].id
    letters = sorted((r.error_type, r.input_data) for r in found["errors"] if r.source == "topics")
    assert letters == sorted((b[3], b[2] or "") for b in bad)
    assert sum(map(len, found.values())) == len(good) + len(bad)
    plan = topics.read_topic(spark, path, "metrics")._jdf.queryExecution().executedPlan().toString()
    assert "(target" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_poison_rows_become_dead_letters(spark, arriving, tmp_path):
    batches = [[(i, None if i % 3 else f"v{i}", {"k": i}) for i in range(500)], [(7, "x", None)] * 4 + [(1000 + i, "x", None) for i in range(20)]]
    rows = arriving("n long, s string, m map<string, int>", *batches)
    path, errors, checkpoint = (str(tmp_path / n) for n in ("out", "bad", "cp"))

    def twice(batch):
        fine = F.when(F.col("n").isin(7, 100, 101, 1003), F.raise_error(F.concat(F.lit("bad "), F.col("n").cast("string")))).otherwise(F.col("n") * 2)
        return batch.select("n", fine.cast("long").alias("twice"), "s")

    def run():
        sinks.to_isolated_table(rows, path, errors, checkpoint, twice).awaitTermination()
        good = sinks.read_isolated(spark, path, struct(n=LONG, twice=LONG, s=TEXT)).collect()
        bad = sinks.read_batch_table(spark, errors, PARSING_ERRORS).collect()
        assert all(r.twice == 2 * r.n for r in good)
        assert {r.error_type for r in bad} == {"poison"} and all("bad " in r.error_message for r in bad)
        return sorted(r.n for r in good), sorted(json.loads(r.input_data)["n"] for r in bad)

    expected = sorted([i for i in range(500) if i not in (7, 100, 101)] + [1000 + i for i in range(20) if i != 3]), [7] * 5 + [100, 101, 1003]
    assert run() == expected
    again(checkpoint, 1)
    assert run() == expected


def test_a_fault_of_everything_is_no_poison(spark, arriving, tmp_path):
    rows = arriving("n long", [(i,) for i in range(50)])

    def fails(batch):
        return batch.select(F.raise_error(F.lit("disk full")).cast("string").alias("x"))

    query = sinks.to_isolated_table(rows, *(str(tmp_path / n) for n in ("out", "bad", "cp")), fails, most_bad=3)
    with pytest.raises(Exception, match="disk full"):
        query.awaitTermination()
    assert not os.path.exists(tmp_path / "bad")


def test_poison_rows_are_searched_side_by_side_in_parts(spark, arriving, tmp_path):
    rows = arriving("n long", [(i,) for i in range(1000)])
    path, errors, checkpoint = (str(tmp_path / n) for n in ("out", "bad", "cp"))
    threads, plans = set(), []

    def same(batch):
        threads.add(threading.get_ident())
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        return batch.select(F.when(F.col("n") % 100 == 7, F.raise_error(F.lit("bad"))).otherwise(F.col("n")).cast("long").alias("n"))

    sinks.to_isolated_table(rows, path, errors, checkpoint, same).awaitTermination()
    good = sorted(r.n for r in sinks.read_isolated(spark, path, struct(n=LONG)).collect())
    bad = sorted(json.loads(r.input_data)["n"] for r in sinks.read_batch_table(spark, errors, PARSING_ERRORS).collect())
    assert (good, bad) == ([i for i in range(1000) if i % 100 != 7], [i for i in range(1000) if i % 100 == 7])
    # Two trials of the batch, one of each part, then about one for each halving of a part and bad row and one for the rest.
    assert len(threads) > 1 and len(plans) < 2 + 32 + 10 * 11
    # A piece reads the folder of its part, whatever the batch holds.
    assert all("_part" in p.split("PartitionFilters")[1].split("PushedFilters")[0] for p in plans[2:])


def test_last_minute_of_each_batch(spark, arriving, tmp_path):
    rows = arriving("timestamp timestamp, event_type string, source string", [(at(0), "a", "s"), (at(90), "a", "s"), (at(100), "b", "s")], [(None, "c", "s")])
    summaries.summary_per_batch(rows, str(tmp_path / "out"), str(tmp_path / "cp"), as_of="newest").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).filter("batch_id = 0")
    assert sorted((r.labels["event_type"], r.metric_value) for r in got.collect()) == [("a", 1.0), ("b", 1.0)]
