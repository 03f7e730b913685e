"""Keyed tables: merge on write, pruning, repeated batches; the change log and the seen links that rest on them."""

import datetime as dt
import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import changes as batch_changes
from shelfmark.plans.registry import database
from shelfmark.schemas import LONG, TEXT, struct
from shelfmark.sources.keyed import Keyed
from shelfmark.sources.streams import stream_source
from shelfmark.streaming import changes, monitor, sinks

SCHEMA = struct(id=TEXT, v=LONG, x=TEXT)


@pytest.fixture
def table(spark):
    return Keyed(f"{database(spark)}.t", SCHEMA, ("id",), 4, 2).create(spark)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, v long, x string")


def content(table, spark):
    return sorted((r.id, r.v, r.x) for r in table.read(spark).collect())


def test_newest_version_wins_and_ties_go_to_the_last_loaded(spark, table):
    table.merge(frame(spark, ("a", 1, "one"), ("b", 5, "b"), ("a", 2, "two"), (None, 1, None)), ["v"])
    table.merge(frame(spark, ("a", 2, "tie"), ("b", 4, "old"), ("c", 1, "c")), ["v"])
    table.merge(frame(spark).limit(0), ["v"])
    assert content(table, spark) == [("", 1, ""), ("a", 2, "tie"), ("b", 5, "b"), ("c", 1, "c")]


def test_merge_rewrites_touched_parts_only_and_drops_old_generations(spark, table):
    table.merge(frame(spark, *((str(i), 1, "x") for i in range(60))), ["v"])
    assert {len(g) for g in table.generations(spark).values()} == {1} and len(table.generations(spark)) == 4
    for n in range(5):
        table.merge(frame(spark, ("7", 2 + n, "y")), ["v"])
    gens = table.generations(spark)
    (part,) = table.touched(frame(spark, ("7", 0, "")))
    # The newest one and the one before it, for a repetition.
    assert gens[part] == [5, 6] and all(g == [1] for p, g in gens.items() if p != part)
    assert table.read(spark).count() == 60 and ("7", 6, "y") in content(table, spark)


def test_stored_side_is_pruned_and_not_shuffled(spark, table):
    table.merge(frame(spark, *((str(i), 1, "x") for i in range(60))), ["v"])
    incoming = frame(spark, ("7", 2, "y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = table.read(spark, parts=table.touched(incoming))
        plan = table.merge_plan(stored, incoming, ["v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left, right = plan.split("SortMergeJoin")[1].split("\n      +- ", 1)
    assert "Bucketed: true" in left and "Exchange" not in left and "PartitionFilters: [isnotnull(gen" in left
    assert "Exchange hashpartitioning" in right and "Bucketed" not in right


def test_a_repeated_batch_stores_the_same(spark, table):
    table.merge(frame(spark, ("a", 1, "one"), ("b", 1, "one")), ["v"], "q", 0)
    table.merge(frame(spark, ("a", 2, "two"), ("c", 1, "c")), ["v"], "q", 1)
    once, gens = content(table, spark), table.generations(spark)
    table.merge(frame(spark, ("a", 2, "two"), ("c", 1, "c")), ["v"], "q", 1)
    assert content(table, spark) == once and table.generations(spark) == gens
    # Another writer counts its own batches.
    table.merge(frame(spark, ("a", 3, "three")), ["v"], "p", 0)
    assert ("a", 3, "three") in content(table, spark)


def bytes_of(df):
    return sum(os.path.getsize(urlparse(f).path) for f in df.inputFiles())


def test_a_small_batch_reads_little_of_a_large_table(spark):
    """Twenty batches of two addresses each: what a batch reads does not grow with the batches before."""
    seen = Keyed(f"{database(spark)}.seen", struct(url=TEXT), ("url",), 16, 1).create(spark)
    urls = spark.range(20_000).select(F.concat(F.lit("/l"), F.sha2(F.col("id").cast("string"), 256)).alias("url"))
    seen.merge(urls, ["url"])
    whole, read = bytes_of(seen.read(spark)), []
    for n in range(20):
        some = spark.createDataFrame([(f"/new{2 * n}",), (f"/new{2 * n + 1}",)], "url string")
        read.append(bytes_of(seen.read(spark, parts=seen.touched(some))))
        seen.merge(some, ["url"])
    assert max(read) <= whole * 2 / 16 * 1.2 and seen.read(spark).count() == 20_040


@pytest.fixture
def versions_in(spark, tmp_path):
    """Files of versions: one key in all of them, one late row, a null key, a tie."""
    day = dt.datetime(2024, 1, 1)
    files = [
        [("a", 0, 1, "x"), ("a", 1, 2, "y"), (None, 0, 3, "n")],
        [("a", 2, 4, "y"), ("b", 0, 5, "b"), (None, 1, 6, "m")],
        [("a", 1, 7, "late"), ("b", 1, 8, None), ("b", 1, 9, "c")],
    ]
    schema, path = "id string, t timestamp, n long, f string", str(tmp_path / "in")
    for rows in files:
        spark.createDataFrame([(i, day + dt.timedelta(t), n, f) for i, t, n, f in rows], schema).coalesce(1).write.mode("append").parquet(path)
    return path, spark.read.parquet(path)


def test_stream_log_goes_on_over_batches_and_repeats_nothing(spark, versions_in, tmp_path):
    path, rows = versions_in
    out, checkpoint, state = str(tmp_path / "out"), str(tmp_path / "cp"), f"{database(spark)}.state"
    arriving = stream_source(spark, "parquet", path, rows.schema, maxFilesPerTrigger="1")

    def run():
        changes.log_changes(arriving, out, checkpoint, state, ["id"], "t", ["f"], "n", parts=4, buckets=2).awaitTermination()
        log = changes.read_changes(spark, out, rows, ["id"], "t", "n")
        return sorted(((r.id, r.n, r.change_type, r.old_value, r.new_value) for r in log.collect()), key=repr)

    expected = [
        ("a", 1, "insert", None, "x"), ("a", 2, "update", "x", "y"), ("a", 7, "update", "y", "late"),
        ("b", 5, "insert", None, "b"), ("b", 8, "update", "b", None), ("b", 9, "update", None, "c"),
        (None, 3, "insert", None, "n"), (None, 6, "update", "n", "m"),
    ]
    assert run() == sorted(expected, key=repr)
    # The last batch is done again, as after a failure behind its writes.
    os.remove(f"{checkpoint}/commits/2")
    os.remove(f"{checkpoint}/commits/.2.crc") if os.path.exists(f"{checkpoint}/commits/.2.crc") else None
    assert run() == sorted(expected, key=repr)


def test_seen_links_repeat_nothing(spark, tmp_path):
    path, out, checkpoint, seen = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), f"{database(spark)}.seen"
    schema = "url string, page_id long, pos long"
    for rows in ([("/a", 1, 1), ("/b", 1, 2), ("/a", 1, 3)], [("/a", 2, 1), ("/c", 2, 2), (None, 2, 3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    arriving = stream_source(spark, "parquet", path, spark.read.parquet(path).schema, maxFilesPerTrigger="1")

    def run():
        monitor.collect_new_links(arriving, out, checkpoint, seen, parts=4, buckets=2).awaitTermination()
        return sorted(((r.url, r.page_id, r.pos) for r in sinks.read_batch_table(spark, out, arriving.schema).collect()), key=repr)

    expected = sorted([("/a", 1, 1), ("/b", 1, 2), ("/c", 2, 2), (None, 2, 3)], key=repr)
    assert run() == expected
    os.remove(f"{checkpoint}/commits/1")
    os.remove(f"{checkpoint}/commits/.1.crc") if os.path.exists(f"{checkpoint}/commits/.1.crc") else None
    assert run() == expected


@pytest.mark.parametrize("hot", [5, 100_000])
def test_hot_key_of_one_version_is_cut(spark, hot):
    """Most rows of a key share one version; the tiebreak divides them, and an earlier row comes before all."""
    rows = spark.range(400).select(
        F.lit("k").alias("id"), F.lit(1).cast("long").alias("t"), F.col("id").alias("n"), (F.col("id") % 7).cast("string").alias("f")
    )
    rows = rows.union(rows.limit(40)).union(spark.createDataFrame([("cold", 1, 1, "c")], rows.schema))
    earlier = spark.createDataFrame([("k", 9, 9, ("before",))], "id string, t long, n long, fields struct<f: string>")
    got = batch_changes.diff_versions(rows, ["id"], "t", ["f"], "n", hot_rows=hot, hot_share=1e-3, earlier=earlier).collect()
    by_n = {r.n: (r.change_type, r.old_value, r.new_value) for r in got if r.id == "k"}
    assert by_n == {n: ("update", "before" if n == 0 else str((n - 1) % 7), str(n % 7)) for n in range(400)}
    assert [(r.change_type, r.new_value) for r in got if r.id == "cold"] == [("insert", "c")]
