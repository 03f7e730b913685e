"""Expiry, compaction and clustering of month tables: what they keep, and what they do not touch or read."""

import datetime as dt
import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfmark.sources import tables


def events(spark, *rows):
    data = [(str(i), dt.datetime(2024, m, d), dt.datetime(2024, *(c or (m, d))), e) for i, m, d, c, e in rows]
    return spark.createDataFrame(data, "id string, timestamp timestamp, created_at timestamp, event_type string")


def files(path):
    return {str(p): os.stat(p).st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_expire_drops_months_and_rewrites_one(spark, tmp_path):
    path = str(tmp_path / "t")
    # The last row is old by its month, but was created late: its month is not dropped.
    rows = [(1, 1, 5, None, "a"), (2, 2, 10, None, "b"), (3, 2, 20, None, "c"), (4, 3, 1, None, "d"), (5, 4, 1, None, "e"), (6, 1, 6, (4, 2), "f")]
    tables.append(events(spark, *rows), "events", path, load=1)
    before = files(path)
    as_of = dt.datetime(2024, 2, 15) + dt.timedelta(90)
    assert tables.expire(spark, "events", path, as_of) == ([202401, 202402], [])
    assert sorted(r.id for r in tables.read(spark, "events", path).collect()) == ["3", "4", "5", "6"]
    after = files(path)
    assert all(after.get(f) == t for f, t in before.items() if "=202403" in f or "=202404" in f)
    assert tables.expire(spark, "events", path, as_of) == ([], [])
    with pytest.raises(ValueError):
        tables.expire(spark, "listings", path)


def test_expiry_by_the_partitioned_time_lists_no_other_month(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(str(m), dt.datetime(2024, m, d)) for m in (1, 2, 3, 4) for d in (5, 25)]
    log = spark.createDataFrame(data, "listing_id string, change_timestamp timestamp")
    tables.append(log, "listing_changes", path)
    as_of = dt.datetime(2024, 3, 10) + dt.timedelta(180)
    assert tables.expire(spark, "listing_changes", path, as_of) == ([202403], [202401, 202402])
    left = tables.read(spark, "listing_changes", path).collect()
    assert sorted((r.listing_id, r.change_timestamp.day) for r in left) == [("3", 25), ("4", 5), ("4", 25)]
    assert not any("=202401" in f for f in files(path))


def test_an_instant_is_taken_where_none_is_given(spark, tmp_path):
    path = str(tmp_path / "t")
    now = spark.range(1).select(F.current_timestamp().alias("timestamp"), F.lit("new").alias("id"), F.current_timestamp().alias("created_at"))
    tables.append(events(spark, (1, 1, 5, None, "a")).select("timestamp", "id", "created_at").union(now), "events", path)
    assert tables.expire(spark, "events", path) == ([], [202401])
    assert [r.id for r in tables.read(spark, "events", path).collect()] == ["new"]


def test_compact_by_month_across_months_and_again(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("a", 1, 5, None, "old"), ("b", 1, 6, None, "only"), ("c", 2, 1, None, "old"), ("d", 3, 1, None, "tie1"), ("e", 5, 1, None, "alone")]
    tables.append(events(spark, *first), "events", path, load=1)
    tables.append(events(spark, ("a", 3, 2, None, "new"), ("c", 4, 1, None, "new"), ("d", 3, 1, None, "tie2")), "events", path, load=2)
    before = files(path)
    # February held nothing but a replaced version.
    assert tables.compact_months(spark, "events", path, ["id"], "timestamp") == ([202401, 202403], [202402])
    got = {r.id: r.event_type for r in tables.read(spark, "events", path).collect()}
    assert got == {"a": "new", "b": "only", "c": "new", "d": "tie2", "e": "alone"}
    after = files(path)
    assert all(after.get(f) == t for f, t in before.items() if "=202404" in f or "=202405" in f)
    assert tables.compact_months(spark, "events", path, ["id"], "timestamp") == ([], [])
    assert files(path) == after


def test_equal_rows_compact_to_one(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        tables.append(events(spark, ("a", 1, 5, None, "x")).union(events(spark, ("a", 1, 5, None, "x"))), "events", path, load=7)
    tables.compact_months(spark, "events", path, ["id"], "timestamp")
    assert tables.read(spark, "events", path).count() == 1


def test_small_files_are_joined(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(12):
        tables.append(events(spark, (n, 1, 5, None, "x")), "events", path, load=n)
    assert tables.compact_months(spark, "events", path, ["id"], "timestamp") == ([202401], [])
    assert len(files(path)) < 12 and tables.read(spark, "events", path).count() == 12
    assert tables.compact_months(spark, "events", path, ["id"], "timestamp") == ([], [])


def test_finding_stale_rows_reads_keys_and_versions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(events(spark, ("a", 1, 5, None, "x")), "events", path)
    rows = tables._stored(spark, tables._table("events"), path)
    plan = tables.stale_rows(rows, ["id"], ["timestamp", tables.LOAD])._jdf.queryExecution().executedPlan().toString()
    read = {c.split(":")[0] for s in plan.split("ReadSchema: struct<")[1:] for c in s.split(">")[0].split(",")}
    assert read == {"id", "timestamp", "load_seq", "_tmp_metadata_row_index"}


def listing_rows(spark, n):
    i = F.col("id")
    return spark.range(n).select(
        i.cast("string").alias("id"),
        F.concat(F.lit("city"), F.pmod(F.hash(i), F.lit(40)).cast("string")).alias("location_city"),
        F.pmod(F.xxhash64(i), F.lit(10_000)).alias("price_hour"),
        F.lit(dt.datetime(2024, 1, 3)).alias("created_at"),
        F.timestamp_add("MINUTE", F.pmod(F.xxhash64(i, F.lit(1)), F.lit(40_000)).cast("int"), F.lit(dt.datetime(2024, 1, 1))).alias("updated_at"),
    )


def groups(path, column, low, high):
    """Row groups whose range of a column meets [low, high], and all."""
    hit = total = 0
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= high and stats.max >= low
    return hit, total


def test_clustered_files_prune_by_each_column(spark, tmp_path):
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    tables.append(listing_rows(spark, 60_000).repartition(8), "listings", plain)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.cluster(spark, "listings", plain, clustered, group_bytes=100_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = tables.read(spark, "listings", clustered)
    names = ["id", "location_city", "price_hour", "updated_at"]
    assert rows.select(names).exceptAll(tables.read(spark, "listings", plain).select(names)).count() == 0 and rows.count() == 60_000
    price = groups(clustered, "price_hour", 4000, 4100)
    time = groups(clustered, "updated_at", dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 10, 6, tzinfo=dt.timezone.utc))
    city = groups(clustered, "location_city", "city7", "city7")
    assert price[1] >= 24
    for hit, total in (price, time, city):
        assert 0 < hit <= total * 0.6, (price, time, city)
    found = rows.filter(F.col("price_hour").between(4000, 4100))
    assert found.count() == tables.read(spark, "listings", plain).filter(F.col("price_hour").between(4000, 4100)).count() > 0


def test_curve_keeps_the_order_of_one_column(spark):
    df = spark.createDataFrame([(None, "x"), (1, "ä"), (5, "b"), (9, "a"), (9, None)], "n int, s string")
    by_n = df.withColumn("z", tables.curve_place(df, ["n"])).orderBy("z", "s").collect()
    assert [r.n for r in by_n] == [None, 1, 5, 9, 9] and len({r.z for r in by_n}) >= 3
    by_s = df.withColumn("z", tables.curve_place(df, ["s"])).orderBy("z", "s").collect()
    assert [r.s for r in by_s] == [None, "a", "b", "x", "ä"]
    none = df.limit(0)
    assert none.withColumn("z", tables.curve_place(none, ["n", "s"])).collect() == []
