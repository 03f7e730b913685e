"""Reports over stored versions, on rows small enough to count by hand."""

import datetime as dt

import pytest

from shelfmark.operators import reports

# id, city, month stored, hour price, stations, tags, width
STORED = [
    ("1", "A", 1, 100, ["x", "y"], ["red"], 5),
    ("1", "A", 2, 200, ["x"], ["red"], 5),
    ("1", "B", 3, 300, ["x", ""], ["red"], 5),
    ("2", "A", 2, 0, [], [], 0),
    ("3", "A", 2, 50, ["y"], ["blue", "red"], 20),
]


@pytest.fixture
def stored(spark):
    rows = [
        (i, c, dt.datetime(2024, m, 1), dt.datetime(2024, m, 1), p, s, t, {"width": w}, False, len(s), "d" if p else "")
        for i, c, m, p, s, t, w in STORED
    ]
    return spark.createDataFrame(
        rows,
        "id string, location_city string, created_at timestamp, updated_at timestamp, price_hour bigint, "
        "location_stations array<string>, tags_available array<string>, attr_num map<string,bigint>, "
        "has_contact boolean, photos_count bigint, description string",
    )


def values(df):
    return [tuple(r) for r in df.collect()]


def test_summary_counts_a_moved_listing_in_both_cities(stored):
    r = reports.summary(stored).first()
    assert (r.total, r.with_price, r.with_photos, r.with_description, r.cities) == (4, 3, 3, 3, 2)
    assert r.avg_price == (200 + 300 + 0 + 50) / 4


def test_latest_or_every_version(stored):
    assert values(reports.average_price_by_city(stored)) == [("B", 1, 300.0), ("A", 2, 125.0)]
    assert values(reports.average_price_by_city(stored, latest_only=False)) == [("B", 1, 300.0), ("A", 3, 350 / 3)]


def test_bands(stored):
    assert values(reports.attribute_distribution(stored, "width", (10,), ("small", "large"))) == [
        ("small", 2, 250.0),
        ("large", 1, 50.0),
    ]
    got = sorted(values(reports.price_ranges(stored, (150,), ("low", "high"))))
    assert got == [("high", 2, 200, 300), ("low", 1, 50, 50)]


def test_search_and_stations(stored):
    assert values(reports.tagged(stored, "red", "A", 50, 200).orderBy("id")) == [("1", 200, "A"), ("3", 50, "A")]
    # The older version of listing 1 matches the range but is no longer current.
    assert values(reports.tagged(stored, "red", "A", 90, 110)) == []
    assert values(reports.station_popularity(stored)) == [("x", 2, 250.0), ("y", 1, 50.0)]


def test_months_count_first_storage_or_every_row(stored):
    assert values(reports.listings_per_month(stored)) == [(202401, 1, 300.0), (202402, 2, 25.0)]
    assert values(reports.listings_per_month(stored, first_seen=False)) == [
        (202401, 1, 100.0),
        (202402, 3, 250 / 3),
        (202403, 1, 300.0),
    ]


def test_days(stored):
    got = {(r.day, r.location_city): (r.n, r.min_value, r.max_value) for r in reports.daily_city_stats(stored).collect()}
    assert got[(dt.date(2024, 2, 1), "A")] == (3, 0, 200) and len(got) == 3
