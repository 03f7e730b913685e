import datetime as dt

import pytest
from shelfmark.operators import flatten as FL
from shelfmark.schemas import LISTING, LISTING_COLUMNS, fill_defaults, struct, TEXT, LONG
from shelfmark.sources import quality

AT = dt.datetime(2024, 1, 5, 12)


def listing(**over):
    base = dict.fromkeys(LISTING.fieldNames())
    return base | {"id": "1", "source_url": "u", "scraped_at": AT} | over


def pricing(**prices):
    return {"duration_prices": prices, "service_prices": {}, "currency": ""}


def flat(spark, *rows, **options):
    return FL.flatten(spark.createDataFrame(list(rows), LISTING), **options).collect()


@pytest.mark.parametrize(
    "prices, expected",
    [
        ({"apartments_day_hour": 5000, "outcall_day_hour": 7000}, (5000, 0, 0, 0, 5000)),
        ({"apartments_day_hour": 0, "outcall_day_hour": 7000}, (7000, 0, 0, 0, 7000)),
        ({"час": 0, "hour": 900}, (0, 0, 0, 0, 0)),
        ({"hour": 900, "base": 0}, (900, 0, 0, 0, 0)),
        ({"apartments_day_2hour": 9000, "day": 1}, (0, 9000, 0, 9000, 0)),
        ({"outcall_night_hour": 6000, "ночь": 1}, (0, 0, 6000, 0, 0)),
        ({"2 часа": 3, "день": 4, "night": 5}, (0, 3, 5, 4, 0)),
        ({}, (0, 0, 0, 0, 0)),
    ],
)
def test_price_ladder(spark, prices, expected):
    r = flat(spark, listing(pricing=pricing(**prices)))[0]
    assert (r.price_hour, r.price_2_hours, r.price_night, r.price_day, r.price_base) == expected


def test_defaults(spark):
    no_pricing, blank, named = flat(
        spark,
        listing(),
        listing(pricing=pricing(), location={"stations": None, "district": None, "city": "", "offsite": None, "onsite": None}),
        listing(pricing=pricing() | {"currency": "EUR"}, location={"stations": ["a"], "district": "d", "city": "C", "offsite": True, "onsite": False}),
    )
    assert (no_pricing.pricing_currency, no_pricing.location_city) == ("", "Unknown")
    assert (blank.pricing_currency, blank.location_city) == ("RUB", "Unknown")
    assert (named.pricing_currency, named.location_city, named.location_stations) == ("EUR", "C", ["a"])
    assert no_pricing.tags_available == [] and no_pricing.attr_num == {} and no_pricing.title == ""


def test_columns_and_stamps(spark):
    r = flat(spark, listing(photos=["a", "b"], attrs={"num": {"w": 3}, "str": {"c": "red"}}))[0]
    assert list(r.asDict()) == LISTING_COLUMNS
    assert (r.created_at, r.updated_at, r.last_scraped) == (AT, AT, AT)
    assert (r.photos_count, r.attr_num, r.attr_str) == (2, {"w": 3}, {"c": "red"})
    now = flat(spark, listing(scraped_at=None), listing(scraped_at=None))
    assert len({r.created_at for r in now}) == 1 and now[0].created_at > AT


def test_out_of_range_wraps_or_becomes_a_dead_letter(spark):
    bad = listing(pricing=pricing(hour=-1, base=5), attrs={"num": {"w": 70000}, "str": {}})
    r = flat(spark, bad, policy="wrap")[0]
    assert (r.price_hour, r.attr_num["w"]) == (4294967295, 4464)
    df = spark.createDataFrame([bad, listing(id="2")], LISTING)
    checked = quality.with_outcome(df, {"range": FL.range_error()})
    assert [(x.id, x.error_message) for x in checked.orderBy("id").collect()] == [("1", "attribute out of range"), ("2", None)]
    assert [x.id for x in quality.good_rows(checked).collect()] == ["2"]


def test_computed_columns_need_edges(spark):
    df = spark.createDataFrame([("ю", ["p"], 5), ("", [], 50), (None, None, None)], "description string, photos array<string>, price int")
    got = FL.with_computed(df, {"price_range": ("price", (10,), ("low", "high"))}).collect()
    assert [(r.description_length, r.has_photos, r.price_range) for r in got] == [(2, True, "low"), (0, False, "high"), (0, False, None)]


def test_fill_defaults_keeps_values(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("x", None)], "city string, n int")
    schema = struct(city=TEXT, n=LONG, extra=TEXT)
    got = [tuple(r) for r in fill_defaults(df, schema, {"city": "U"}).collect()]
    assert got == [("U", 1, ""), ("", 2, ""), ("x", 0, "")]
    assert fill_defaults(df, schema, {"city": "U"}, blank=True).collect()[1].city == "U"


def test_ladder_on_its_own(spark):
    df = spark.createDataFrame([({"a": 0, "it's": 3},)], "m map<string,bigint>")
    assert df.select(FL.price_ladder("m", ["a", "it's"], [])).first()[0] == 3
    assert df.select(FL.price_ladder("m", ["a"], ["zz", "a"])).first()[0] == 0
