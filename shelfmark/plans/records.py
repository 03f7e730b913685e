"""Queries over events, orders, customers, parts and documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfmark.functions.collections import bucketize, has_key, map_get
from shelfmark.functions.text import (
    CONTACT_PATTERN,
    checked_unsigned,
    date_from_text,
    has_contact,
    mask_contacts,
    parse_date,
    parse_price,
    yyyymm,
)
from shelfmark.operators import analytics, changes, filters, flatten, reports, versions
from shelfmark.plans.registry import database, money, ntz, query, read
from shelfmark.schemas import LISTING, LONG, TABLES, TEXT, fill_defaults, plus, struct
from shelfmark.sources import tables
from shelfmark.sources.keyed import Keyed
from shelfmark.session import shared_folder
from shelfmark.streaming.summaries import summary_per_minute

# A fixed "now" for the queries that need one.
AS_OF = dt.datetime(2024, 1, 31)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
# Where the queries that compare "before" with "after" divide the events.
CUT = dt.datetime(2024, 1, 16)
CUT_SQL = "TIMESTAMP '2024-01-16 00:00:00'"


def _avg_sql(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c})"


# ---------------------------------------------------------------- versions

LATEST = "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC, event_id DESC) = 1"


@query(f"""
WITH v AS ({LATEST.format(keys="user_id")})
SELECT count(*) AS total,
       count(*) FILTER (WHERE event_type = 'error') AS errors,
       count(*) FILTER (WHERE value > 50) AS high_value,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       count(*) FILTER (WHERE length(props) > 8) AS with_props,
       {_avg_sql("value")} AS avg_value,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE) / count(*) AS avg_k,
       count(DISTINCT event_type) AS types
FROM v
""")
def stats_latest(spark, sf_dir):
    rows = versions.latest(read(spark, sf_dir, "events"), ["user_id"], "ts", "event_id")
    return analytics.summary(
        rows,
        counts={
            "errors": F.col("event_type") == "error",
            "high_value": F.col("value") > 50,
            "purchases": F.col("event_type") == "purchase",
            "with_props": F.length("props") > 8,
        },
        averages={"avg_value": money("value"), "avg_k": F.get_json_object("props", "$.k").cast("bigint")},
        distinct={"types": F.col("event_type")},
    )


@query("""
SELECT count(*) AS total,
       count(*) FILTER (WHERE c_acctbal > 0) AS in_credit,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) FILTER (WHERE c_acctbal > 0) AS DOUBLE)
             / count(*) FILTER (WHERE c_acctbal > 0) AS avg_balance,
       count(DISTINCT c_nationkey) AS nations
FROM customer
""")
def summary_positive(spark, sf_dir):
    return analytics.summary(
        read(spark, sf_dir, "customer"),
        counts={"in_credit": F.col("c_acctbal") > 0},
        averages={"avg_balance": money("c_acctbal")},
        distinct={"nations": F.col("c_nationkey")},
        positive_only=True,
    )


@query(LATEST.format(keys="user_id, event_type"))
def latest_two_keys(spark, sf_dir):
    return versions.latest(read(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id")


@query(LATEST.format(keys="user_id"))
def latest_by_id(spark, sf_dir):
    return versions.latest(read(spark, sf_dir, "events"), ["user_id"], "ts", "event_id")


# One key is the point of this query: it is the point lookup of the catalogue.
@query("SELECT * FROM events WHERE user_id = 7 ORDER BY ts DESC, event_id DESC LIMIT 1")
def listing_lookup(spark, sf_dir):
    return versions.lookup(read(spark, sf_dir, "events"), "user_id", 7, "ts", "event_id")


@query(f"""
WITH seen AS (SELECT DISTINCT user_id, event_type, CAST(floor(value) AS BIGINT) AS amount FROM events WHERE ts < {CUT_SQL})
SELECT user_id, event_type, CAST(floor(value) AS BIGINT) AS amount, min(event_id) AS event_id
FROM events
WHERE ts >= {CUT_SQL} AND NOT EXISTS (
  SELECT 1 FROM seen s WHERE s.user_id = events.user_id AND s.event_type = events.event_type
                         AND s.amount = CAST(floor(events.value) AS BIGINT))
GROUP BY ALL
""")
def new_only(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(
        "ts", "event_id", "user_id", "event_type", F.floor("value").cast("bigint").alias("amount")
    )
    keys = ["user_id", "event_type", "amount"]
    fresh = versions.new_only(rows.filter(F.col("ts") >= CUT), rows.filter(F.col("ts") < CUT), keys, "event_id")
    return fresh.select(*keys, "event_id")


# ---------------------------------------------------------------- change log

DIFF_SQL = """
WITH v AS (
  SELECT user_id, event_type, ts, event_id,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value, props,
         lag(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)) OVER w AS old_value, lag(props) OVER w AS old_props,
         row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
), c AS (
  SELECT user_id, event_type, ts, event_id, CASE WHEN rn = 1 THEN 'insert' ELSE 'update' END AS change_type,
         'value' AS field_name, old_value, value AS new_value FROM v WHERE rn = 1 OR old_value IS DISTINCT FROM value
  UNION ALL
  SELECT user_id, event_type, ts, event_id, CASE WHEN rn = 1 THEN 'insert' ELSE 'update' END,
         'props', old_props, props FROM v WHERE rn = 1 OR old_props IS DISTINCT FROM props
)
"""


def _changes(spark, sf_dir):
    return changes.diff_versions(
        read(spark, sf_dir, "events"),
        ["user_id", "event_type"],
        "ts",
        {"value": money("value"), "props": F.col("props")},
        tiebreak="event_id",
    )


@query(DIFF_SQL + "SELECT * FROM c")
def change_log(spark, sf_dir):
    return _changes(spark, sf_dir)


@query(DIFF_SQL + "SELECT field_name, change_type, count(*) AS changes FROM c GROUP BY ALL")
def change_counts(spark, sf_dir):
    return changes.change_counts(_changes(spark, sf_dir))


@query(DIFF_SQL + """
SELECT CAST(user_id AS VARCHAR) || '/' || event_type AS listing_id, ts AS change_timestamp, change_type, field_name,
       coalesce(old_value, '') AS old_value, coalesce(new_value, '') AS new_value, 'events' AS source FROM c
""")
def change_log_table(spark, sf_dir):
    """The change rows appended to the stored change log and read back."""
    path = shared_folder(spark, "listing_changes")
    key = F.concat_ws("/", F.col("user_id").cast("string"), "event_type")
    log = changes.as_change_log(_changes(spark, sf_dir), key, F.col("ts"), source="events")
    tables.append(log, "listing_changes", path)
    return tables.read(spark, "listing_changes", path).withColumn("change_timestamp", ntz("change_timestamp"))


@query(DIFF_SQL.replace("PARTITION BY user_id, event_type", "PARTITION BY event_type") + "SELECT * FROM c")
def change_log_hot(spark, sf_dir):
    """The change log by event type alone: five keys, all of them hot, each cut into pieces."""
    return changes.diff_versions(
        read(spark, sf_dir, "events"),
        ["event_type"],
        "ts",
        {"value": money("value"), "props": F.col("props")},
        tiebreak=["event_id", "user_id"],
        hot_share=1e-3,
        hot_rows=20,
    )


@query(f"""
WITH o AS (SELECT user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value
      FROM (SELECT * FROM events WHERE ts < {CUT_SQL})
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
n AS (SELECT user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value
      FROM (SELECT * FROM events WHERE ts >= {CUT_SQL})
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
j AS (SELECT coalesce(o.user_id, n.user_id) AS user_id,
             CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.user_id IS NULL THEN 'delete' ELSE 'update' END AS change_type,
             o.event_type AS ot, n.event_type AS nt, o.value AS ov, n.value AS nv
      FROM o FULL JOIN n ON o.user_id = n.user_id)
SELECT user_id, change_type, 'event_type' AS field_name, ot AS old_value, nt AS new_value FROM j
WHERE change_type <> 'update' OR ot IS DISTINCT FROM nt
UNION ALL
SELECT user_id, change_type, 'value', ov, nv FROM j WHERE change_type <> 'update' OR ov IS DISTINCT FROM nv
""")
def snapshot_diff(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumn("value", money("value"))
    old = versions.latest(rows.filter(F.col("ts") < CUT), ["user_id"], "ts", "event_id")
    new = versions.latest(rows.filter(F.col("ts") >= CUT), ["user_id"], "ts", "event_id")
    return changes.diff_snapshots(old, new, ["user_id"], ["event_type", "value"])


# ---------------------------------------------------------------- flatten, prices, defaults

LADDER_KEYS = {
    "purchase": "apartments_day_hour",
    "view": "outcall_day_hour",
    "click": "час",
    "error": "outcall_day_2hour",
    "signup": "base",
}


@query("""
WITH m AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
         max(CAST(floor(value) AS BIGINT)) FILTER (WHERE event_type = 'purchase') AS onsite,
         max(CAST(floor(value) AS BIGINT)) FILTER (WHERE event_type = 'view') AS offsite,
         max(CAST(floor(value) AS BIGINT)) FILTER (WHERE event_type = 'click') AS legacy,
         max(CAST(floor(value) AS BIGINT)) FILTER (WHERE event_type = 'error') AS twohour,
         max(CAST(floor(value) AS BIGINT)) FILTER (WHERE event_type = 'signup') AS base
  FROM events GROUP BY ALL
), h AS (
  SELECT *, CASE WHEN onsite > 0 THEN onsite WHEN offsite > 0 THEN offsite ELSE coalesce(legacy, 0) END AS price_hour,
         CASE WHEN twohour > 0 THEN twohour ELSE 0 END AS price_2_hours FROM m
)
SELECT user_id, day, price_hour, price_2_hours, CAST(0 AS BIGINT) AS price_night, price_2_hours AS price_day,
       coalesce(base, price_hour) AS price_base
FROM h
""")
def price_ladder(spark, sf_dir):
    """Highest value per user, day and event type as a price map with gaps, then the ladder."""
    amount = F.floor("value").cast("bigint")
    per_type = {k: F.max(F.when(F.col("event_type") == t, amount)) for t, k in LADDER_KEYS.items()}
    days = read(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        *(c.alias(k) for k, c in per_type.items())
    )
    prices = F.create_map(*(x for k in per_type for x in (F.lit(k), F.col(f"`{k}`"))))
    mapped = days.select("user_id", "day", F.map_filter(prices, lambda _, v: v.isNotNull()).alias("prices"))
    ladder = flatten.ladder_columns("prices")
    return mapped.select("user_id", "day", *(c.cast("bigint").alias(n) for n, c in ladder.items()))


# Parts as catalogue listings: two versions each, the later one dearer and half of them in another city.
CATALOGUE_SQL = """
WITH raw AS (
  SELECT p.*, v, CASE WHEN p_size % 2 = 0 THEN 'Unknown' WHEN v = 1 AND p_size % 4 = 1 THEN 'Moved' ELSE p_brand END AS location_city,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(p_partkey % 90 + 30 * v AS INTEGER)) AS updated_at
  FROM part p, (SELECT unnest([0, 1]) AS v)
), catalogue AS (
  SELECT *, CAST(p_partkey AS VARCHAR) AS id, p_name AS title, CAST(p_size AS BIGINT) AS width, p_brand AS brand,
       CASE WHEN p_type = 'ECONOMY' THEN '' ELSE 'RUB' END AS pricing_currency,
       CASE WHEN p_type = 'ECONOMY' THEN 0 ELSE (CAST(floor(p_retailprice) AS BIGINT) + v) * (p_size % 3) END AS price_apartments_day_hour,
       CASE WHEN p_type = 'ECONOMY' THEN 0 ELSE CAST(p_size AS BIGINT) END AS price_outcall_day_hour,
       CASE WHEN p_type = 'ECONOMY' THEN 0 WHEN p_size % 3 > 0 THEN (CAST(floor(p_retailprice) AS BIGINT) + v) * (p_size % 3)
            ELSE CAST(p_size AS BIGINT) END AS price_hour,
       CASE WHEN p_type = 'ECONOMY' THEN 0 ELSE CAST(p_partkey AS BIGINT) END AS price_night,
       string_split(p_name, ' ') AS words
  FROM raw
), newest AS (
  SELECT * FROM catalogue QUALIFY row_number() OVER (PARTITION BY id, location_city ORDER BY updated_at DESC) = 1
)
"""


def _catalogue(spark, sf_dir):
    part = read(spark, sf_dir, "part").withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    words, none = F.split("p_name", " "), F.lit(None)
    prices = F.create_map(
        F.lit("apartments_day_hour"), ((F.floor("p_retailprice") + F.col("v")) * (F.col("p_size") % 3)).cast("int"),
        F.lit("outcall_day_hour"), F.col("p_size"),
        F.lit("night"), F.col("p_partkey").cast("int"),
    )
    city = (
        F.when(F.col("p_size") % 2 == 0, F.lit(""))
        .when((F.col("v") == 1) & (F.col("p_size") % 4 == 1), F.lit("Moved"))
        .otherwise(F.col("p_brand"))
    )
    days = F.col("p_partkey") % 90 + F.col("v") * 30
    pricing = F.struct(
        prices.alias("duration_prices"),
        F.create_map().cast("map<string,int>").alias("service_prices"),
        F.lit("").alias("currency"),
    )
    columns = {
        "id": F.col("p_partkey").cast("string"),
        "title": F.col("p_name"),
        "attrs": F.struct(
            F.create_map(F.lit("width"), F.col("p_size")).alias("num"),
            F.create_map(F.lit("brand"), F.col("p_brand")).alias("str"),
        ),
        "has_contact": F.lit(False),
        "pricing": F.when(F.col("p_type") != "ECONOMY", pricing),
        "tags": F.struct(words.alias("available"), *(none.alias(n) for n in ("additional", "restrictions", "meeting_type"))),
        "location": F.struct(
            words.alias("stations"), none.alias("district"), city.alias("city"), none.alias("offsite"), none.alias("onsite")
        ),
        "description": none,
        "last_updated": none,
        "photos": words,
        "source_url": none,
        "scraped_at": F.timestamp_add("DAY", days.cast("int"), F.lit(dt.datetime(2024, 1, 1))),
    }
    nested = part.select(*(columns[f.name].cast(f.dataType.simpleString()).alias(f.name) for f in LISTING.fields))
    return flatten.flatten(nested)


@query(CATALOGUE_SQL + """
SELECT id, title, width, brand, pricing_currency, price_apartments_day_hour, price_outcall_day_hour, price_hour, price_night,
       price_hour AS price_base, array_to_string(words, '|') AS tags_available, location_city,
       CAST(len(words) AS BIGINT) AS photos_count, updated_at
FROM catalogue
""")
def listing_flat(spark, sf_dir):
    """Nested listings flattened to the table columns."""
    return _catalogue(spark, sf_dir).select(
        "id", "title", map_get("attr_num", "width").alias("width"), map_get("attr_str", "brand").alias("brand"),
        "pricing_currency", "price_apartments_day_hour", "price_outcall_day_hour", "price_hour", "price_night",
        "price_base", F.array_join("tags_available", "|").alias("tags_available"), "location_city", "photos_count",
        ntz("updated_at").alias("updated_at"),
    )


@query(CATALOGUE_SQL + """
SELECT count(*) AS total, CAST(0 AS BIGINT) AS with_contact, count(*) FILTER (WHERE len(words) > 0) AS with_photos,
       count(*) FILTER (WHERE price_hour > 0) AS with_price, CAST(0 AS BIGINT) AS with_description,
       count(*) FILTER (WHERE width > 0) AS with_width, CAST(sum(price_hour) AS DOUBLE) / count(*) AS avg_price,
       CAST(sum(width) AS DOUBLE) / count(*) AS avg_width, count(DISTINCT location_city) AS cities
FROM newest
""")
def report_summary(spark, sf_dir):
    return reports.summary(_catalogue(spark, sf_dir), "width")


@query(CATALOGUE_SQL + """
SELECT location_city, count(*) AS n, CAST(sum(price_hour) AS DOUBLE) / count(*) AS avg_value
FROM newest WHERE price_hour > 0 GROUP BY ALL ORDER BY avg_value DESC, location_city
""")
def report_price_by_city(spark, sf_dir):
    return reports.average_price_by_city(_catalogue(spark, sf_dir))


@query(CATALOGUE_SQL + """
SELECT CASE WHEN width < 10 THEN 'small' WHEN width < 25 THEN 'medium' ELSE 'large' END AS band, count(*) AS n,
       CAST(sum(price_hour) AS DOUBLE) / count(*) AS avg_value
FROM newest WHERE width > 0 GROUP BY ALL
""")
def report_attribute(spark, sf_dir):
    return reports.attribute_distribution(_catalogue(spark, sf_dir), "width", (10, 25), ("small", "medium", "large"))


@query(CATALOGUE_SQL + """
SELECT CASE WHEN price_hour < 100 THEN 'low' WHEN price_hour < 1000 THEN 'middle' ELSE 'high' END AS price_range,
       count(*) AS n, min(price_hour) AS min_value, max(price_hour) AS max_value
FROM catalogue WHERE price_hour > 0 GROUP BY ALL
""")
def report_price_ranges(spark, sf_dir):
    """Over every stored version."""
    return reports.price_ranges(_catalogue(spark, sf_dir), (100, 1000), ("low", "middle", "high"), latest_only=False)


@query(CATALOGUE_SQL + """
SELECT id, width, price_hour, location_city FROM newest
WHERE list_contains(words, 'red') AND location_city = 'Unknown' AND price_hour BETWEEN 20 AND 1500
""")
def report_tagged(spark, sf_dir):
    return reports.tagged(_catalogue(spark, sf_dir), "red", "Unknown", 20, 1500, attribute="width")


@query(CATALOGUE_SQL + """
SELECT station, count(*) AS n, CAST(sum(price_hour) AS DOUBLE) / count(*) AS avg_value
FROM (SELECT unnest(words) AS station, price_hour FROM newest) WHERE station <> ''
GROUP BY ALL ORDER BY n DESC, station LIMIT 20
""")
def report_stations(spark, sf_dir):
    return reports.station_popularity(_catalogue(spark, sf_dir))


@query(CATALOGUE_SQL + """
SELECT CAST(year(first) * 100 + month(first) AS INTEGER) AS yyyymm, count(*) AS n, CAST(sum(price) AS DOUBLE) / count(*) AS avg_value
FROM (SELECT id, min(updated_at) AS first, arg_max(price_hour, updated_at) AS price FROM catalogue GROUP BY id) GROUP BY ALL
""")
def report_months(spark, sf_dir):
    return reports.listings_per_month(_catalogue(spark, sf_dir))


@query(CATALOGUE_SQL + """
SELECT CAST(updated_at AS DATE) AS day, location_city, count(*) AS n, CAST(sum(price_hour) AS DOUBLE) / count(*) AS avg_value,
       min(price_hour) AS min_value, max(price_hour) AS max_value
FROM catalogue GROUP BY ALL
""")
def report_days(spark, sf_dir):
    return reports.daily_city_stats(_catalogue(spark, sf_dir))


@query(CATALOGUE_SQL + """
SELECT id, location_city, title, price_hour, updated_at FROM catalogue
QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1
""")
def catalogue_table(spark, sf_dir):
    """Listings stored and read back, newest version per id across cities."""
    path = shared_folder(spark, "listings")
    tables.append(_catalogue(spark, sf_dir), "listings", path)
    newest = versions.latest(tables.read(spark, "listings", path), ["id"], "updated_at")
    return newest.select("id", "location_city", "title", "price_hour", ntz("updated_at").alias("updated_at"))


BANDS = ("short", "medium", "long", "very long")
BAND_EDGES = (500, 1000, 5000)
BAND_SQL = "CASE WHEN {c} < 500 THEN 'short' WHEN {c} < 1000 THEN 'medium' WHEN {c} < 5000 THEN 'long' ELSE 'very long' END"


@query(f"""
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS description_length,
       regexp_matches(text, '{CONTACT_PATTERN}') AS has_contact,
       {BAND_SQL.format(c="n_chars")} AS length_band
FROM documents
""")
def listing_computed(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    bands = {"length_band": ("n_chars", BAND_EDGES, BANDS)}
    out = flatten.with_computed(docs, bands, description="text", photos=None, contact=has_contact("text"))
    return out.select("doc_id", "description_length", "has_contact", "length_band")


@query("""
SELECT c_custkey, CASE WHEN c_nationkey % 7 = 0 THEN 'Unknown' ELSE c_mktsegment END AS segment, 'RUB' AS currency,
       CAST(0 AS BIGINT) AS visits
FROM customer
""")
def defaults_fill(spark, sf_dir):
    """Blank and missing columns get their defaults."""
    customers = read(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 7 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("segment")
    )
    schema = struct(c_custkey=LONG, segment=TEXT, currency=TEXT, visits=LONG)
    return fill_defaults(customers, schema, {"segment": "Unknown", "currency": "RUB"}, blank=True)


@query("""
SELECT p_partkey, CAST(((p_size * 17 - 100) % 256 + 256) % 256 AS BIGINT) AS wrapped,
       CASE WHEN p_size * 17 - 100 BETWEEN 0 AND 255 THEN CAST(p_size * 17 - 100 AS BIGINT) END AS checked
FROM part
""")
def unsigned_wrap(spark, sf_dir):
    n = F.col("p_size") * 17 - 100
    return read(spark, sf_dir, "part").select(
        "p_partkey", checked_unsigned(n, 8, "wrap").alias("wrapped"), checked_unsigned(n, 8).alias("checked")
    )


@query("""
SELECT event_id, key, CAST(json_extract_string(props, '$.' || key) AS BIGINT) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
""")
def map_cast(spark, sf_dir):
    signed = read(spark, sf_dir, "events").select("event_id", F.from_json("props", "map<string,int>").alias("m"))
    return signed.select("event_id", F.explode(flatten.unsigned_map("m")))


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_exists(props, '$.k') AS has_k, json_exists(props, '$.missing') AS has_missing, CAST(0 AS BIGINT) AS missing
FROM events
""")
def json_extract(spark, sf_dir):
    parsed = F.from_json("props", "map<string,bigint>")
    rows = read(spark, sf_dir, "events").select("event_id", parsed.alias("m"))
    return rows.select(
        "event_id",
        map_get("m", "k").alias("k"),
        has_key("m", "k").alias("has_k"),
        has_key("m", "missing").alias("has_missing"),
        map_get("m", "missing", 0).cast("bigint").alias("missing"),
    )


PRICE_TEXT_SQL = """CASE p_partkey % 6
  WHEN 0 THEN CAST(p_size AS VARCHAR) || chr(8239) || '000₽'
  WHEN 1 THEN CAST(p_size AS VARCHAR) || chr(8201) || '000' || chr(8239) || '₽'
  WHEN 2 THEN CAST(p_size AS VARCHAR) || ' 000₽'
  WHEN 3 THEN '+' || CAST(p_size AS VARCHAR)
  WHEN 4 THEN CAST(p_size AS VARCHAR) || '.5'
  ELSE '-' || CAST(p_size AS VARCHAR) END"""


@query(f"""
WITH t AS (SELECT p_partkey, {PRICE_TEXT_SQL} AS price_text FROM part),
c AS (SELECT *, regexp_replace(price_text, '[\u202f\u2009₽]', '', 'g') AS plain,
             regexp_replace(price_text, '[\u202f\u2009₽ ]', '', 'g') AS tight FROM t)
SELECT p_partkey, price_text,
       CASE WHEN regexp_full_match(plain, '[+-]?[0-9]+') THEN CAST(plain AS INTEGER) ELSE 0 END AS price,
       CASE WHEN regexp_full_match(tight, '[+-]?[0-9]+') THEN CAST(tight AS INTEGER) ELSE 0 END AS price_tight
FROM c
""")
def price_parse(spark, sf_dir):
    """Price texts in the forms pages use, made from every part."""
    size = F.col("p_size").cast("string")
    forms = [
        F.concat(size, F.lit("\u202f000₽")),
        F.concat(size, F.lit("\u2009000\u202f₽")),
        F.concat(size, F.lit(" 000₽")),
        F.concat(F.lit("+"), size),
        F.concat(size, F.lit(".5")),
        F.concat(F.lit("-"), size),
    ]
    text = F.get(F.array(*forms), (F.col("p_partkey") % 6).cast("int"))
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        text.alias("price_text"),
        parse_price(text).alias("price"),
        parse_price(text, strip_spaces=True).alias("price_tight"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS last_updated, CAST(o_orderdate AS DATE) AS updated_on,
       '' AS no_date
FROM orders
""")
def date_text(spark, sf_dir):
    """Dates as pages show them, found in a sentence and parsed back."""
    sentence = F.concat(F.lit("updated "), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(" by owner"))
    found = read(spark, sf_dir, "orders").select("o_orderkey", date_from_text(sentence).alias("last_updated"), "o_orderpriority")
    return found.select(
        "o_orderkey", "last_updated", parse_date("last_updated").alias("updated_on"),
        date_from_text("o_orderpriority").alias("no_date"),
    )


@query(f"""
SELECT doc_id, regexp_replace(text, '{CONTACT_PATTERN}', '[contact]', 'g') AS text,
       regexp_matches(text, '{CONTACT_PATTERN}') AS has_contact
FROM documents
""")
def mask_contact_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(
        "doc_id", mask_contacts("text").alias("text"), has_contact("text").alias("has_contact")
    )


@query("""
SELECT doc_id, lang, n_chars FROM documents
WHERE lang = 'en' AND n_chars BETWEEN 500 AND 5000 AND list_contains(string_split(lower(text), ' '), 'tion')
""")
def tag_filter(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    words = F.split(F.lower("text"), " ")
    return filters.tagged_in_range(docs, words, "tion", "lang", "en", "n_chars", 500, 5000).drop("text")


# ---------------------------------------------------------------- grouped statistics


@query(f"""
SELECT c_nationkey, count(*) AS n, {_avg_sql("c_acctbal")} AS avg_value FROM customer WHERE c_acctbal > 0
GROUP BY ALL ORDER BY avg_value DESC, c_nationkey
""")
def avg_by_group(spark, sf_dir):
    out = analytics.grouped(
        read(spark, sf_dir, "customer"), ["c_nationkey"], money("c_acctbal"), gate=F.col("c_acctbal") > 0
    )
    return analytics.ranked(out, "avg_value", "c_nationkey")


PRICE_EDGES = (925.0, 950.0, 975.0)
PRICE_BANDS = ("budget", "low", "middle", "high")
PRICE_BAND_SQL = (
    "CASE WHEN p_retailprice < 925 THEN 'budget' WHEN p_retailprice < 950 THEN 'low' "
    "WHEN p_retailprice < 975 THEN 'middle' ELSE 'high' END"
)


@query(f"""
SELECT {PRICE_BAND_SQL} AS price_range, count(*) AS n, min(p_retailprice) AS min_value, max(p_retailprice) AS max_value
FROM part WHERE p_retailprice > 0 GROUP BY ALL
""")
def band_counts(spark, sf_dir):
    band = bucketize("p_retailprice", PRICE_EDGES, PRICE_BANDS)
    return analytics.grouped(
        read(spark, sf_dir, "part"),
        {"price_range": band},
        F.col("p_retailprice"),
        ("count", "min", "max"),
        gate=F.col("p_retailprice") > 0,
    )


@query(f"""
SELECT CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 25 THEN 'medium' ELSE 'large' END AS size_group,
       count(*) AS n, {_avg_sql("p_retailprice")} AS avg_value
FROM part WHERE p_size > 0 GROUP BY ALL ORDER BY n DESC, size_group
""")
def band_distribution(spark, sf_dir):
    band = bucketize("p_size", (10, 25), ("small", "medium", "large"))
    out = analytics.grouped(
        read(spark, sf_dir, "part"), {"size_group": band}, money("p_retailprice"), gate=F.col("p_size") > 0
    )
    return analytics.ranked(out, "n", "size_group")


@query(f"""
SELECT 'all' AS versions, event_type, count(*) AS n, {_avg_sql("value")} AS avg_value FROM events GROUP BY ALL
UNION ALL
SELECT 'latest', event_type, count(*), {_avg_sql("value")} FROM ({LATEST.format(keys="user_id, event_type")}) GROUP BY ALL
""")
def versions_or_latest(spark, sf_dir):
    """The same statistic over every stored version and over the latest ones."""
    rows = read(spark, sf_dir, "events")
    newest = versions.latest(rows, ["user_id", "event_type"], "ts", "event_id")
    both = [
        analytics.grouped(df, ["event_type"], money("value")).select(F.lit(name).alias("versions"), "*")
        for name, df in (("all", rows), ("latest", newest))
    ]
    return both[0].unionByName(both[1])


@query(f"""
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm, count(*) AS n,
       {_avg_sql("o_totalprice")} AS avg_value
FROM orders GROUP BY ALL ORDER BY yyyymm
""")
def monthly_counts(spark, sf_dir):
    return analytics.monthly(read(spark, sf_dir, "orders"), "o_orderdate", money("o_totalprice"))


@query("""
SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS yyyymm, count(*) AS n
FROM (SELECT o_custkey, min(o_orderdate) AS d FROM orders GROUP BY o_custkey) GROUP BY ALL
""")
def first_seen_monthly(spark, sf_dir):
    first = versions.first_seen(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate")
    return first.groupBy(yyyymm("first_seen").alias("yyyymm")).agg(F.count("*").alias("n"))


@query(f"""
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, {_avg_sql("value")} AS avg_value,
       CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS min_value, CAST(max(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS max_value
FROM events GROUP BY ALL
""")
def daily_stats(spark, sf_dir):
    out = analytics.daily(read(spark, sf_dir, "events"), "ts", "event_type", money("value"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("min_value", "max_value")})


@query(f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, {_avg_sql("l_extendedprice")} AS avg_value,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_value
FROM lineitem WHERE l_quantity > 0 GROUP BY ALL
""")
def lineitem_stats(spark, sf_dir):
    """The grouped statistic over the largest table."""
    out = analytics.grouped(
        read(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        money("l_extendedprice"),
        ("count", "avg", "sum"),
        gate=F.col("l_quantity") > 0,
    )
    return out.withColumn("sum_value", F.col("sum_value").cast("double"))


# ---------------------------------------------------------------- events

SOURCE_SQL = "'s' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS VARCHAR)"


def events_with_source(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return read(spark, sf_dir, "events").withColumn("source", F.concat(F.lit("s"), (k % 3).cast("string")))


@query(f"""
SELECT event_type, {SOURCE_SQL} AS source, 'events_per_minute' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value
FROM events GROUP BY ALL
""")
def event_summary_metrics(spark, sf_dir):
    metrics = analytics.as_metrics(analytics.event_summary(events_with_source(spark, sf_dir)))
    return metrics.select(
        map_get("labels", "event_type").alias("event_type"), map_get("labels", "source").alias("source"),
        "metric_name", "metric_value",
    )


@query(f"""
SELECT event_type, {SOURCE_SQL} AS source, CAST(count(*) AS DOUBLE) AS metric_value
FROM events WHERE ts >= {AS_OF_SQL} - INTERVAL 2 DAY GROUP BY ALL
""")
def recent_summary(spark, sf_dir):
    """Event summary over the newest rows only; the width is a parameter, the source table whole."""
    rows = filters.recent(events_with_source(spark, sf_dir), "ts", dt.timedelta(days=2), AS_OF)
    return analytics.event_summary(rows)


@query(f"SELECT * FROM events WHERE ts > {AS_OF_SQL} - INTERVAL 7 DAY")
def retention(spark, sf_dir):
    return filters.retain(read(spark, sf_dir, "events"), "ts", 7, AS_OF)


MINUTE_SQL = f"""
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
       event_type, {SOURCE_SQL} AS source, CAST(count(*) AS DOUBLE) AS metric_value
FROM events GROUP BY ALL
"""


@query(MINUTE_SQL)
def per_minute(spark, sf_dir):
    out = summary_per_minute(events_with_source(spark, sf_dir), ts="ts")
    return out.withColumns({c: ntz(c) for c in ("window_start", "window_end")})


# ---------------------------------------------------------------- stored tables


def _stored_events(spark, sf_dir):
    """The event table shaped for storage."""
    return events_with_source(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_type",
        "source",
        F.col("props").alias("raw_data"),
        F.create_map(F.lit("event_id"), F.col("event_id").cast("string")).alias("metadata"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


STORED_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS id, ts AS timestamp, event_type, {SOURCE_SQL} AS source, props AS raw_data,
       CAST(event_id AS VARCHAR) AS event_id, '' AS parsed_data, CAST(0 AS BIGINT) AS processing_time_ms
"""


def _stored_output(df):
    return df.select(
        "id", ntz("timestamp").alias("timestamp"), "event_type", "source", "raw_data",
        map_get("metadata", "event_id").alias("event_id"), "parsed_data", "processing_time_ms",
    )


@query(f"{STORED_SQL} FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1")
def table_upsert(spark, sf_dir):
    """Create the table from one half, upsert the other, read the latest versions."""
    path = shared_folder(spark, "events")
    rows = _stored_events(spark, sf_dir)
    early = F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")
    tables.create(rows.filter(early), "events", path)
    tables.upsert(rows.filter(~early), "events", path)
    return _stored_output(versions.latest(tables.read(spark, "events", path), ["id", "event_type"], "timestamp"))


@query(f"""{STORED_SQL} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def table_merge(spark, sf_dir):
    """Three loads in no order of time, merged on write; the table holds the latest versions only."""
    rows = _stored_events(spark, sf_dir).withColumn("event_id", map_get("metadata", "event_id").cast("bigint"))
    table = Keyed(f"{database(spark)}.latest", plus(TABLES["events"].schema, event_id=LONG), ("id", "event_type"), 16, 8).create(spark)
    for load in (2, 0, 1):
        table.merge(rows.filter(F.col("event_id") % 3 == load), ["timestamp", "event_id"])
    return _stored_output(table.read(spark))


@query("""
SELECT CAST(user_id AS VARCHAR) AS id, date_trunc('day', ts)::TIMESTAMP AS timestamp, event_type, CAST(event_id AS VARCHAR) AS event_id
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id DESC) = 1
""")
def latest_ties(spark, sf_dir):
    """Versions that tie, by the day: of those, the last loaded wins."""
    path = shared_folder(spark, "ties")
    rows = _stored_events(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    loaded = map_get("metadata", "event_id").cast("bigint")
    tables.append(rows.filter(loaded % 2 == 0), "events", path, load=loaded)
    tables.append(rows.filter(loaded % 2 == 1), "events", path, load=loaded)
    newest = versions.latest(tables.read(spark, "events", path, loads=True), ["id"], "timestamp", tables.LOAD)
    return newest.select("id", ntz("timestamp").alias("timestamp"), "event_type", map_get("metadata", "event_id").alias("event_id"))


@query(f"{STORED_SQL} FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1")
def table_compact(spark, sf_dir):
    path, compacted = shared_folder(spark, "events"), shared_folder(spark, "compacted")
    tables.append(_stored_events(spark, sf_dir), "events", path)
    tables.compact(spark, "events", path, compacted, ["id"], "timestamp")
    return _stored_output(tables.read(spark, "events", compacted))


@query(f"{STORED_SQL} FROM events WHERE ts > TIMESTAMP '2024-04-10 00:00:00' - INTERVAL 90 DAY")
def table_purge(spark, sf_dir):
    path, kept = shared_folder(spark, "events"), shared_folder(spark, "purged")
    tables.append(_stored_events(spark, sf_dir), "events", path)
    tables.purge(spark, "events", path, kept, as_of=dt.datetime(2024, 4, 10))
    return _stored_output(tables.read(spark, "events", kept))


def _over_months(rows):
    """Stored events spread over five months by their number, and that number."""
    n = map_get("metadata", "event_id").cast("bigint")
    later = F.timestamp_add("MONTH", (n % 4).cast("int"), F.col("timestamp"))
    return rows.withColumns({"timestamp": later, "created_at": later}), n


OVER_MONTHS_SQL = "(SELECT * REPLACE (ts + to_months(CAST(event_id % 4 AS INTEGER)) AS ts) FROM events)"


@query(f"{STORED_SQL} FROM {OVER_MONTHS_SQL} WHERE ts > TIMESTAMP '2024-06-13 12:00:00' - INTERVAL 90 DAY")
def table_expire(spark, sf_dir):
    """Events of several months: those behind the bound are dropped as folders, the bound's own month is written anew."""
    path = shared_folder(spark, "events")
    rows, _ = _over_months(_stored_events(spark, sf_dir))
    tables.append(rows, "events", path)
    tables.expire(spark, "events", path, as_of=dt.datetime(2024, 6, 13, 12))
    return _stored_output(tables.read(spark, "events", path))


@query(f"""{STORED_SQL} FROM {OVER_MONTHS_SQL}
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, event_id DESC) = 1""")
def table_compact_months(spark, sf_dir):
    """Versions over five months in two loads; each is compacted in place, by the months that hold replaced versions."""
    path = shared_folder(spark, "events")
    rows, n = _over_months(_stored_events(spark, sf_dir))
    for load in (1, 0):
        tables.append(rows.filter(n % 2 == load), "events", path, load=n)
        tables.compact_months(spark, "events", path, ["id"], "timestamp")
    return _stored_output(tables.read(spark, "events", path))


@query(CATALOGUE_SQL + """
SELECT id, location_city, price_hour, updated_at FROM catalogue WHERE price_hour BETWEEN 900 AND 1000
""")
def table_cluster(spark, sf_dir):
    """Listings stored along a curve through city, price and time, and found by price alone."""
    path, clustered = shared_folder(spark, "listings"), shared_folder(spark, "clustered")
    tables.append(_catalogue(spark, sf_dir), "listings", path)
    tables.cluster(spark, "listings", path, clustered)
    found = tables.read(spark, "listings", clustered).filter(F.col("price_hour").between(900, 1000))
    return found.select("id", "location_city", "price_hour", ntz("updated_at").alias("updated_at"))
