"""Record and table schemas, column defaults and table layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import blank_to_null

TEXT, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
FLAG, TIME, TEXTS = T.BooleanType(), T.TimestampType(), T.ArrayType(T.StringType())
LABELS, COUNTS, LONGS = T.MapType(TEXT, TEXT), T.MapType(TEXT, INT), T.MapType(TEXT, LONG)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# One nested catalogue listing, as read from Parquet or JSON or built from a page.
LISTING = struct(
    id=TEXT,
    title=TEXT,
    attrs=struct(num=COUNTS, str=LABELS),
    has_contact=FLAG,
    pricing=struct(duration_prices=COUNTS, service_prices=COUNTS, currency=TEXT),
    tags=struct(available=TEXTS, additional=TEXTS, restrictions=TEXTS, meeting_type=TEXT),
    location=struct(stations=TEXTS, district=TEXT, city=TEXT, offsite=FLAG, onsite=FLAG),
    description=TEXT,
    last_updated=TEXT,
    photos=TEXTS,
    source_url=TEXT,
    scraped_at=TIME,
)

# The structured price keys, on-site before off-site.
ONSITE_PRICE_KEYS = (
    "apartments_day_hour", "apartments_day_2hour", "apartments_night_hour", "apartments_night_2hour",
)
OFFSITE_PRICE_KEYS = ("outcall_day_hour", "outcall_day_2hour", "outcall_night_hour", "outcall_night_2hour")
PRICE_KEYS = ONSITE_PRICE_KEYS + OFFSITE_PRICE_KEYS

# One flat row per listing version, in table order.
FLAT_LISTING = struct(
    id=TEXT,
    created_at=TIME,
    updated_at=TIME,
    last_scraped=TIME,
    source_url=TEXT,
    title=TEXT,
    attr_num=LONGS,
    attr_str=LABELS,
    has_contact=FLAG,
    pricing_currency=TEXT,
    **{f"price_{k}": LONG for k in PRICE_KEYS},
    price_hour=LONG,
    price_2_hours=LONG,
    price_night=LONG,
    price_day=LONG,
    price_base=LONG,
    pricing_duration_prices=LONGS,
    pricing_service_prices=LONGS,
    tags_available=TEXTS,
    tags_additional=TEXTS,
    tags_restrictions=TEXTS,
    tags_meeting_type=TEXT,
    location_stations=TEXTS,
    location_district=TEXT,
    location_city=TEXT,
    location_offsite=FLAG,
    location_onsite=FLAG,
    description=TEXT,
    last_updated=TEXT,
    photos=TEXTS,
    photos_count=LONG,
)
LISTING_COLUMNS = FLAT_LISTING.fieldNames()

EVENTS = struct(
    id=TEXT,
    timestamp=TIME,
    event_type=TEXT,
    source=TEXT,
    raw_data=TEXT,
    parsed_data=TEXT,
    metadata=LABELS,
    processing_time_ms=LONG,
    created_at=TIME,
)
METRICS = struct(id=TEXT, timestamp=TIME, metric_name=TEXT, metric_value=DOUBLE, labels=LABELS, created_at=TIME)
PARSING_ERRORS = struct(
    id=TEXT,
    timestamp=TIME,
    error_type=TEXT,
    error_message=TEXT,
    input_data=TEXT,
    stack_trace=TEXT,
    source=TEXT,
    created_at=TIME,
)
LISTING_CHANGES = struct(
    listing_id=TEXT,
    change_timestamp=TIME,
    change_type=TEXT,
    field_name=TEXT,
    old_value=TEXT,
    new_value=TEXT,
    source=TEXT,
)
# Field names of one image record, odd spelling included.
IMAGES = T.ArrayType(
    struct(BIMG=TEXT, ID=TEXT, LIKECOUNT=TEXT, LIKEClASS=TEXT, LOGO=TEXT, NUM=TEXT, RAND=TEXT, SAVE=TEXT)
)


def plus(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    """A copy of ``schema`` with more columns (StructType.add would change it in place)."""
    return T.StructType([*schema.fields, *struct(**columns).fields])


@dataclass(frozen=True)
class Table:
    """A stored table: schema, month partition source, sort order, retention, bloom columns, columns to cluster by."""

    name: str
    schema: T.StructType
    time: str
    sort: tuple[str, ...]
    retention_days: int | None = None
    retention_column: str = "created_at"
    bloom: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()


TABLES = {
    t.name: t
    for t in (
        Table("events", EVENTS, "timestamp", ("timestamp", "event_type", "source"), 90),
        Table("metrics", METRICS, "timestamp", ("timestamp", "metric_name"), 30),
        Table("parsing_errors", PARSING_ERRORS, "timestamp", ("timestamp", "error_type", "source"), 30),
        Table(
            "listings", FLAT_LISTING, "created_at", ("id", "location_city"), bloom=("location_city",),
            cluster=("location_city", "price_hour", "updated_at"),
        ),
        Table("listing_changes", LISTING_CHANGES, "change_timestamp", ("listing_id", "change_timestamp"), 180, "change_timestamp"),
    )
}

# Defaults that differ from the zero value of the column type.
SPECIAL_DEFAULTS = {"pricing_currency": "RUB", "location_city": "Unknown"}


def zero_sql(dtype: T.DataType) -> str:
    """The type's zero in Spark SQL: '', 0, false, empty array or empty map."""
    if isinstance(dtype, T.StringType):
        return "''"
    if isinstance(dtype, T.BooleanType):
        return "false"
    for kind, empty in ((T.ArrayType, "array()"), (T.MapType, "map()"), (T.NumericType, "0")):
        if isinstance(dtype, kind):
            return f"CAST({empty} AS {dtype.simpleString()})"
    raise ValueError(f"no zero value for {dtype.simpleString()}")


def default_of(f: T.StructField, defaults: dict, new_id: bool = False) -> Column:
    """What a missing value of a column becomes."""
    if f.name in defaults:
        return F.lit(defaults[f.name]).cast(f.dataType.simpleString())
    if isinstance(f.dataType, T.TimestampType):
        return F.current_timestamp()
    return F.uuid() if new_id else F.expr(zero_sql(f.dataType))


def fill_defaults(df: DataFrame, schema: T.StructType, defaults: dict | None = None, blank: bool = False) -> DataFrame:
    """Project to ``schema`` with a default for every missing column and every NULL.

    Timestamps default to the query's current time and ``id`` to a random UUID, everything
    else to its zero value unless ``defaults`` says otherwise.  With ``blank`` an empty
    string in a column named in ``defaults`` is replaced too.
    """
    defaults = SPECIAL_DEFAULTS if defaults is None else defaults
    have = set(df.columns)
    out = []
    for f in schema.fields:
        default = default_of(f, defaults, f.name == "id" and "id" not in have)
        if f.name not in have:
            out.append(default.alias(f.name))
            continue
        value = F.col(f.name).cast(f.dataType.simpleString())
        if blank and f.name in defaults and isinstance(f.dataType, T.StringType):
            value = blank_to_null(value)
        out.append(F.coalesce(value, default).alias(f.name))
    return df.select(*out)
