"""Continuous page jobs: link monitoring, new links only, page ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.text import yyyymm
from shelfmark.operators.extract import SiteRules, extract_listings
from shelfmark.operators.flatten import flatten, range_error
from shelfmark.operators.links import page_links
from shelfmark.operators.versions import first_occurrence
from shelfmark.schemas import FLAG, FLAT_LISTING, INT, LONG, TEXT, plus, struct
from shelfmark.session import materialize
from shelfmark.sources.keyed import Keyed
from shelfmark.sources.pages import decode_pages
from shelfmark.sources.quality import error_rows, with_outcome
from shelfmark.streaming.sinks import QUERY, batch_folder, for_each_batch, to_batch_table


def monitor_links(pages: DataFrame, base: Column, **link_options) -> DataFrame:
    """Every link of every arriving page, again on each visit; duplicates within a page go."""
    return page_links(pages, base, dedup=True, **link_options)


def new_links(links: DataFrame, key: str = "url", salts: int = 8, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Each link address once over the whole stream.

    One address may sit on every page, and all its rows would meet in one state partition.
    They are therefore deduplicated per (address, salt) first, which leaves at most ``salts``
    rows per address for the second step.  ``salts=1`` skips that.

    State grows with the number of distinct addresses; ``watermark=(column, delay)`` forgets
    an address after the delay instead.
    """
    others = [F.col(c) for c in links.columns if c != key]
    if watermark:
        links = links.withWatermark(*watermark)
    steps = [[key]]
    if salts > 1 and others:
        links = links.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(salts)))
        steps = [[key, "_salt"], [key]]
    for keys in steps:
        links = links.dropDuplicatesWithinWatermark(keys) if watermark else links.dropDuplicates(keys)
    return links.drop("_salt")


def collect_new_links(
    links: DataFrame, path: str, checkpoint: str, seen: str, key: str = "url", order=("page_id", "pos"), parts: int = 64, buckets: int = 16, **options
) -> StreamingQuery:
    """Like :func:`new_links` with the seen addresses kept as a keyed table, named ``seen``, beside the new links at ``path``.

    The batch is reduced to one row per address; the addresses it holds decide which parts of the seen table are read, and the
    join shuffles the batch alone. The parts touched are written anew with the new addresses, so each stays one compact
    generation. Unlike state, the survivor of an address is fixed: the first in ``order`` within its batch. A repeated
    batch finds what was seen before its own first try and overwrites what it wrote. A row without address is new in every batch.
    """
    spark = links.sparkSession
    known = Keyed(seen, struct(**{key: links.schema[key].dataType}), (key,), parts, buckets).create(spark)
    folder = batch_folder(spark, path, checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark, out = batch.sparkSession, folder(batch_id)
        writer = out.removeprefix(f"{path}/{QUERY}=").partition("/")[0]
        gen = known.next_generation(spark, writer, batch_id)
        fresh = materialize(first_occurrence(batch, [key], list(order)), "links")
        touched = known.touched(fresh)
        old = known.read(spark, before=gen, parts=touched)
        new = fresh.join(old.select(key), key, "left_anti").select(*batch.columns)
        new.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(out)
        if touched:
            added = spark.read.schema(links.schema).parquet(out).where(F.col(key).isNotNull())
            known.replace(spark, known.merge_plan(old, added, (key,)), gen)

    return for_each_batch(links, add, checkpoint, **options)


def ingest_rows(
    pages: DataFrame, rules: SiteRules = SiteRules(), scraped_at: str | None = None, body: str | None = None, **extract_options
) -> DataFrame:
    """Pages to flat listing rows with an outcome.

    A page without a key and one with a number out of range are dead letters; the check comes
    before the numbers are narrowed.  With ``body``, pages are fetched bytes in that column (and
    ``encoding`` and ``status`` columns where there are such), and what does not decode is a dead
    letter too.
    """
    earlier: tuple[str, ...] = ()
    if body:
        named = {c: c for c in ("encoding", "status") if c in pages.columns}
        pages = decode_pages(pages, body, out="html", **named)
        earlier = ("error_type", "error_message")
        pages = pages.withColumnsRenamed({c: f"_{c}" for c in earlier})
    records = extract_listings(pages, rules, scraped_at=scraped_at, keep=[f"_{c}" for c in earlier], **extract_options)
    checks = {"no_key": F.when(F.col("id") == "", F.lit("no listing key in the address")), "range": range_error()}
    checked = with_outcome(records, checks)
    if body:
        failed = F.col("_error_type").isNotNull()
        checked = checked.withColumns({c: F.when(failed, F.col(f"_{c}")).otherwise(F.col(c)) for c in earlier})
    return flatten(checked, keep=("error_type", "error_message"))


def ingest_listings(
    pages: DataFrame,
    path: str,
    checkpoint: str,
    rules: SiteRules = SiteRules(),
    scraped_at: str | None = None,
    trigger: dict | None = None,
    **extract_options,
) -> StreamingQuery:
    """Arriving pages → records → flat rows → table at ``path``, one write per micro-batch.

    Rows lie under ``failed=true|false`` and their month, so listings and dead letters come
    from one pass.
    """
    rows = ingest_rows(pages, rules, scraped_at, **extract_options)
    rows = rows.withColumns({"failed": F.col("error_type").isNotNull(), "yyyymm": yyyymm("created_at")})
    return to_batch_table(rows, path, checkpoint, partition_by=("failed", "yyyymm"), **(trigger or {}))


def read_errors(spark: SparkSession, path: str, source: str = "ingest") -> DataFrame:
    """The dead letters of :func:`ingest_listings` in the shape of the error table; the address is the input."""
    failed = read_ingested(spark, path, failed=True)
    return error_rows(failed, F.col("source_url"), F.lit(source), F.col("created_at"))


def read_ingested(spark: SparkSession, path: str, failed: bool = False) -> DataFrame:
    """Listings written by :func:`ingest_listings`, or its dead letters."""
    stored = plus(FLAT_LISTING, error_type=TEXT, error_message=TEXT, query_id=TEXT, batch_id=LONG, failed=FLAG, yyyymm=INT)
    rows = spark.read.schema(stored).parquet(path).filter(F.col("failed") == F.lit(failed))
    return rows.select(*FLAT_LISTING.fieldNames(), *(["error_type", "error_message"] if failed else []))
