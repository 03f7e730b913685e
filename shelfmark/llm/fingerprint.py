"""Threshold-scaled sketches of documents: every shingle hash below a fixed fraction. DataFrame expressions only.

A text's shingles are its runs of five words (the whole text where it has fewer); hashes below ``fraction`` of the hash range are kept. What is
kept depends on the hash alone, so sketches of very unequal texts can be compared, and containment is estimated from the hashes
kept. A text with words but no hash below the fraction keeps its smallest one, which only names it: longer texts that hold that
shingle need not keep it. ``likeness`` therefore compares the texts themselves, exactly, wherever a sketch holds a single hash.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import materialize

WORDS = 5
FRACTION = 1 / 8


def words_of(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def add_sketch(rows: DataFrame, text: str, name: str, fraction: float = FRACTION, k: int = WORDS) -> DataFrame:
    """Add ``name``: the sorted sketch of column ``text``. Null, empty and wordless texts have an empty one."""
    bound = -(1 << 63) + int((1 << 64) * fraction) - 1
    some = ", ".join(f"_words[i + {j}]" for j in range(k))
    hashes = f"CASE WHEN size(_words) = 0 THEN CAST(array() AS array<bigint>) WHEN size(_words) < {k} THEN array(xxhash64(_words)) ELSE transform(sequence(0, size(_words) - {k}), i -> xxhash64({some})) END"
    below = F.filter("_hashes", lambda h: h <= bound)
    rows = rows.withColumn("_words", words_of(text)).withColumn("_hashes", F.expr(hashes)).withColumn("_below", below)
    least = F.filter(F.array(F.array_min("_hashes")), lambda h: h.isNotNull())
    return rows.withColumn(name, F.array_sort(F.array_distinct(F.when(F.size("_below") > 0, F.col("_below")).otherwise(least)))).drop("_words", "_hashes", "_below")


def containment(a: str, b: str) -> Column:
    """Share of the smaller sketch that is in the other one: 1 for two empty sketches, 0 if only one is empty."""
    least = F.least(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(least > 0, both / least).when(F.size(a) == F.size(b), 1.0).otherwise(0.0)


def shared_runs(text_a: str, text_b: str, k: int = WORDS) -> Column:
    """Share of the distinct runs of ``k`` words of the text with fewer of them that stand in the other one too, exactly.

    If a text has fewer than ``k`` words, runs are as long as the shorter text. Both texts have words.
    """
    # Arrays of one element bind what is used more than once.
    words = F.array(F.struct(words_of(text_a).alias("a"), words_of(text_b).alias("b")))

    def runs(words: Column, n: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.xxhash64(F.slice(words, i, n))))

    def both_runs(p: Column) -> Column:
        n = F.least(F.lit(k), F.size(p["a"]), F.size(p["b"]))
        return F.struct(runs(p["a"], n).alias("a"), runs(p["b"], n).alias("b"))

    share = F.transform(F.transform(words, both_runs), lambda r: F.size(F.array_intersect(r["a"], r["b"])).cast("double") / F.least(F.size(r["a"]), F.size(r["b"])))
    return share[0]


def likeness(text_a: str, a: str, text_b: str, b: str) -> Column:
    """``containment`` of sketches ``a`` and ``b``; where either holds a single hash, exactly from the texts they were made of.

    A single hash may lie above the bound, or be that of a text of fewer than five words; both miss in the sketch of a longer text.
    """
    return F.when(F.least(F.size(a), F.size(b)) == 1, shared_runs(text_a, text_b)).otherwise(containment(a, b))


def as_text(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def rank_among(value: Column, bounds: list[int], equal: bool = False) -> Column:
    """How many of the ascending ``bounds`` are below ``value`` (or ``equal`` to it), by binary search in one constant array."""
    array = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        above = (F.get(array, middle) <= value) if equal else (F.get(array, middle) < value)
        done = s["lo"] >= s["hi"]
        return F.struct(F.when(~done & above, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(~done & ~above, middle).otherwise(s["hi"]).alias("hi"))

    whole = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(bounds).bit_length())), whole, halve)["lo"]


def range_of(rows: DataFrame, buckets: int) -> Column:
    """Number of the range a row (doc_id, _hash) falls into, ascending in both; null ids are before all.

    Ranges are cut at quantiles of the ids themselves, wherever these lie; an id that fills several is divided by the hash.
    """
    if buckets < 2:
        return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.lit(0))
    at = [i / buckets for i in range(1, buckets)]
    bounds = rows.agg(F.percentile_approx("doc_id", at, 10 * buckets)).first()[0] or []
    below = rank_among(F.col("doc_id"), bounds)
    filled = rank_among(F.col("doc_id"), bounds, equal=True) - below
    # The hash as a share of its range, in steps that floating point keeps apart.
    share = F.floor((F.shiftright("_hash", 32) + (1 << 31)) * filled / (1 << 32)).cast("int")
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(below + F.when(filled > 1, share).otherwise(F.lit(0)))


def with_next(docs: DataFrame, bucket_rows: int = 2000) -> DataFrame:
    """doc_id, text (null: empty), sketch, and next_text, next_sketch of the next row in descending order of doc_id.

    After the last row comes the first. Rows of one doc_id follow each other by descending text hash; null ids come last. Rows are cut
    into ranges of about ``bucket_rows`` rows (65,536 ranges at most; see :func:`range_of`) that are windows of their own; the first row of each
    stands as a guest at the end of the range before it, so texts are shuffled once and no window spans the table. Only rows equal in id and
    text, and those without id, cannot be divided.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = min(65_536, max(1, rows.count() // bucket_rows))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    rows = rows.withColumn("_bucket", range_of(rows, buckets))

    heads = materialize(rows.groupBy("_bucket").agg(F.max(F.struct("doc_id", "_hash", "text")).alias("_head")), "heads")
    ids = heads.select("_bucket")
    # Bucket numbers only, 65,537 at most.
    falling = Window.orderBy(F.desc("_bucket"))
    lowest = F.min("_bucket").over(falling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    hosts = ids.select("_bucket", F.coalesce(F.lag("_bucket").over(falling), lowest).alias("_host"))
    guests = heads.join(F.broadcast(hosts), "_bucket").select("_head.doc_id", "_head.text", "_head._hash", F.col("_host").alias("_bucket"), F.lit(1).alias("_guest"))
    every = add_sketch(rows.withColumn("_guest", F.lit(0)).unionByName(guests), "text", "sketch")
    order = Window.partitionBy("_bucket").orderBy("_guest", F.col("doc_id").desc_nulls_last(), F.desc("_hash"))
    ahead = F.lead(F.struct("text", "sketch")).over(order)
    return every.withColumn("_next", ahead).where("_guest = 0").select("doc_id", "text", "sketch", F.col("_next.text").alias("next_text"), F.col("_next.sketch").alias("next_sketch"))


def edited(rows: DataFrame) -> DataFrame:
    """Add n_chars and edited: the text whose last half is replaced by the beginning of ``next_text``."""
    n = F.char_length("text")
    rows = rows.withColumn("n_chars", n.cast("long"))
    return rows.withColumn("edited", F.expr("concat(substring(text, 1, CAST(n_chars - n_chars div 2 AS INT)), substring(next_text, 1, CAST(n_chars div 2 AS INT)))"))
