"""Already fetched pages: body decoding and image records."""

from __future__ import annotations

import gzip
import re
import sys

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.schemas import IMAGES

# Tasks get this module's functions by value: executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

# A page may declare its charset anywhere, in a meta tag or an XML head.
_DECLARED = r"""(?i)(?:charset|encoding)\s*=\s*["']?\s*windows-1251"""
_DECLARED_BYTES = re.compile(_DECLARED.encode())

_DECODED = pa.struct([("html", pa.string()), ("error", pa.string())])


def _decode_slow(bodies: pa.Array, zipped: pa.Array, cyrillic: pa.Array, by_word: pa.Array) -> pa.Array:
    out = []
    for body, gz, cp1251, word in zip(bodies.to_pylist(), zipped.to_pylist(), cyrillic.to_pylist(), by_word.to_pylist()):
        if body is None:
            out.append(None)
            continue
        try:
            raw = gzip.decompress(body) if gz else bytes(body)
        except (OSError, EOFError, ValueError) as e:
            out.append({"html": None, "error": f"gzip: {e}"})
            continue
        if gz:
            # What the page declares is only readable now.
            cp1251 = cp1251 or (b"windows-1251" in raw if word else bool(_DECLARED_BYTES.search(raw)))
        # Undefined bytes become U+FFFD in the old code page and are deleted from UTF-8.
        html = raw.decode("cp1251", "replace") if cp1251 else raw.decode("utf-8", "ignore")
        out.append({"html": html, "error": None})
    return pa.array(out, type=_DECODED)


def decode_pages(
    pages: DataFrame,
    body: str = "body",
    encoding: str | None = None,
    status: str | None = None,
    charset: str = "declared",
    out: str = "html",
) -> DataFrame:
    """Add the page text ``out`` and ``error_type`` / ``error_message`` (NULL when it decoded).

    ``encoding`` and ``status`` name the content-encoding and status columns.  A status other
    than 200 and a broken gzip body are errors.  ``charset`` selects when Windows-1251 is
    assumed: ``declared`` when the page declares it as its charset, wherever it does so, ``word``
    when the name occurs anywhere in the body.

    Plain UTF-8 is decoded in the JVM; only bodies that need more are sent to Python.
    """
    if charset not in ("declared", "word"):
        raise ValueError(f"unknown charset rule {charset!r}")
    raw = F.col(body)
    text = raw.cast("string")
    ok = F.col(status) == 200 if status else F.lit(True)
    gz = F.coalesce(F.lower(F.col(encoding)) == "gzip", F.lit(False)) if encoding else F.lit(False)
    # Encoding names are ASCII, so looking for them in undecoded bytes is safe.
    if charset == "word":
        cyrillic = F.contains(raw, F.lit("windows-1251").cast("binary"))
    else:
        named = F.contains(raw, F.lit("1251").cast("binary"))
        cyrillic = F.when(named, F.make_valid_utf8(raw.cast("string")).rlike(_DECLARED)).otherwise(F.lit(False))
    slow = ok & (gz | cyrillic | ~F.is_valid_utf8(text))

    decode = F.arrow_udf(_annotated(_decode_slow), "struct<html:string,error:string>").asNondeterministic()
    staged = pages.withColumns({"_slow": F.coalesce(slow, F.lit(False)), "_gz": gz, "_cp": F.coalesce(cyrillic, F.lit(False))})
    staged = staged.withColumn(
        "_d", decode(F.when(F.col("_slow"), raw), F.col("_gz"), F.col("_cp"), F.lit(charset == "word"))
    )
    error = F.when(~F.coalesce(ok, F.lit(False)), F.lit("status")).when(F.col("_d.error").isNotNull(), F.lit("decode"))
    message = F.when(
        F.col("error_type") == "status", F.concat(F.lit("status "), F.coalesce(F.col(status).cast("string"), F.lit("missing")))
        if status
        else F.lit(None).cast("string"),
    ).otherwise(F.col("_d.error"))
    return (
        staged.withColumn("error_type", error)
        .withColumn("error_message", message)
        .withColumn(
            out,
            F.when(F.col("error_type").isNull(), F.when(F.col("_slow"), F.col("_d.html")).otherwise(text)),
        )
        .drop("_slow", "_gz", "_cp", "_d")
    )


def _annotated(fn):
    """Give the function real Arrow annotations (postponed ones are text to the kind inference)."""
    fn.__annotations__ = {**{k: pa.Array for k in ("bodies", "zipped", "cyrillic", "by_word")}, "return": pa.Array}
    return fn


def image_records(body: Column | str, limit: int | None = None, offset: int | None = None) -> Column:
    """JSON array text to image records, an empty list when it does not parse.

    The whole list, or one window of it when both ``limit`` and ``offset`` are given.
    """
    body = F.col(body) if isinstance(body, str) else body
    records = F.coalesce(F.from_json(body, IMAGES), F.array().cast(IMAGES))
    if limit is None or offset is None:
        return records
    return F.slice(records, F.lit(offset + 1), F.lit(limit))
