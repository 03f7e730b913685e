"""Removal of runs of lines that stand earlier in the corpus, by winnowing over line hashes.

The lines of a document (trimmed; blank ones are only separators) are hashed. A *window* is the shortest stretch of lines from a
given line on that holds ``min_words`` words. Every window selects the smallest hash in it (the last one on ties): if that line
alone has ``min_words`` words, the line is the fingerprint, else the whole window is. So any repeated run of ``min_words`` words has
a fingerprint in common with its first occurrence, however short its lines are.

Each fingerprint is joined with its first position in the corpus, by (doc_id, text, line), and extended both ways over the equal
lines around it; what is covered at a later position is deleted. A fingerprint carries its neighbouring lines as far as they
hold fewer than ``min_words`` words: beyond that, equal lines have fingerprints of their own. Every deleted line equals an earlier
one, so one copy of each always stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import first_of_group, lean, materialize, ship

ship(__name__)

MARK = "key long, doc_id long, text_hash long, pos int, span int, left array<long>, right array<long>"


def line_hashes(text: str, min_words: int) -> tuple[list[int], list[int]]:
    """Signed hashes of the lines that are not blank, and their numbers of words (counted up to ``min_words``)."""
    hashes, words = [], []
    for line in text.split("\n"):
        line = line.strip()
        if line:
            h = xxhash.xxh64_intdigest(line.encode())
            hashes.append(h - (1 << 64) if h >> 63 else h)
            words.append(min(min_words, len(line.split(None, min_words))))
    return hashes, words


def fingerprints(hashes: list[int], words: list[int], min_words: int) -> dict[tuple[int, int], int]:
    """(first line, number of lines) -> key, for the selected fingerprints."""
    out: dict[tuple[int, int], int] = {}
    end = total = 0
    for start in range(len(hashes)):
        while end < len(hashes) and total < min_words:
            total += words[end]
            end += 1
        if total < min_words:
            break
        least = min(range(start, end), key=lambda i: (hashes[i], -i))
        at, n = (least, 1) if words[least] >= min_words else (start, end - start)
        if (at, n) not in out:
            raw = np.array(hashes[at : at + n], np.int64).tobytes()
            h = xxhash.xxh64_intdigest(raw)
            out[at, n] = h - (1 << 64) if h >> 63 else h
        total -= words[start]
    return out


def around(hashes: list[int], words: list[int], at: int, step: int, min_words: int) -> list[int]:
    """Hashes from line ``at`` on in one direction, nearest first, while they hold fewer than ``min_words`` words."""
    out, total = [], 0
    while 0 <= at < len(hashes) and total + words[at] < min_words:
        total += words[at]
        out.append(hashes[at])
        at += step
    return out


def marks(docs: DataFrame, min_words: int) -> DataFrame:
    """One row for each fingerprint of each document."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    schema = pa.schema([(c.split()[0], k) for c, k in zip(MARK.split(", "), kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text_hash, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes, words = line_hashes(text or "", min_words)
                for (at, n), key in fingerprints(hashes, words, min_words).items():
                    left = around(hashes, words, at - 1, -1, min_words)
                    right = around(hashes, words, at + n, 1, min_words)
                    rows.append((key, doc, text_hash, at, n, left, right))
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text").mapInArrow(lean(run), MARK)


def repeats(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_hash, from, to): stretches of lines, ``to`` excluded, that stand earlier in the corpus."""
    here = F.struct("doc_id", "text_hash", "pos", "span", "left", "right")
    found = materialize(marks(docs, min_words).distinct().select("key", here.alias("here")), "fingerprints")
    later = first_of_group(found, "key", "here").where("size > 1 AND here <> first")
    # Equal neighbours: those before the first difference.
    equal = "CAST(array_position(array_append(zip_with(here.{0}, first.{0}, (a, b) -> a <=> b), false), false) - 1 AS INT)"
    more = [F.expr(equal.format(side)) for side in ("left", "right")]
    return later.select(
        "here.doc_id",
        "here.text_hash",
        (F.col("here.pos") - more[0]).alias("from"),
        (F.col("here.pos") + F.col("here.span") + more[1]).alias("to"),
    )


def dedup_lines(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """``docs`` with ``text`` without the runs of at least ``min_words`` words that stand earlier, and two counts.

    ``n_lines`` counts the lines that are not blank before, ``n_cut`` those deleted; columns of these names are replaced, all others
    stay as they are. Earlier means a smaller doc_id (null before all), then text hash, then line. Documents without a repeat keep
    their text to the letter, null included; a document all of whose lines stand earlier is left with an empty text. Rows equal in
    doc_id and text are one document: they get the same cuts and do not count as repeats of each other.
    """
    cuts = repeats(docs, min_words).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("from", "to")).alias("_cuts"))
    cuts = cuts.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_cuts")
    own = [c for c in docs.columns if c not in ("n_lines", "n_cut")]
    keyed = docs.select(*own, F.xxhash64("text").alias("_text_hash"))
    same = keyed["doc_id"].cast("long").eqNullSafe(cuts["_id"]) & (keyed["_text_hash"] == cuts["_hash"])
    joined = keyed.join(cuts, same, "left").select(*own, "_cuts")
    at = own.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, cut = [], [], []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column(len(own)).to_pylist(), strict=True):
                drop = {i for c in gone or [] for i in range(c["from"], c["to"])}
                kept, n = [], 0
                for line in (text or "").split("\n"):
                    if line.strip():
                        n += 1
                        if n - 1 in drop:
                            continue
                    kept.append(line)
                left = "\n".join(kept)
                texts.append(text if not drop else left if left.strip() else "")
                lines.append(n)
                cut.append(len(drop))
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(own))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(cut, pa.int64())], [*own, "n_lines", "n_cut"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in own]
    return joined.mapInArrow(lean(run), ", ".join([*kinds, "n_lines long", "n_cut long"]))
