"""Packing by power-of-two decomposition: every document is cut into pieces of binary lengths, and each piece is a sequence.

A document of n tokens becomes as many pieces of the capacity (a power of two) as fit, then one piece for each bit of the rest,
longest first. Pieces of one length form a bucket; a training batch is drawn from one bucket, so its sequences are equally
long, hold one document each and need no padding and no attention across documents.

A piece depends on its own document alone. The work is therefore one pass without a shuffle, whatever the input: a sequence
is numbered by its bucket, its task and its place among the task's sequences of that bucket.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import ship
from shelfmark.llm.tokens import WordTokens

ship(__name__)

#: Bits of a sequence number: bucket, task, place in the task's share of the bucket.
TASK_BITS, PLACE_BITS = 26, 32

PIECES = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, sequence_id long, offset long, ids array<int>"


def binary_lengths(n: int, capacity: int) -> list[int]:
    """``n`` as pieces of ``capacity`` and the powers of two of the rest, falling."""
    full, rest = divmod(n, capacity)
    return [capacity] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, closing: int = 1) -> DataFrame:
    """Sequences of binary length of ``docs`` (doc_id, text; other columns are ignored): one row per piece.

    ``start`` counts the document's ids before the piece, ``doc_tokens`` all its ids with the ``closing`` one; ``ids_crc32`` is over
    little-endian 32-bit ids; ``offset`` is 0, as a sequence holds one piece. ``sequence_id`` is unique; ``bucket_place`` takes it apart.
    Null or empty text is one piece that holds the closing id. Repeated rows, and rows of one doc_id, are cut each for itself; a
    null doc_id stays null. An empty table gives no rows. A task holds one Arrow batch of texts and its ids. A lost task
    repeats its own split of the input with the same numbers.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"the capacity {capacity} is not a power of two")
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
    schema = pa.schema(list(zip([c.split()[0] for c in PIECES.split(", ")], kinds, strict=True)))
    end = closing.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, placed = WordTokens(tokenizer), Counter()
        task = TaskContext.get().partitionId() << PLACE_BITS
        for batch in batches:
            texts: list[bytes] = []
            owners, starts, lengths, totals, sums, numbers = [], [], [], [], [], []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = words.encode(text) + end
                texts.append(ids)
                view, n, at = memoryview(ids), len(ids) // 4, 0
                for length in binary_lengths(n, capacity):
                    owners.append(doc)
                    starts.append(at)
                    lengths.append(length)
                    totals.append(n)
                    sums.append(zlib.crc32(view[4 * at : 4 * (at + length)]))
                    bucket = length.bit_length() - 1
                    numbers.append(bucket << TASK_BITS + PLACE_BITS | task | placed[bucket])
                    placed[bucket] += 1
                    at += length
            # The pieces follow one another in the joined ids, so their ends are running sums of the lengths.
            bounds = pa.array(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32))
            values = pa.array(np.frombuffer(b"".join(texts), "<i4"))
            columns = [pa.array(c, pa.int64()) for c in (owners, starts, lengths, totals, sums, numbers)]
            zeros = pa.array(np.zeros(len(owners), np.int64))
            yield pa.RecordBatch.from_arrays([*columns, zeros, pa.ListArray.from_arrays(bounds, values)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, PIECES)


def bucket_place(packed: DataFrame) -> DataFrame:
    """Add ``task`` and ``place``: where a sequence stands in its bucket. Places of a task count from 0 without gaps."""
    task = F.shiftright("sequence_id", PLACE_BITS).bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    return packed.withColumns({"task": task, "place": F.col("sequence_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))})


def batches(packed: DataFrame, tokens: int) -> DataFrame:
    """Add ``batch``: rows of one (length, task, batch) hold at most ``tokens`` tokens, all batches but a task's last of a bucket exactly so."""
    per_batch = F.greatest(F.floor(F.lit(tokens) / F.col("length")), F.lit(1))
    return bucket_place(packed).withColumn("batch", F.floor(F.col("place") / per_batch)).drop("place")


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences with one folder for each length. The rebalance groups a length's rows and splits a length too large for one task."""
    packed.hint("rebalance", "length").write.partitionBy("length").parquet(path)


def read_bucket(spark: SparkSession, path: str, length: int) -> DataFrame:
    """The sequences of one length; other folders are not opened."""
    return spark.read.parquet(path).where(F.col("length") == length)
