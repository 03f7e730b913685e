"""Best-fit packing of tokenized documents into training sequences by large-item matching.

Pieces are integers from 1 to ``capacity``, so the whole corpus is described by how many pieces there are of each length:
at most ``capacity`` rows, whatever the input. On that histogram the packing is decided exactly as best-fit decreasing would
decide it piece by piece, a run of equal lengths at a time:

* pieces longer than a third of the capacity are at most two to a sequence: from the longest down, each is matched with the
  longest other one that still fits;
* shorter pieces go, longest first, into the sequence with the smallest gap that holds them, else into a new one.

The decision is a table of *placements* - "pieces number lo to lo + n of this length go to these sequences at this place" -
of a few thousand rows, bounded by the capacity alone. Every piece then looks up its own number (rank) in it.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import in_batches, lean, materialize, ship, slots
from shelfmark.llm.tokens import WordTokens

ship(__name__)

#: Bytes of ids that a task gathers before it hands them on.
HELD_BYTES = 4 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def plan(histogram: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Placements for ``histogram`` (length -> number of pieces), as parallel arrays sorted by (length, lo).

    ``copies`` pieces of the length stand next to each other in every one of the sequences from ``sequence`` on, the first at
    ``offset``. Equal inputs give equal plans.
    """
    left = {n: c for n, c in sorted(histogram.items()) if c}
    assert all(0 < n <= capacity for n in left), "a piece is longer than the capacity"
    taken = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    open_gaps: list[int] = []  # sorted
    sequences = 0

    def place(length: int, bins: int, copies: int, first: int, offset: int) -> None:
        rows.append((length, taken[length], copies, first, offset))
        taken[length] += bins * copies
        left[length] -= bins * copies

    def put_gap(gap: int, first: int, bins: int) -> None:
        if gap > 0 and bins:
            if gap not in gaps:
                bisect.insort(open_gaps, gap)
                gaps[gap] = []
            gaps[gap].append((first, bins))

    large = [n for n in left if 3 * n > capacity]
    for n in reversed(large):
        while left[n]:
            at = bisect.bisect_right(large, min(capacity - n, n)) - 1
            while at >= 0 and left[large[at]] < (2 if large[at] == n else 1):
                at -= 1
            if at < 0:
                bins = left[n]
                place(n, bins, 1, sequences, 0)
                put_gap(capacity - n, sequences, bins)
            else:
                m = large[at]
                bins = left[n] // 2 if m == n else min(left[n], left[m])
                place(n, bins, 1, sequences, 0)
                place(m, bins, 1, sequences, n)
                put_gap(capacity - n - m, sequences, bins)
            sequences += bins

    for n in reversed([n for n in left if 3 * n <= capacity]):
        while left[n]:
            at = bisect.bisect_left(open_gaps, n)
            if at == len(open_gaps):
                gap, first, bins = capacity, sequences, -(-left[n] // (capacity // n))
                sequences += bins
            else:
                gap = open_gaps[at]
                first, bins = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[at]
            copies = gap // n
            full = min(bins, left[n] // copies)
            if full:
                place(n, full, copies, first, capacity - gap)
                put_gap(gap - copies * n, first, full)
            rest = min(left[n], copies) if full < bins else 0
            if rest:
                place(n, 1, rest, first + full, capacity - gap)
                put_gap(gap - rest * n, first + full, 1)
            put_gap(gap, first + full + bool(rest), bins - full - bool(rest))

    rows.sort()
    names = ("length", "lo", "copies", "sequence", "offset")
    return {k: np.array(v, np.int64) for k, v in zip(names, zip(*rows) if rows else [[]] * 5, strict=True)}


def tokenize(docs: DataFrame, tokenizer: str, capacity: int, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: its ids and a closing 0, cut at ``capacity`` only. Null text counts as empty.

    ``ids_crc32`` is over the little-endian 32-bit ids; ``keep_ids`` adds them as ``ids``, handed on a few megabytes at a time.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * keep_ids)
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(tokenizer, 100_000) if keep_ids else WordTokens(tokenizer)
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            held = 0
            for i, doc in enumerate(batch.column(0).to_pylist()):
                text = batch.column(1)[i].as_py()
                ids = words.encode(text) + b"\0\0\0\0"
                for nth, at in enumerate(range(0, len(ids), width)):
                    own = ids[at : at + width]
                    for c, v in zip(out, (doc, nth, at // 4, len(own) // 4, zlib.crc32(own)), strict=False):
                        c.append(v)
                    if keep_ids:
                        out[5].append(np.frombuffer(own, "<i4"))
                        held += len(own)
                if held > HELD_BYTES:
                    yield in_batches(out, schema)
                    out, held = [[] for _ in schema], 0
            yield in_batches(out, schema)

    ddl = PIECES + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(lean(run), ddl)


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces; all its columns stay.

    Pieces of one length are numbered without bringing them together: counts per (length, bucket), running sums over
    those, and a row number inside each bucket. Only the histogram (at most ``capacity`` rows) reaches the driver.
    """
    spark = pieces.sparkSession
    buckets = max(64, 4 * slots(spark))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    histogram = {r[0]: r[1] for r in dealt.groupBy("length").agg(F.count("*")).collect()}
    placed = plan(histogram, capacity)

    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_row", F.row_number().over(inside)).join(base, ["length", "_bucket"])
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    ranked = ranked.select(*columns, (F.col("_base") + F.col("_row") - 1).alias("_rank"))

    key = placed["length"] << 44 | placed["lo"]

    def look_up(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = length.to_numpy(), rank.to_numpy()
        at = np.searchsorted(key, length << 44 | rank, "right") - 1
        nth = rank - placed["lo"][at]
        sequence = placed["sequence"][at] + nth // placed["copies"][at]
        offset = placed["offset"][at] + nth % placed["copies"][at] * length
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    # Only two numbers of a piece go to Python; its ids stay where they are.
    place = F.arrow_udf(look_up, "sequence_id long, offset long")
    found = ranked.withColumn("_place", place("length", "_rank"))
    return found.select(*columns, "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, keep_ids: bool = True) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are ignored) into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, ids (with ``keep_ids``), sequence_id, offset; ids are gapless from
    0 in every sequence. Null or empty text is one piece holding the closing 0. Repeated rows are packed each for itself; a
    null doc_id stays null. An empty table gives no rows.
    """
    return place_pieces(materialize(tokenize(docs, tokenizer, capacity, keep_ids), "pieces"), capacity)
