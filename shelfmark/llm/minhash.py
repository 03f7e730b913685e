"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

One permutation scatters the shingles over a universe of 2^20 places; a second one, shifted circularly by k, gives coordinate k of
the signature. A shingle's values under all shifts stand next to each other in the second permutation's table, so the whole
signature is the minimum over slices of one small array. Bands of coordinates are hashed; documents that share a band are
candidates, and a candidate is a link only if the full sets of shingles say so.

Documents of equal sets are one candidate. Inside a bucket candidates are compared with its smallest document first, and what ends
up in one component needs no further look. In a bucket that still holds several components, the documents outside its largest
one meet all others of the bucket, cut into groups of bounded size; a group counts common shingles in place and returns at most
one link from a document to a component, never its pairs. So every pair that shares a band is either connected or checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SALTS, first_of_group, lean, materialize, salt_of, ship, slots
from shelfmark.llm.components import connected_components

ship(__name__)

UNIVERSE_BITS = 20
#: Bands and rows of a band. A pair at Jaccard 0.8 shares no band with probability (1 - 0.8^6)^32 = 6e-5.
BANDS, ROWS = 32, 6
#: Documents of a bucket that meet in one group: so many outside its largest component, and so many of all.
OUTSIDE, INSIDE = 500, 1000
#: Buckets of document ids of which the wanted ones are broadcast: at most so many integers, whatever the input.
ID_BUCKETS = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes (a bijection)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles; of the whole sequence where it has fewer words; empty without words.

    Words stand between ASCII white space; A-Z are lower-cased.
    """
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    width = min(k, n)
    acc = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[j : n - width + 1 + j])
    return np.unique(acc)


class Circulant:
    """Signatures of sets of 64-bit hashes."""

    def __init__(self, length: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        size = 1 << UNIVERSE_BITS
        self.scatter = rng.permutation(size).astype(np.uint32)
        ring = rng.permutation(size).astype(np.uint32)
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[:length]]), length)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = self.scatter[(hashes >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
        least = self.shifted[at[:2048]].min(axis=0)
        for i in range(2048, len(at), 2048):
            np.minimum(least, self.shifted[at[i : i + 2048]].min(axis=0), out=least)
        return least


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One hash for each band of a signature, the band's number in it."""
    parts = signature.reshape(bands, -1).astype(np.uint64)
    acc = np.arange(bands, dtype=np.uint64)
    for j in range(parts.shape[1]):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return acc.view(np.int64)


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, and a hash for each band (none for an empty set)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = Circulant(bands * rows)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = shingle_set(text, k)
                keys = band_keys(sign(hashes), bands) if len(hashes) else np.empty(0, np.int64)
                for c, v in zip(out, (doc, len(hashes), xxhash.xxh128_digest(hashes.tobytes()), keys), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    ids = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return ids.mapInArrow(lean(run), "doc_id long, n_shingles long, digest binary, bands array<long>")


def id_bucket(c: str | Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(ID_BUCKETS)).cast("int")


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(doc_id, set) of the documents in ``wanted``; their texts are found without shuffling all texts."""
    buckets = wanted.select(id_bucket("doc_id").alias("_bucket")).distinct()
    near = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    near = near.withColumn("_bucket", id_bucket("doc_id")).join(F.broadcast(buckets), "_bucket", "left_semi")
    schema = pa.schema([("doc_id", pa.int64()), ("set", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, k).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], schema=schema)

    exact = near.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    return exact.mapInArrow(lean(run), "doc_id long, set binary")


def verify(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    Pairs meet at (a, salt of b): a's set goes there once, b's set once for each pair, and the sorted stream holds one set of a.
    """
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = materialize(sets_of(docs, wanted, k), "sets")
    salted = pairs.withColumn("salt", salt_of("b", salts=max(SALTS, slots(docs.sparkSession))))
    left = salted.select("a", "salt").distinct().join(sets, F.col("a") == sets["doc_id"])
    right = salted.join(sets, F.col("b") == sets["doc_id"])
    rows = left.select("a", "salt", F.lit(None).cast("long").alias("b"), "set").union(right.select("a", "salt", "b", "set"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, base = None, []
        for batch in batches:
            found: tuple[list, list] = ([], [])
            for a, salt, b, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(raw, np.uint64)
                if b is None:
                    base = [*base, own] if key == (a, salt) else [own]
                    key = (a, salt)
                    continue
                for one in base:
                    both = len(np.intersect1d(one, own, assume_unique=True))
                    if 100 * both >= percent * (len(one) + len(own) - both):
                        found[0].append(a)
                        found[1].append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(lean(run), "a long, b long").distinct()


class Held:
    """Sets that wait for others to be compared with: for each shingle the sets that have it."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray]]):
        self.ids, self.own, sets = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
        self.own = np.array(self.own, np.int64)
        self.sizes = np.array([len(x) for x in sets], np.int64)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(values, kind="stable")
        self.owners = owners[order]
        self.values, self.starts = np.unique(values[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(values))

    def common(self, hashes: np.ndarray) -> np.ndarray:
        """Number of shingles each held set has in common with ``hashes``."""
        at = np.intersect1d(self.values, hashes, assume_unique=True, return_indices=True)[1]
        if not len(at):
            return np.zeros(len(self.sizes), np.int64)
        n = self.ends[at] - self.starts[at]
        places = np.repeat(self.starts[at] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return np.bincount(self.owners[places], minlength=len(self.sizes))


def settle(members: DataFrame, components: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between components that share a bucket of ``members`` (key, doc_id), at most one for a document and component."""
    rows = members.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    rows = rows.select("key", "doc_id", F.coalesce("component", "doc_id").alias("own"))
    whole = rows.groupBy("key", "own").agg(F.count("*").alias("n")).groupBy("key")
    whole = whole.agg(F.sum("n").alias("n"), F.max(F.struct("n", "own")).alias("top"), F.count("*").alias("owns")).where("owns > 1")
    cut = whole.select("key", F.col("top.own").alias("main"), F.expr(f"(n - top.n) div {OUTSIDE} + 1").alias("outs"), F.expr(f"n div {INSIDE} + 1").alias("ins"))
    rows = materialize(rows.join(cut, "key"), "open")
    held = rows.where("own <> main").select("key", F.pmod(F.xxhash64("doc_id"), "outs").alias("r"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("ins") - 1)).alias("m"), F.lit(0).alias("kind"), "doc_id", "own")
    other = rows.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("outs") - 1)).alias("r"), F.pmod(F.xxhash64("doc_id", F.lit(1)), "ins").alias("m"), F.lit(1).alias("kind"), "doc_id", "own")
    sets = materialize(sets_of(docs, rows, k), "sets")
    dealt = held.union(other).join(sets, "doc_id").select("key", "r", "m", "kind", "doc_id", "own", "set")
    dealt = dealt.repartition("key", "r", "m").sortWithinPartitions("key", "r", "m", "kind")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, waiting, base, told = None, [], None, set()
        for batch in batches:
            found: tuple[list, list] = ([], [])
            for key, r, m, kind, doc, own, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = np.frombuffer(raw, np.uint64)
                if group != (key, r, m):
                    group, waiting, base, told = (key, r, m), [], None, set()
                if kind == 0:
                    waiting.append((doc, own, hashes))
                    continue
                base = base or Held(waiting)
                both = base.common(hashes)
                linked = (100 * both >= percent * (base.sizes + len(hashes) - both)) & (base.own != own)
                for i in np.flatnonzero(linked):
                    if (i, own) not in told:
                        told.add((i, own))
                        found[0].append(base.ids[i])
                        found[1].append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

    return dealt.mapInArrow(lean(run), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (doc_id = component_id), one row per row.

    Only doc_id and text of ``docs`` are read. Null and empty texts and texts without words have an empty set and link with
    nothing. Rows of one doc_id are one node, whose links are those of all its rows. A row without doc_id links with nothing: its
    component_id is null and it is kept. An empty table gives no rows.
    """
    signed = materialize(signatures(docs, k, bands, rows), "signatures")
    filled = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = first_of_group(filled.select("digest", "doc_id", "bands"), "digest", "doc_id")
    links = materialize(copies.where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct(), "copies")
    banded = copies.where("doc_id = first").select(F.explode("bands").alias("key"), "doc_id").distinct()

    shared = first_of_group(banded, "key", "doc_id").where("size > 1")
    members = materialize(shared.select("key", "doc_id", "first"), "members")
    pairs = members.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    components = connected_components(links.union(verify(materialize(pairs, "pairs"), docs, k, percent)))
    components = connected_components(components.toDF("a", "b").union(settle(members.select("key", "doc_id"), components, docs, k, percent)))

    out = signed.select("doc_id", "n_shingles").join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns as they are, less all but one of each group of near-duplicates: that of the smallest doc_id.

    A doc_id that stands on several rows with different texts, or is null, names no document: such rows are told apart by their text and
    numbered behind all others, so none goes for what another one is. Of rows equal in doc_id and text one stays. Rows without words
    link with nothing; of those too, equal ones stay once only where they share a doc_id that repeats, or lack one.
    """
    columns = docs.columns
    ids = docs.select(F.col("doc_id").cast("long").alias("_id"))
    odd = materialize(ids.groupBy("_id").agg(F.count("*").alias("_n")).where("_n > 1 OR _id IS NULL").select("_id"), "odd-ids")
    if odd.isEmpty():
        found = near_duplicates(docs, k=k, percent=percent)
        gone = found.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
        return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti").select(*columns)

    # Two hashes: rows are told apart by 128 bits of their text.
    marks = [F.xxhash64("text").alias("_h"), F.xxhash64("text", F.lit(1)).alias("_g")]
    marked = docs.select("*", F.col("doc_id").cast("long").alias("_own"), *marks)
    texts = marked.select("_own", "_h", "_g").join(odd, F.col("_own").eqNullSafe(F.col("_id")), "left_semi").distinct()
    parts = 2 * slots(docs.sparkSession)
    placed = texts.repartitionByRange(parts, F.col("_own").asc_nulls_last(), "_h", "_g").sortWithinPartitions(F.col("_own").asc_nulls_last(), "_h", "_g")
    numbered = materialize(placed.withColumn("_node", F.lit(1 << 62) + F.monotonically_increasing_id()), "nodes")
    named = numbered.select(F.col("_own").alias("_o"), F.col("_h").alias("_a"), F.col("_g").alias("_b"), "_node")
    same = F.col("_own").eqNullSafe(F.col("_o")) & (F.col("_h") == F.col("_a")) & (F.col("_g") == F.col("_b"))
    nodes = materialize(marked.join(named, same, "left").drop("_o", "_a", "_b"), "documents")
    nodes = nodes.withColumn("_key", F.coalesce("_node", "_own"))
    found = near_duplicates(nodes.select(F.col("_key").alias("doc_id"), "text"), k=k, percent=percent)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    left = nodes.join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    # Only rows of odd ids can repeat; the others are not shuffled for it.
    once = left.where("_node IS NOT NULL").dropDuplicates(["_node"])
    return left.where("_node IS NULL").select(*columns).unionAll(once.select(*columns))
