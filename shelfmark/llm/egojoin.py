"""Cosine similarity join of vectors by epsilon grid order.

Unit vectors of cosine c are sqrt(2 - 2c) = eps apart. Vectors are turned so that their leading principal dimensions come first, cut into
grid cells of side eps on these, and sorted by cell, dimension after dimension. The sorted sequence is cut into blocks; a block, and any
interval of blocks, has a box around it, and two intervals whose boxes are further than eps apart are provably without links. The
join starts with the largest intervals and recursively splits those that are not, down to pairs of blocks, which are compared
as matrices. Which dimensions lead is learned from a bounded sample; it decides what is skipped, never what is linked.

Vectors of each length are joined among themselves: the length leads the sort order, a block holds one length, and the first dimension of
its box is a multiple of the length that sets blocks of different lengths further apart than any eps.

Equal vectors are one vector with a count. A pair of blocks returns, for each vector, how many it is linked to and the smallest
vector it reaches inside the pair: never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import first_of_group, materialize, ship
from shelfmark.llm.components import connected_components

ship(__name__)

LEADING = 8
BLOCK = 2048
INNER = 256
FAN_OUT = 8


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square under- or overflows."""
    x = raw / np.abs(raw).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal(sample: list[list[float]]) -> np.ndarray:
    """The leading principal dimensions of vectors of one length, as LEADING columns; those that do not exist are zero."""
    u = unit(np.array(sample, float))
    u = u - u.mean(axis=0)
    n, size = u.shape
    found = np.linalg.svd(u, full_matrices=False)[2].T if n < size else np.linalg.eigh(u.T @ u)[1][:, ::-1]
    axes = np.zeros((size, LEADING))
    axes[:, : min(LEADING, found.shape[1])] = found[:, :LEADING]
    return axes


def turned(u: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Unit vectors of one length on its leading dimensions; all at zero for a length that the sample does not hold."""
    known = axes.get(u.shape[1])
    return np.zeros((len(u), LEADING)) if known is None else u @ known


def blocks_of(vectors: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Blocks of the sequence: place, box on length and leading dimensions, and ids, counts and vectors as bytes."""
    sort_by = ["dim"] + [f"c{i}" for i in range(LEADING)] + ["y0", "y1"]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.array(batch.column(2).flatten().to_numpy(zero_copy_only=False), float)
            dims = np.array(batch.column(2).value_lengths().to_numpy(zero_copy_only=False), np.int32)
            ends = np.cumsum(dims, dtype=np.int64)
            y, packed = np.zeros((len(dims), LEADING)), np.empty(len(dims), object)
            for size in np.unique(dims):
                at = np.flatnonzero(dims == size)
                raw = flat[(ends[at] - size)[:, None] + np.arange(size)]
                y[at] = turned(unit(raw), axes)
                packed[at] = [r.tobytes() for r in raw]
            cells = np.floor(y / eps).astype(np.int32)
            columns = [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(dims), *(pa.array(cells[:, i]) for i in range(LEADING)), *(pa.array(y[:, i]) for i in range(2))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "n", "raw", *sort_by])

    kinds = ", ".join(["dim int"] + [f"c{i} int" for i in range(LEADING)] + ["y0 double", "y1 double"])
    placed = vectors.select("vec_id", "n", "embedding").mapInArrow(locate, f"vec_id long, n long, raw binary, {kinds}")
    ordered = materialize(placed, "located").repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).select("vec_id", "n", "raw")
    schema = pa.schema([("block", pa.int64()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("ids", pa.binary()), ("counts", pa.binary()), ("vectors", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        waiting: list[tuple] = []

        def block(rows: list[tuple]) -> pa.RecordBatch:
            ids, counts, raws = zip(*rows, strict=True)
            raw = np.frombuffer(b"".join(raws)).reshape(len(rows), -1)
            y = turned(unit(raw), axes)
            apart = 2.0 * raw.shape[1]  # eps is below 2
            values = [[task << 32 | made], [[apart, *y.min(axis=0)]], [[apart, *y.max(axis=0)]], [np.array(ids, np.int64).tobytes()], [np.array(counts, np.int64).tobytes()], [raw.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if waiting and (len(waiting) == BLOCK or len(row[2]) != len(waiting[0][2])):
                    yield block(waiting)
                    waiting, made = [], made + 1
                waiting.append(row)
        if waiting:
            yield block(waiting)

    return ordered.mapInArrow(cut, "block long, lo array<double>, hi array<double>, ids binary, counts binary, vectors binary")


def near_blocks(boxes: DataFrame, n: int, lead: int, eps: float) -> DataFrame:
    """(a, b), a <= b: blocks whose boxes are at most eps apart, by recursive splitting of intervals of the sequence."""
    spark = boxes.sparkSession
    levels = 0
    while FAN_OUT**levels < n:
        levels += 1
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    gap = " + ".join(f"power(greatest(0D, lo_a[{i}] - hi_b[{i}], lo_b[{i}] - hi_a[{i}]), 2)" for i in range(lead)) or "0D"
    for level in reversed(range(levels)):
        width = FAN_OUT**level
        box = [F.array(*(f(F.col(c)[i]) for i in range(lead))).alias(c) for f, c in ((F.min, "lo"), (F.max, "hi"))]
        intervals = boxes.groupBy(F.floor(F.col("at") / width).alias("i")).agg(*box)
        split = pairs
        for side in ("a", "b"):
            own = F.col(side) * FAN_OUT
            split = split.withColumn(side, F.explode(F.sequence(own, own + FAN_OUT - 1)))
        split = split.where("a <= b")
        for side in ("a", "b"):
            split = split.join(intervals.select(F.col("i").alias(side), F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}")), side)
        pairs = split.where(F.expr(gap) <= eps * eps * (1 + 1e-9)).select("a", "b")
    return pairs


def compare(base: tuple, other: tuple, same: bool, axes: dict[int, np.ndarray], eps: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, linked vectors, smallest id reached) of two blocks, for the vectors that are linked."""
    (ids_a, n_a, u_a), (ids_b, n_b, u_b) = base, other
    small_a, small_b = u_a.astype(np.float32), u_b.astype(np.float32)
    y_a, y_b = turned(u_a, axes), turned(u_b, axes)
    rows, cols = [], []
    for i in range(0, len(u_a), INNER):
        box = y_a[i : i + INNER]
        for j in range(i if same else 0, len(u_b), INNER):
            far = np.maximum(0, np.maximum(box.min(0) - y_b[j : j + INNER].max(0), y_b[j : j + INNER].min(0) - box.max(0)))
            if (far * far).sum() > eps * eps * (1 + 1e-9):
                continue
            s = small_a[i : i + INNER] @ small_b[j : j + INNER].T
            r, c = np.nonzero(s >= least - 1e-5)
            if len(r):
                sure = s[r, c] >= least + 1e-5
                r, c = r + i, c + j
                doubt = np.flatnonzero(~sure)
                sure[doubt] = np.einsum("ij,ij->i", u_a[r[doubt]], u_b[c[doubt]]) >= least
                if same:
                    sure &= r < c
                rows.append(r[sure].astype(np.int32))
                cols.append(c[sure].astype(np.int32))
    r, c = (np.concatenate(x) if x else np.empty(0, np.int32) for x in (rows, cols))
    links_a = np.bincount(r, n_b[c], len(ids_a)).astype(np.int64)
    links_b = np.bincount(c, n_a[r], len(ids_b)).astype(np.int64)
    top_a, top_b = ids_a.copy(), ids_b.copy()
    if same:
        links_a, top_b = links_a + links_b, top_a
    while len(r):  # smallest id along links, until nothing changes
        before = top_a.sum() + top_b.sum()
        np.minimum.at(top_a, r, top_b[c])
        np.minimum.at(top_b, c, top_a[r])
        if top_a.sum() + top_b.sum() == before:
            break
    out = [(ids_a, links_a, top_a)] if same else [(ids_a, links_a, top_a), (ids_b, links_b, top_b)]
    ids, links, top = (np.concatenate(x) for x in zip(*out, strict=True))
    some = links > 0
    return ids[some], links[some], top[some]


def join_blocks(blocks: DataFrame, pairs: DataFrame, axes: dict[int, np.ndarray], eps: float, least: float) -> DataFrame:
    """(vec_id, links, reached) for each vector linked within a pair of blocks.

    Block a goes once to each of (a, b modulo 8), block b once for each pair; a task holds two blocks at a time.
    """
    dealt = pairs.withColumn("part", F.col("b") % 8)
    data = blocks.select("at", "ids", "counts", "vectors")
    left = dealt.select("a", "part").distinct().join(data, F.col("a") == data["at"]).select("a", "part", F.lit(-1).cast("long").alias("b"), "ids", "counts", "vectors")
    right = dealt.join(data, F.col("b") == data["at"]).select("a", "part", "b", "ids", "counts", "vectors")
    rows = left.union(right).repartition("a", "part").sortWithinPartitions("a", "part", "b")
    schema = pa.schema([("vec_id", pa.int64()), ("links", pa.int64()), ("reached", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base: tuple = ()
        for batch in batches:
            for i in range(batch.num_rows):
                a, _, b, ids, counts, raw = (batch.column(k)[i].as_py() for k in range(6))
                known = np.frombuffer(ids, np.int64)
                own = known, np.frombuffer(counts, np.int64), unit(np.frombuffer(raw).reshape(len(known), -1))
                if b < 0:
                    base = own
                else:
                    found = compare(base, own, a == b, axes, eps, least)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)

    return rows.mapInArrow(run, "vec_id long, links long, reached long")


def similar(embeddings: DataFrame, least: float = 0.95, sample_rows: int = 10_000) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings`` (vec_id, embedding; other columns are ignored).

    Links are pairs of rows with cosine >= ``least`` (above 0), in double precision. A repeated row is another vector, linked to the
    first; different vectors of one vec_id share their links. Vectors of different lengths are not linked, those of each length are joined.
    Vectors that are null, zero, empty or hold null or non-finite components, and rows without vec_id, link with nothing; a row without
    vec_id has a null component and is kept. An empty table gives no rows. ``sample_rows`` bounds the vectors, of all lengths
    together, that the principal dimensions are learned from.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.expr("vec_id IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(embedding, x -> x <> 0)")
    good = rows.where(F.coalesce(sound, F.lit(False)))
    # -0.0 equals 0.0.
    good = good.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    groups = materialize(first_of_group(good, "embedding", "vec_id").select("vec_id", "first", "size", F.when(F.col("vec_id") == F.col("first"), F.col("embedding")).alias("embedding")), "vectors")
    vectors = groups.where("vec_id = first").dropDuplicates(["vec_id", "embedding"]).select("vec_id", F.col("size").alias("n"), "embedding")
    eps = float(np.sqrt(2 - 2 * least))
    sample: dict[int, list[list[float]]] = {}
    for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("embedding").collect():
        sample.setdefault(len(r[0]), []).append(r[0])
    axes = {size: principal(some) for size, some in sample.items()}

    if sample:
        blocks = materialize(blocks_of(vectors, axes, eps), "blocks")
        # Places of blocks only: one narrow row for 2048 vectors.
        blocks = blocks.join(blocks.select("block", (F.row_number().over(Window.orderBy("block")) - 1).cast("long").alias("at")), "block")
        boxes = materialize(blocks.select("at", "lo", "hi"), "boxes")
        pairs = materialize(near_blocks(boxes, boxes.count(), 1 + LEADING, eps), "near")
        found = materialize(join_blocks(blocks, pairs, axes, eps, least), "links")
    else:
        found = rows.sparkSession.createDataFrame([], "vec_id long, links long, reached long")
    linked = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("vec_id").alias("a"), F.col("reached").alias("b")))
    whole = linked.join(component, linked["vec_id"] == component["node"], "left").select(F.col("vec_id").alias("first"), "links", "component")
    ready = groups.select("vec_id", "first", "size").join(whole, "first", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("size") - 1
    done = ready.select("vec_id", n_links.alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    rest = rows.where(~F.coalesce(sound, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
