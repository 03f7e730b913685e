"""Streaming sinks and small run helpers."""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shelfmark.schemas import LONG, TEXT, plus
from shelfmark.session import drop_folder, materialize, shared_folder
from shelfmark.sources.quality import error_rows

QUERY, BATCH = "query_id", "batch_id"


def for_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, **options) -> StreamingQuery:
    """Call ``fn(batch, batch_id)`` for every micro-batch until the available input is read.

    Give ``trigger`` options (``processingTime="1 minute"``) to keep running instead.
    """
    return (
        stream.writeStream.foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
        .trigger(**(options or {"availableNow": True}))
        .start()
    )


def batch_folder(spark: SparkSession, path: str, checkpoint: str) -> Callable[[int], str]:
    """Folder of each batch, below one of the query's own.

    A query keeps its id as long as its checkpoint, so a repeated batch finds its folder again and a
    query begun anew, which counts from 0, never writes over what an earlier one left.
    """
    known: list[str] = []

    def folder(batch_id: int) -> str:
        if not known:
            known.append(spark.read.json(f"{checkpoint}/metadata").first()["id"])
        return f"{path}/{QUERY}={known[0]}/{BATCH}={batch_id}"

    return folder


def to_batch_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fn: Callable[[DataFrame, int], DataFrame] | None = None,
    partition_by: tuple[str, ...] = (),
    **options,
) -> StreamingQuery:
    """Write every micro-batch, or ``fn`` of it, to its own folder of a Parquet table.

    A repeated batch overwrites the folder it wrote before, so a retry adds nothing twice.
    """
    folder = batch_folder(stream.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        out = fn(batch, batch_id) if fn else batch
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*partition_by).parquet(folder(batch_id))

    return for_each_batch(stream, write, checkpoint, **options)


def read_batch_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all batches of all queries."""
    return spark.read.schema(plus(schema, query_id=TEXT, batch_id=LONG)).parquet(path).drop(QUERY, BATCH)


def to_files(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Append the stream to Parquet files, each row exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(options or {"availableNow": True}))
        .start()
    )


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks drop, by query, over all batches since it was attached.

    Spark itself keeps the progress of the last hundred batches only. Attach it before the query
    starts: ``late = LateRows.attach(spark)``, then ``late.of(query)``.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    @classmethod
    def attach(cls, spark: SparkSession) -> LateRows:
        listener = cls()
        spark.streams.addListener(listener)
        return listener

    def onQueryStarted(self, event):
        self.rows.setdefault(str(event.id), 0)
        self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event):
        dropped = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.rows[str(event.progress.id)] = self.rows.get(str(event.progress.id), 0) + dropped

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.runId) in self.ended:
            self.ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, timeout: float = 30) -> int:
        """Rows dropped so far; for an ended query all of them, once its last reports have arrived."""
        if not query.isActive and str(query.runId) in self.ended:
            self.ended[str(query.runId)].wait(timeout)
        return self.rows.get(str(query.id), 0)


def observed(df: DataFrame, name: str, ok) -> DataFrame:
    """Attach processed and succeeded counters to a job; read them from the query progress."""
    return df.observe(name, F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("succeeded"))


def _message(error: Exception) -> str:
    return str(error).partition("\n")[0][:500]


#: A failing batch is dealt out to parts of about so many rows, at most MOST_PARTS; ranges of up to SMALL hashes are halved by their list.
PART_ROWS, MOST_PARTS, SMALL = 20_000, 1024, 4096


def _isolate(rows: DataFrame, n_rows: int, store: Callable[[DataFrame, str], Exception | None], most_bad: int) -> dict[int, str]:
    """Hash and message of every row of a failing batch that ``store`` fails on; all others are stored, piece by piece.

    The batch is written once more, dealt out to folders, so that a piece reads its part and not the batch. Parts do not depend on
    each other and are searched side by side, as many as there are cores: in a part that fails, the least hash that fails
    is found by halving, which stores all below it, and then the rest is tried.
    """
    spark = rows.sparkSession
    cores = max(2, min(32, spark.sparkContext.defaultParallelism))
    parts = min(MOST_PARTS, max(cores, n_rows // PART_ROWS))
    dealt = rows.withColumn("_part", F.pmod("_hash", F.lit(parts)).cast("int")).hint("rebalance", "_part")
    path = shared_folder(spark, "parts")
    dealt.write.partitionBy("_part").parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    bad: dict[int, str] = {}
    stopped = threading.Event()

    def search(part: int) -> None:
        def within(low: int, high: int) -> DataFrame:
            return dealt.filter((F.col("_part") == part) & F.col("_hash").between(low, high)).drop("_part")

        def attempt(low: int, high: int) -> Exception | None:
            return store(within(low, high), f"{part}_{low}_{high}")

        low, high = -(1 << 63), (1 << 63) - 1
        while low <= high and not stopped.is_set():
            error = attempt(low, high)
            if error is None:
                return
            # The least hash that fails lies from low to end, whose hashes are listed once they are few.
            end, begun, hashes = high, low, None
            while hashes is None or len(hashes) > 1:
                if hashes is None and (low == end or n_rows / parts * (end - low + 1) / 2**64 <= SMALL / 2):
                    found = sorted(r[0] for r in within(low, end).select("_hash").distinct().limit(SMALL + 1).collect())
                    if len(found) <= SMALL:
                        hashes = found
                        continue
                half = None if hashes is None else len(hashes) >> 1
                cut = (low + end) >> 1 if half is None else hashes[half - 1]
                failed = attempt(low, cut)
                if failed:
                    end, begun, error = cut, low, failed
                    hashes = hashes and hashes[:half]
                else:
                    low = cut + 1
                    hashes = hashes and hashes[half:]
            # What failed last may have held more than is left, or have failed for another reason.
            error = error if begun == low and hashes else attempt(low, end)
            if error and not hashes:
                raise error  # it fails without rows
            if error:
                bad[hashes[0]] = _message(error)
                if len(bad) > most_bad:
                    raise error
            low = end + 1

    with ThreadPoolExecutor(cores) as pool:
        # The properties of this thread's jobs, the query's group among them, are copied for each search.
        searches = [pool.submit(inheritable_thread_target(spark)(search), part) for part in range(parts)]
        try:
            for done in as_completed(searches):
                done.result()
        except Exception:
            stopped.set()
            pool.shutdown(wait=False, cancel_futures=True)
            raise
    drop_folder(spark, path)
    return bad


def to_isolated_table(
    stream: DataFrame,
    path: str,
    errors_path: str,
    checkpoint: str,
    fn: Callable[[DataFrame], DataFrame],
    attempts: int = 2,
    most_bad: int = 1000,
    **options,
) -> StreamingQuery:
    """Write ``fn`` of every micro-batch, without the rows it fails on: these go to an error table below ``errors_path``.

    A batch that fails ``attempts`` times is dealt out to parts by a hash of its rows, and a part that fails is halved until a failing piece
    holds one row (or copies of one). That takes about one small job for each halving and bad row, as many at a time as there
    are cores; the other rows are stored once each. ``fn`` must work row by row: on a piece it has to give what it gives on
    the whole. It is called by one thread at a time.

    More than ``most_bad`` different bad rows in a batch are taken for a fault of something else, and the query fails with the last
    error instead of emptying the batch into the error table. A repeated batch begins anew with its folders.
    """
    spark = stream.sparkSession
    folder, bad_folder = batch_folder(spark, path, checkpoint), batch_folder(spark, errors_path, checkpoint)
    calling = threading.Lock()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, out, bad_out = batch.sparkSession, folder(batch_id), bad_folder(batch_id)
        drop_folder(spark, out)
        rows = materialize(batch.withColumn("_hash", F.xxhash64(F.to_json(F.struct("*")))), "batch")

        def store(piece: DataFrame, name: str) -> Exception | None:
            try:
                with calling:
                    result = fn(piece.drop("_hash"))
                result.write.mode("overwrite").parquet(f"{out}/piece={name}")
                return None
            except Exception as error:  # noqa: BLE001  (whatever a row can raise in a job)
                drop_folder(spark, f"{out}/piece={name}")
                return error

        bad: dict[int, str] = {}
        for _ in range(attempts):
            error = store(rows, "all")
            if error is None:
                break
        else:
            n_rows = rows.count()
            if not n_rows:
                raise error  # it fails without rows
            bad = _isolate(rows, n_rows, store, most_bad)
        known = spark.createDataFrame([*bad.items()], "_hash long, error_message string")
        letters = rows.join(F.broadcast(known), "_hash").withColumn("error_type", F.lit("poison"))
        record = F.to_json(F.struct(*batch.columns))
        letters = error_rows(letters, record, F.lit("batch"))
        letters.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(bad_out)

    return for_each_batch(stream, write, checkpoint, **options)


def read_isolated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows stored by :func:`to_isolated_table`; its error table is read by :func:`read_batch_table`."""
    return spark.read.schema(plus(schema, query_id=TEXT, batch_id=LONG, piece=TEXT)).parquet(path).drop(QUERY, BATCH, "piece")
