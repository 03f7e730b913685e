"""The change log of a stream: every version that arrives is compared with the one before, across batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.changes import CHANGE_COLUMNS, diff_versions
from shelfmark.operators.versions import latest
from shelfmark.schemas import TEXT, struct
from shelfmark.session import materialize
from shelfmark.sources.keyed import Keyed
from shelfmark.streaming.sinks import QUERY, batch_folder, for_each_batch, read_batch_table


def log_changes(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    state: str,
    keys: Sequence[str],
    version: str,
    fields: Sequence[str] | dict[str, Column],
    tiebreak: str | Sequence[str] = (),
    parts: int = 64,
    buckets: int = 16,
    **options,
) -> StreamingQuery:
    """Change rows of arriving versions, written per micro-batch below ``path``; read them with :func:`read_changes`.

    The last version of every key is kept in the keyed table ``state``. A batch reads the parts its keys fall into; that side of the
    join is bucketed and is not shuffled. Within a batch versions are ordered, and hot keys divided, as ``diff_versions`` does it.
    Rows that arrive after a newer version are logged as they arrive: the first of a batch is compared with the last of the
    batches before. For versions that arrive in order the log equals that of the whole table.

    A repeated batch starts from the versions before its first try and overwrites its rows, so it logs nothing twice.
    """
    spark = rows.sparkSession
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    texts = fields if isinstance(fields, dict) else {f: F.col(f) for f in fields}
    plain = [*keys, version, *ties]
    # Keys as one text that is never null: a key with a null column is a key like others.
    row_key = F.to_json(F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))))
    kept = struct(row_key=TEXT, **{c: rows.schema[c].dataType for c in plain}, fields=struct(**{n: TEXT for n in texts}))
    last = Keyed(state, kept, ("row_key",), parts, buckets).create(spark)
    folder = batch_folder(spark, path, checkpoint)
    names = list(texts)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark, out = batch.sparkSession, folder(batch_id)
        writer = out.removeprefix(f"{path}/{QUERY}=").partition("/")[0]
        gen = last.next_generation(spark, writer, batch_id)
        packed = F.struct(*(c.cast("string").alias(n) for n, c in texts.items())).alias("fields")
        narrow = materialize(batch.select(row_key.alias("row_key"), *plain, packed), "versions")
        newest = materialize(latest(narrow, ["row_key"], version, ties), "newest")
        touched = last.touched(newest)
        old = last.read(spark, before=gen, parts=touched)
        earlier = old.join(newest.select("row_key"), "row_key", "left_semi")
        changes = diff_versions(narrow, keys, version, {n: F.col(f"fields.`{n}`") for n in names}, ties, earlier=earlier)
        changes.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(out)
        if touched:
            last.replace(spark, last.merge_plan(old, newest, ("row_key",)), gen)

    return for_each_batch(rows, add, checkpoint, **options)


def read_changes(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], version: str, tiebreak: str | Sequence[str] = ()) -> DataFrame:
    """The change rows written by :func:`log_changes` for the stream ``rows``."""
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    plain = {c: rows.schema[c].dataType for c in (*keys, version, *ties)}
    return read_batch_table(spark, path, struct(**plain, **{c: TEXT for c in CHANGE_COLUMNS}))
