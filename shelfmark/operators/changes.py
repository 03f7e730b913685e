"""Change log: what differs between consecutive versions or between two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import materialize

CHANGE_COLUMNS = ("change_type", "field_name", "old_value", "new_value")


def _texts(fields: Sequence[str] | dict[str, Column]) -> dict[str, Column]:
    columns = fields if isinstance(fields, dict) else {f: F.col(f) for f in fields}
    return {name: c.cast("string") for name, c in columns.items()}


def _change_rows(df: DataFrame, keep: Sequence[str], names: Sequence[str], kind: Column) -> DataFrame:
    """One row per field whose ``_old`` and ``_new`` text differ, NULL being a value of its own."""
    fields = F.array(
        *(
            F.struct(
                F.lit(n).alias("field_name"),
                F.col("_old").getField(n).alias("old_value"),
                F.col("_new").getField(n).alias("new_value"),
            )
            for n in names
        )
    )
    # The array is filtered before it is exploded: unchanged fields never become rows.
    changed = F.filter(
        fields,
        lambda f: (F.col("_kind") != "update") | ~f["old_value"].eqNullSafe(f["new_value"]),
    )
    return (
        df.withColumn("_kind", kind)
        .select(*keep, F.col("_kind").alias("change_type"), F.explode(changed).alias("_f"))
        .select(*keep, "change_type", "_f.field_name", "_f.old_value", "_f.new_value")
    )


def _hot_keys(df: DataFrame, keys: Sequence[str], share: float, at_least: int) -> DataFrame:
    """Keys holding more than ``share`` of all rows, and more than ``at_least`` rows.

    There can be at most ``1 / share`` of them, which makes the result safe to broadcast.
    """
    total = df.agg(F.count("*")).scalar()
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = counts.filter((F.col("_n") > F.lit(at_least)) & (F.col("_n") > total * F.lit(share)))
    return hot.select(*(F.col(k).alias(f"_hot_{k}") for k in keys))


def _in_pieces(rows: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int) -> DataFrame:
    """``rows`` with ``_piece``, NULL for the keys that stay whole, and ``_carried`` rows: the last one of each piece once more in the next.

    The rows of hot keys are cut into ranges of (key, order, content), so a key is divided even where most of its rows share one
    version. Rows equal in all of that are one row: a repetition changes nothing.
    """
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    hot = F.broadcast(hot)
    whole = rows.join(hot, same, "left_anti").withColumns({"_piece": F.lit(None).cast("int"), "_carried": F.lit(False)})
    cut = rows.join(hot, same, "left_semi").distinct()
    ranges = max(pieces, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = cut.repartitionByRange(ranges, *keys, *order, "_tie").withColumn("_piece", F.spark_partition_id())
    cut = materialize(cut, "pieces").withColumn("_carried", F.lit(False))
    names = [c for c in rows.columns if c not in keys]
    # One row per hot key and piece, combined before the shuffle.
    last = cut.groupBy(*keys, "_piece").agg(F.max_by(F.struct(*names), F.struct(*order, "_tie")).alias("_last"))
    following = Window.partitionBy(*keys).orderBy("_piece")
    carry = last.withColumn("_piece", F.lead("_piece").over(following)).filter(F.col("_piece").isNotNull())
    carry = carry.select(*keys, "_last.*", "_piece", F.lit(True).alias("_carried"))
    return whole.unionByName(cut).unionByName(carry)


def diff_versions(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    fields: Sequence[str] | dict[str, Column],
    tiebreak: str | Sequence[str] = (),
    pieces: int = 64,
    hot_share: float = 1e-5,
    hot_rows: int = 100_000,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Change rows of a version history: ``insert`` without a predecessor, else ``update``.

    An insert lists every field; an update only those that differ.  ``fields`` are names or
    ``{name: column}``; values are compared and stored as text.

    The history of a key is one sorted window, except for hot keys (see :func:`_hot_keys`):
    theirs is cut into ranges of its own versions, so a key with a third of all rows is worked
    on by many tasks, also when all of it is of one version.  The last row of each piece is
    carried into the key's next piece, where it is the first row's predecessor.

    ``earlier`` holds at most one row per key (keys, version, tiebreak, and the field texts as a struct
    ``fields``) that precedes all rows of the key here, whatever its version; it makes no rows itself.

    The narrow rows are written once to the shared folder, and so are those of hot keys where there
    are any.  ``pieces=1`` keeps every key whole and writes nothing.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    texts = _texts(fields)
    keys, order = list(keys), [version, *ties]
    rows = df.select(*keys, *order, F.struct(*(c.alias(n) for n, c in texts.items())).alias("_new"))
    rows = rows.withColumn("_tie", F.xxhash64("_new"))
    before = None
    if earlier is not None:
        before = earlier.select(*keys, *order, F.col("fields").alias("_new"), F.lit(0).cast("long").alias("_tie"), F.lit(True).alias("_carried"))
    piece: list[str] = []
    if pieces > 1:
        rows = materialize(rows, "versions")
        hot = materialize(_hot_keys(rows, keys, hot_share, hot_rows), "hot-keys")
        if not hot.isEmpty():
            piece = ["_piece"]
            rows = _in_pieces(rows, hot, keys, order, pieces)
            if before is not None:
                first = rows.filter("_piece IS NOT NULL").groupBy(*(F.col(k).alias(f"_hot_{k}") for k in keys)).agg(F.min("_piece").alias("_piece"))
                before = before.join(F.broadcast(first), [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys], "left").drop(*(f"_hot_{k}" for k in keys))
    if before is not None:
        if not piece:
            rows = rows.withColumn("_carried", F.lit(False))
        rows = rows.unionByName(before)

    carried = [F.col("_carried").desc()] if "_carried" in rows.columns else []
    w = Window.partitionBy(*keys, *piece).orderBy(*carried, *order, "_tie")
    compared = rows.withColumn("_old", F.lag("_new").over(w))
    if carried:
        compared = compared.filter(~F.col("_carried"))
    kind = F.when(F.col("_old").isNull(), F.lit("insert")).otherwise(F.lit("update"))
    return _change_rows(compared, [*keys, *order], list(texts), kind)


def diff_snapshots(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Change rows between two snapshots with unique keys: insert, update and ``delete``."""
    keys, texts = list(keys), _texts(fields)
    packed = F.struct(*(c.alias(n) for n, c in texts.items()))
    both = old.select(*keys, packed.alias("_old")).join(new.select(*keys, packed.alias("_new")), keys, "full_outer")
    kind = (
        F.when(F.col("_old").isNull(), F.lit("insert"))
        .when(F.col("_new").isNull(), F.lit("delete"))
        .otherwise(F.lit("update"))
    )
    return _change_rows(both, keys, list(texts), kind)


def as_change_log(changes: DataFrame, key: Column, timestamp: Column | None = None, source: str = "") -> DataFrame:
    """Shape change rows for the stored log; the time defaults to now."""
    return changes.select(
        key.cast("string").alias("listing_id"),
        (F.current_timestamp() if timestamp is None else timestamp.cast("timestamp")).alias("change_timestamp"),
        "change_type",
        "field_name",
        F.coalesce("old_value", F.lit("")).alias("old_value"),
        F.coalesce("new_value", F.lit("")).alias("new_value"),
        F.lit(source).alias("source"),
    )


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("field_name", "change_type").agg(F.count("*").alias("changes"))
