"""Tables that hold one row per key, merged on write.

A keyed table is a catalogue table of Parquet files, partitioned by ``part`` (a hash of the key) and ``gen``, and bucketed by the
key. A merge reads and rewrites only the parts its keys fall into. The stored side of its join is bucketed as the join needs
it, so it is not shuffled; the batch is, after it was reduced to one row per key.

Every rewritten part is a new generation beside the old one, and a reader takes the newest generation of each part. A merge
that is repeated, as a streaming batch may be, reads what lay there before its own generation and overwrites only that, so it
stores the same. Generations that nothing reads any more are dropped by the next merge. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.versions import latest
from shelfmark.schemas import fill_defaults
from shelfmark.session import materialize

PART, GEN = "part", "gen"
_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Keyed:
    """A keyed table: name in the catalogue, columns, key.

    ``parts`` is the grain of rewriting and pruning, ``buckets`` that of the join. Neither can be changed later.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    parts: int = 64
    buckets: int = 16

    def create(self, spark: SparkSession) -> Keyed:
        """Create the table unless it is there. Its files lie in the warehouse."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {PART} INT, {GEN} BIGINT) USING parquet "
            f"PARTITIONED BY ({PART}, {GEN}) CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS"
        )
        return self

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def generations(self, spark: SparkSession) -> dict[int, list[int]]:
        """Generations of every part, ascending; at most a few for each part."""
        found: dict[int, list[int]] = {}
        for row in spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            part, gen = (int(x.partition("=")[2]) for x in row[0].split("/"))
            found.setdefault(part, []).append(gen)
        return {p: sorted(g) for p, g in found.items()}

    def next_generation(self, spark: SparkSession, writer: str = "", batch: int | None = None) -> int:
        """A number above all generations; for a batch that its writer has asked for before, the same as then."""
        known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        asked = {k.removeprefix("writer."): v.split(":") for k, v in known.items() if k.startswith("writer.")}
        if batch is not None and writer in asked and int(asked[writer][0]) == batch:
            return int(asked[writer][1])
        taken = [g for gens in self.generations(spark).values() for g in gens] + [int(v[1]) for v in asked.values()]
        gen = max(taken, default=0) + 1
        if batch is not None:
            spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('writer.{writer}' = '{batch}:{gen}')")
        return gen

    def read(self, spark: SparkSession, before: int | None = None, parts: Sequence[int] | None = None) -> DataFrame:
        """Rows with their part: of all parts or the given ones, as they are now or were before a generation.

        The choice is a condition on partition columns alone: other parts and generations are not listed as files.
        """
        chosen: dict[int, list[int]] = {}
        for part, gens in self.generations(spark).items():
            old = [g for g in gens if before is None or g < before]
            if old and (parts is None or part in parts):
                chosen.setdefault(old[-1], []).append(part)
        wanted = F.lit(False)
        for gen, own in sorted(chosen.items()):
            wanted = wanted | ((F.col(GEN) == gen) & F.col(PART).isin(own))
        return spark.table(self.name).where(wanted).select(*self.schema.fieldNames(), PART)

    def touched(self, rows: DataFrame) -> list[int]:
        """The parts that the keys of ``rows`` fall into: at most ``parts`` numbers."""
        return sorted(r[0] for r in rows.select(self.part().alias(PART)).distinct().collect())

    def replace(self, spark: SparkSession, rows: DataFrame, gen: int) -> None:
        """Store ``rows`` (with their part), all of its parts' rows, as the generation ``gen``, and drop what it supersedes for good."""
        out = rows.select(*self.schema.fieldNames(), F.col(PART).cast("int"), F.lit(gen).cast("long").alias(GEN))
        mode = spark.conf.get(_MODE)
        spark.conf.set(_MODE, "dynamic")
        try:
            out.write.insertInto(self.name, overwrite=True)
        finally:
            spark.conf.set(_MODE, mode)
        for part, gens in self.generations(spark).items():
            # The newest one before ``gen`` stays: a repetition of this merge starts from it.
            for old in [g for g in gens if g < gen][:-1]:
                spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PART} = {part}, {GEN} = {old})")

    def merge_plan(self, stored: DataFrame, incoming: DataFrame, version: Sequence[str]) -> DataFrame:
        """One row per key of both; of equal versions the incoming one."""
        names = self.schema.fieldNames()
        old = stored.select(*(F.col(c).alias(f"_old_{c}") for c in (*names, PART)))
        same = [F.col(f"_old_{k}") == F.col(k) for k in self.keys]
        both = old.join(incoming.select(*names, self.part().alias(PART)), same, "full_outer")
        newer = F.col(f"_old_{PART}").isNull()
        ours, theirs = (F.struct(*(F.col(f"{p}{v}") for v in version)) for p in ("", "_old_"))
        newer = newer | (F.col(PART).isNotNull() & (ours >= theirs))
        return both.select(*(F.when(newer, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in (*names, PART)))

    def merge(
        self, rows: DataFrame, version: Sequence[str], writer: str = "", batch: int | None = None
    ) -> None:
        """Take in ``rows``: a key's row is replaced by one whose ``version`` columns are not smaller.

        Columns that are missing or null get their default, the key included. A streaming batch gives its query as ``writer`` and its
        number; repeated, it stores the same again.
        """
        spark = rows.sparkSession
        filled = fill_defaults(rows, self.schema)
        incoming = materialize(latest(filled, list(self.keys), version[0], list(version[1:])), "incoming")
        gen = self.next_generation(spark, writer, batch)
        touched = self.touched(incoming)
        if touched:
            stored = self.read(spark, before=gen, parts=touched)
            self.replace(spark, self.merge_plan(stored, incoming, version), gen)
