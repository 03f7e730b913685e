"""Deterministic sharded WARC archives of pages: writing, committing and reading back.

Shards are ranges of page_id whose bounds come from a fixed hash sample of the ids weighted by payload size, so the same table gives
the same shards on any cluster. Records are sorted inside a shard and streamed into gzip members, one for each record; a file is closed
when its compressed size reaches ``roll_bytes``. Headers, digests and dates are made anew from the row.

A task writes under a temporary name of its own attempt and reports its files; the report is a Spark table, so a repeated or
speculative attempt counts once. Only files in the report are then renamed into place, and the manifest is written last: an archive
without a manifest is not there. Equal payloads (of at least ``revisit_bytes``) have one response, that of the smallest page_id; the
others are revisit records that refer to it and hold no payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import first_of_group, materialize, shared_folder, ship, slots
from shelfmark.session import drop_folder

ship(__name__)

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SAMPLE = 20_000
MANIFEST = "shard long, part int, temporary string, name string, records long, bytes long, sha256 string"
PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that every task can reach; a plain path is a shared mount."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    return fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None, copy: int) -> str:
    """Name of a page's record; rows that repeat a page_id are counted."""
    return f"<urn:page:{'' if page_id is None else page_id}{f':{copy}' if copy else ''}>"


def header_safe(value: str | None) -> str:
    return " ".join((value or "").split())


def record(page_id: int | None, copy: int, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """Bytes of a response or, with ``refers_to``, a revisit record, and the payload's digest."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, copy)}"]
    head += [f"WARC-Date: {DATE}", f"WARC-Target-URI: {header_safe(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    head += [f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, 0)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def bounds_of(keys: DataFrame, shards: int | None, shard_bytes: int) -> list[int]:
    """First page_id of every shard but the first, at equal payload sizes of a hash sample of about SAMPLE ids.

    Without ``shards`` there is one for every ``shard_bytes`` of payload, SAMPLE at most.
    """
    n, size = keys.agg(F.count("*"), F.sum("size")).first()
    shards = shards or min(SAMPLE, (size or 0) // shard_bytes + 1)
    every = max(1, n // SAMPLE)
    picked = keys.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0))
    sample = sorted((r[0], r[1]) for r in picked.groupBy("page_id").agg(F.sum("size")).collect())
    if not sample:
        return []
    total = np.cumsum([s + 500 for _, s in sample])
    at = np.searchsorted(total, total[-1] * np.arange(1, shards) / shards)
    return sorted({sample[min(int(i), len(sample) - 1)][0] for i in at})


def write(
    pages: DataFrame, path: str, shards: int | None = None, shard_bytes: int = 16 << 20, roll_bytes: int = 256 << 20, revisit_bytes: int = 0
) -> DataFrame:
    """Write one record for each row of ``pages`` (page_id, url, html; null html: empty) below ``path``; return the manifest.

    Other columns are ignored. Null page_ids sort first; a null id never gets revisits pointing to it unless all rows of its payload
    lack one. Rows that repeat a page_id each get a record. An empty table gives an empty manifest.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    keys = materialize(rows.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size")), "digests")
    bounds = np.array(bounds_of(keys, shards, shard_bytes), np.int64)
    here = F.struct(F.coalesce("page_id", F.lit((1 << 63) - 1)).alias("page_id"))
    large = keys.where(F.col("size") >= revisit_bytes).select("digest", here.alias("here"))
    again = first_of_group(large, "digest", "here").where("size > 1").select(F.col("here.page_id").alias("page_id"), "digest", F.col("first.page_id").alias("refers_to"))
    again = again.where(f"page_id < {(1 << 63) - 1} AND page_id <> refers_to").distinct()

    def shard_of(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, ids.fill_null(np.iinfo(np.int64).min).to_numpy(), "right").astype(np.int64))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([shard_of(b.column(0)), *b.columns], ["shard", *b.schema.names])

    # What to refer to travels as narrow rows sorted before the records of their shard's page: payloads are shuffled once.
    empty = [F.lit(None).cast(t) for t in ("string", "binary")]
    notes = again.select("page_id", *empty, "digest", "refers_to", F.lit(0).alias("kind"))
    full = rows.select("page_id", "url", "payload", F.sha1("payload").alias("digest"), F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind"))
    names = ["page_id", "url", "payload", "digest", "refers_to", "kind"]
    every = notes.toDF(*names).union(full)
    placed = every.mapInArrow(locate, "shard long, page_id long, url string, payload binary, digest string, refers_to long, kind int")
    dealt = placed.repartition("shard").sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
    schema = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, folder = store(path)
        attempt = uuid.uuid4().hex
        state: dict = {"shard": None, "part": 0, "file": None, "last": None, "copy": 0, "note": None}

        def close() -> list[tuple]:
            if state["file"] is None:
                return []
            state["file"].close()
            done = (state["shard"], state["part"], state["temporary"], state["name"], state["records"], state["bytes"], state["sha"].hexdigest())
            state.update(file=None, part=state["part"] + 1)
            return [done]

        def put(raw: bytes) -> None:
            buffer = io.BytesIO()
            with gzip.GzipFile(fileobj=buffer, mode="wb", filename="", mtime=0, compresslevel=6) as z:
                z.write(raw)
            packed = buffer.getvalue()
            state["file"].write(packed)
            state["sha"].update(packed)
            state["bytes"] += len(packed)
            state["records"] += 1

        def open_next() -> None:
            name = f"shard-{state['shard']:06d}-{state['part']:05d}.warc.gz"
            temporary = f"_temporary/{attempt}-{name}"
            disk.create_dir(f"{folder}/_temporary", recursive=True)
            state.update(name=name, temporary=temporary, file=disk.open_output_stream(f"{folder}/{temporary}", compression=None), records=0, bytes=0, sha=hashlib.sha256())

        for batch in batches:
            files: list[tuple] = []
            for i in range(batch.num_rows):
                shard, page_id, url, payload, digest, refers_to, kind = (c[i].as_py() for c in batch.columns)
                if kind == 0:
                    state["note"] = (page_id, digest, refers_to)
                    continue
                if shard != state["shard"]:
                    files += close()
                    state.update(shard=shard, part=0, last=None, copy=0)
                if state["file"] is None:
                    open_next()
                state["copy"] = state["copy"] + 1 if state["last"] == (page_id,) else 0
                state["last"] = (page_id,)
                note = state["note"]
                target = note[2] if note and note[:2] == (page_id, digest) else None
                put(record(page_id, state["copy"], url, payload, target)[0])
                if state["bytes"] >= roll_bytes:
                    files += close()
            if files:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*files, strict=True), schema, strict=True)], schema=schema)
        if files := close():
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*files, strict=True), schema, strict=True)], schema=schema)

    report = materialize(dealt.mapInArrow(save, MANIFEST), "report")
    return commit(report, path)


def commit(report: DataFrame, path: str) -> DataFrame:
    """Rename the reported files into place, then write the manifest; both can be repeated.

    A file that is neither where it was written nor, with the reported size, in its place fails the commit before there is a manifest.
    Files of failed and repeated attempts go with the temporary folder in the end.
    """

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, folder = store(path)
        for batch in batches:
            for temporary, name, size in zip(*(batch.column(c).to_pylist() for c in ("temporary", "name", "bytes")), strict=True):
                if disk.get_file_info(f"{folder}/{temporary}").type != fs.FileType.NotFound:
                    disk.move(f"{folder}/{temporary}", f"{folder}/{name}")
                found = disk.get_file_info(f"{folder}/{name}")
                if found.type != fs.FileType.File or found.size != size:
                    raise OSError(f"{name}: the reported file of {size} bytes is lost")
            yield batch

    report.mapInArrow(move, MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    drop_folder(report.sparkSession, f"{path}/_temporary")
    return report.sparkSession.read.parquet(f"{path}/manifest")


def parse(stream: Iterator[bytes] | io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        assert line.startswith(b"WARC/1."), "not a WARC record"
        head = {}
        while (line := stream.readline().strip()) != b"":
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        yield head, stream.read(int(head["content-length"]))


def page_of(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">").partition(":")[0]
    return int(value) if value else None


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row for each record of a committed archive: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload.

    Digests are checked; a revisit's payload is null and its size is that of the HTTP header. Tasks stream one file at a time.
    """
    manifest = spark.read.parquet(f"{path}/manifest").select("name")
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
    schema = pa.schema(fields if payloads else fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, folder = store(path)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=False)], schema=schema)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with disk.open_input_stream(f"{folder}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as plain:
                    for head, block in parse(plain):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.lower().rpartition(b"content-length:")[2].split()[0])
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        whole = head["warc-type"] == "response"
                        if whole and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"{name}: a payload does not match its digest")
                        rows.append((page_of(head["warc-record-id"]), size, digest, head["warc-type"], page_of(head.get("warc-refers-to")), head["warc-target-uri"], payload if whole and payloads else None))
                        held += len(payload) if payloads else 100
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = manifest.repartition(max(1, slots(spark)), "name")
    return files.mapInArrow(run, PAGE if payloads else PAGE.removesuffix(", payload binary"))


def archive_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "warc")
