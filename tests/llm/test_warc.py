"""Archives: exact round trip, revisits, determinism and commits."""

import base64
import hashlib
import random

import pytest

from shelfmark.llm import warc


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def table():
    rng = random.Random(1)
    bodies = ["", "x", "é\r\n\r\nWARC/1.1\r\n", "<p>" * 5000, None]
    rows = [(i, f"https://h/{i}", rng.choice(bodies) if rng.random() < 0.5 else f"<html>{i}{'a' * rng.randrange(3000)}") for i in range(300)]
    rows += [(1000 + i, None, "hot") for i in range(200)] + [(None, "https://n", "only without id"), (None, "u\r\nX: y", "hot")]
    return rows + [rows[7], (5, "https://again", "another body of page five")]


def test_round_trip(spark, tmp_path):
    rows = table()
    df = spark.createDataFrame([(*r, "s", 3) for r in rows], "page_id long, url string, html string, shard string, size int")
    path = (tmp_path / "a").as_uri()
    manifest = warc.write(df.repartition(7), path, shards=5, roll_bytes=4000).orderBy("name").collect()
    assert len(manifest) > 10 and sum(r.records for r in manifest) == len(rows)
    for r in manifest:
        raw = (tmp_path / "a" / r.name).read_bytes()
        assert hashlib.sha256(raw).hexdigest() == r.sha256 and len(raw) == r.bytes
    assert not (tmp_path / "a" / "_temporary").exists()
    got = warc.read(spark, path).collect()
    payload = [(p, (h or "").encode()) for p, _, h in rows]
    first = {}
    for p, b in payload:
        if p is not None:
            first[b] = min(p, first.get(b, p))
    expected = []
    for p, b in payload:
        again = p is not None and first[b] != p
        expected.append((p, len(b), digest(b), "revisit" if again else "response", first[b] if again else None, None if again else b))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got), key=repr) == sorted(expected, key=repr)
    # The same table in another order gives the same bytes.
    other = (tmp_path / "b").as_uri()
    again = warc.write(df.orderBy("html").repartition(3), other, shards=5, roll_bytes=4000).orderBy("name").collect()
    assert [(r.name, r.sha256) for r in again] == [(r.name, r.sha256) for r in manifest]


def test_small_payloads_are_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    warc.write(df, (tmp_path / "a").as_uri(), revisit_bytes=3)
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read(spark, (tmp_path / "a").as_uri(), payloads=False).collect())
    assert got == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_empty_table_and_repeated_commit(spark, tmp_path):
    path = (tmp_path / "a").as_uri()
    manifest = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert manifest.count() == 0 and warc.read(spark, path).count() == 0
    path = (tmp_path / "b").as_uri()
    report = warc.write(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), path)
    report = spark.createDataFrame(report.collect(), report.schema)
    assert warc.commit(report, path).count() == 1 and warc.read(spark, path).count() == 1


def test_a_lost_file_fails_the_commit(spark, tmp_path):
    (tmp_path / "shard-1.warc.gz").write_bytes(b"whole")
    (tmp_path / "shard-2.warc.gz").write_bytes(b"cut")
    rows = {"whole": ("shard-1.warc.gz", 5), "cut": ("shard-2.warc.gz", 5), "lost": ("shard-3.warc.gz", 5)}
    for case, (name, size) in rows.items():
        report = spark.createDataFrame([(0, 0, f"_temporary/x-{name}", name, 1, size, "")], warc.MANIFEST)
        if case == "whole":
            assert warc.commit(report, tmp_path.as_uri()).count() == 1
        else:
            with pytest.raises(Exception, match="is lost"):
                warc.commit(report, tmp_path.as_uri())
