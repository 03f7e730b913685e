"""Manifest against a tree built level by level in Python."""

import hashlib
import zlib

from pyspark.sql import functions as F

from shelfmark.llm import merkle
from shelfmark.llm.queries import LLM_QUERIES

DDL = "doc_id long, text string, lang string, source string, n_chars long, up int, run string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text=None):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"] if text is None else text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root and, for each node, the siblings (left, right) of every level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for w, i in zip(ways, at, strict=True):
            own, k = runs[i // 16], i % 16
            w.append(("".join(own[:k]), "".join(own[k + 1 :])))
        nodes, at = [h(*r) for r in runs], [i // 16 for i in at]
    return nodes[0], ways


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    parts = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        parts[s] = (own, *tree([leaf(r) for r in own]))
    root, above = tree([parts[s][1] for s in order])
    out = []
    for s, high in zip(order, above, strict=True):
        own, subroot, ways = parts[s]
        for r, low in zip(own, ways, strict=True):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            at = leaf(r, text)
            for a, b in low + high:
                at = h(a, at, b)
            proof = h(*(x for step in low + high for x in step))
            out.append((r["doc_id"], leaf(r), subroot, root, proof, at, at == root))
    return sorted(out, key=repr)


def run_query(spark, docs, path):
    docs.write.parquet(f"{path}/documents.parquet")
    found = LLM_QUERIES["op13_pointer_jumping"](spark, str(path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_query(spark, small):
    found = LLM_QUERIES["op13_pointer_jumping"](spark, small)
    rows = [r.asDict() for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    expected = brute(rows)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert {r[-1] for r in expected} == {True, False}


def test_uneven_sources(spark, tmp_path):
    """One source of five levels, lone leaves, a null and an empty source, nulls everywhere, repeated rows, clashing columns."""
    rows = [(i, f"Text {i}", "en", "big", i, 1, "x") for i in range(1500)]
    rows += [(i, None if i % 7 == 0 else "A" * i, None, f"s{i % 40:02}", None, 1, "x") for i in range(300)]
    rows += [(3, "Lone É", "en", "lone", 1, 1, "x"), (4, "n", "fr", None, 1, 1, "x"), (None, None, None, None, None, 1, "x"), (5, "e", "fr", "", 1, 1, "x")]
    rows += [(9, "Again", "en", "rep", 5, 1, "x")] * 40 + [(9, "Other", "en", "rep", 5, 1, "x")]
    docs = spark.createDataFrame(rows, DDL)
    assert run_query(spark, docs, tmp_path) == brute([r.asDict() for r in docs.collect()])


def test_many_sources(spark, tmp_path):
    docs = spark.createDataFrame([(i, "X y", "en", f"s{i % 400}", 3, 1, "x") for i in range(1300)], DDL)
    assert run_query(spark, docs, tmp_path) == brute([r.asDict() for r in docs.collect()])


def test_one_leaf_and_none(spark, tmp_path):
    docs = spark.createDataFrame([(7, "Only", "en", "s", 4, 1, "x")], DDL)
    (row,) = run_query(spark, docs, tmp_path / "one")
    assert row == brute([docs.first().asDict()])[0]
    assert row[1] == row[2] == row[3] and row[4] == h()
    assert run_query(spark, docs.where("false"), tmp_path / "none") == []


def test_salted_jump(spark, monkeypatch):
    """Distances beyond three steps meet under salts; runs of two make a deep tree of few leaves."""
    monkeypatch.setattr(merkle, "RUN", 2)
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", 1, 1, "x") for i in range(700)], DDL)
    found = merkle.manifest(docs)
    assert found.where(~F.col("verified")).count() == 0
    sizes = {r[0] for r in found.select(F.size("proof")).collect()}
    assert found.count() == 700 and sizes == {10}
