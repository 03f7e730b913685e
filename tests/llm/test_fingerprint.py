"""Sketches against plain sets."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from shelfmark.llm import fingerprint as fp
from shelfmark.llm.queries import LLM_QUERIES


def test_next_and_edited(spark):
    texts = {i * 3 + (1000 if i > 40 else 0): "é" * (i % 3) + f" text number {i} " * (i % 7) for i in range(90)}
    rows = [(k, v, 9) for k, v in texts.items()] + [(-5, None, 1)]
    texts[-5] = ""
    df = spark.createDataFrame(rows, "doc_id long, text string, sketch int")
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    for size in (2000, 4, 1):
        got = {r.doc_id: r for r in fp.edited(fp.with_next(df, size)).collect()}
        assert set(got) == set(texts)
        for d, r in got.items():
            t, n = texts[d], len(texts[d])
            assert r.next_text == texts[after[d]] and r.n_chars == n
            assert r.edited == t[: n - n // 2] + texts[after[d]][: n // 2]


def test_ranges_divide_outlying_and_repeated_ids(spark):
    """Far ids, ids of the hash kind and one id on half of all rows: no range holds many times its share, and order is kept."""
    ids = [*range(500), -(1 << 63), (1 << 63) - 1, 1 << 62, *[77] * 500, None]
    rows = spark.createDataFrame([(d, f"text {i}") for i, d in enumerate(ids)], "doc_id long, text string").withColumn("_hash", F.xxhash64("text"))
    got = rows.withColumn("b", fp.range_of(rows, 40)).collect()
    sizes = Counter(r.b for r in got)
    assert max(sizes.values()) <= 4 * len(ids) / 40 and len(sizes) >= 30
    known = sorted((r.doc_id, r._hash, r.b) for r in got if r.doc_id is not None)
    assert [r[2] for r in known] == sorted(r[2] for r in known)
    assert [r.b for r in got if r.doc_id is None] == [-1]
    df = rows.select("doc_id", "text")
    order = sorted(((r.doc_id, r._hash, r.text) for r in got if r.doc_id is not None), reverse=True) + [(None, 0, got[-1].text)]
    after = {t: order[(i + 1) % len(order)][2] for i, (_, _, t) in enumerate(order)}
    assert {r.text: r.next_text for r in fp.with_next(df, 25).collect()} == after


def test_sketch(spark):
    words = [f"w{i}" for i in range(4000)]
    whole, part = " ".join(words), " ".join(words[:400])
    rows = [(1, whole), (2, part), (3, whole.upper()), (4, "one two"), (5, ""), (6, None), (7, " \t"), (8, "x " * 50_000)]
    df = fp.add_sketch(spark.createDataFrame(rows, "doc_id long, text string"), "text", "s")
    s = {r.doc_id: r.s for r in df.collect()}
    assert abs(len(s[1]) / 3996 - 1 / 8) < 0.02 and s[1] == s[3] == sorted(set(s[1]))
    assert set(s[2]) <= set(s[1])  # contained, however unequal
    assert len(s[4]) == 1 and s[5] == s[6] == s[7] == [] and len(s[8]) == 1
    pair = spark.createDataFrame([(s[1], s[2]), (s[5], s[5]), (s[5], s[1]), (s[4], s[1])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in pair.select(fp.containment("a", "b")).collect()] == [1.0, 1.0, 0.0, 0.0]
    # The sketch of a union is the union of sketches: hashes are kept or not for themselves.
    both = fp.add_sketch(spark.createDataFrame([(whole[: len(whole) // 2],)], "text string"), "text", "s").first().s
    assert set(both) - set(s[1]) <= {max(both), min(both)} or len(set(both) - set(s[1])) <= 1


def test_empty_table_and_repeats(spark):
    assert fp.with_next(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = fp.with_next(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.next_text) for r in got) == [(0, "a"), (1, "a"), (1, "b")]
    assert len(hashlib.sha256(b"").hexdigest()) == 64


def test_short_text_in_long_one(spark):
    words = [f"w{i}" for i in range(4000)]
    parts = [words[20 * i : 20 * i + n] for i in range(150) for n in (1, 3, 5, 6, 9, 15)]
    rows = [(" ".join(words), " ".join(p)) for p in parts]
    rows += [("a b c d e f g", "a b c d e x y"), ("a b c", "b c d"), ("a b", "c d"), ("a", ""), ("", ""), (None, "a"), ("a a a a a a a", "b a a a a a a")]
    df = fp.add_sketch(fp.add_sketch(spark.createDataFrame(rows, "x string, y string"), "x", "a"), "y", "b")
    got = df.select(fp.likeness("x", "a", "y", "b"), fp.likeness("y", "b", "x", "a"), F.size("b"), F.array_min("b")).collect()
    assert all(r[0] == r[1] for r in got) and [r[0] for r in got[: len(parts)]] == [1.0] * len(parts)
    bound = -(1 << 63) + (1 << 61) - 1
    assert sum(r[3] > bound for r in got[: len(parts)]) > 300  # most have nothing below the bound
    ends = [r[0] for r in got[len(parts) :]]
    assert ends[1:] == [0.0, 0.0, 0.0, 1.0, 0.0, 1.0] and (got[len(parts)][2] > 1 or ends[0] == 1 / 3)


def test_query_sees_short_documents(spark, tmp_path):
    words = [f"v{i}" for i in range(300)]
    rows = [t for i in range(40) for t in ((2 * i, " ".join(words)), (2 * i + 1, " ".join(words[5 * i : 5 * i + 6])))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.near_next for r in LLM_QUERIES["op6_scaled_sketch"](spark, str(tmp_path)).collect()}
    assert got == dict.fromkeys(range(80), 1.0)
