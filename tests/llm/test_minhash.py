"""Circulant MinHash and components against brute force."""

import itertools
import random
import re

import numpy as np

from shelfmark.llm.components import connected_components
from shelfmark.llm import minhash
from shelfmark.llm.minhash import near_duplicates


def brute(rows, k, percent):
    def lower(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = {d: d for d, _ in rows if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, (a, _)), (j, (b, _)) in itertools.combinations(enumerate(rows), 2):
        if a is None or b is None or not sets[i] or not sets[j]:
            continue
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * len(sets[i] | sets[j]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return sorted([(d, len(s), None if d is None else root(d), d is None or root(d) == d) for (d, _), s in zip(rows, sets, strict=True)], key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], []
    for _ in range(12):
        base.append([rng.choice(words) for _ in range(rng.choice([3, 40, 120]))])
    for _ in range(160):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 3, 12])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((len(rows) * 3, " ".join(t)))
    # a large family around one text, whose members are further from each other than from it
    heart = [rng.choice(words) for _ in range(100)]
    for _ in range(60):
        t = list(heart)
        for i in rng.sample(range(100), 4):
            t[i] = rng.choice(words)
        rows.append((len(rows) * 3, "\t".join(t).upper()))
    rows += [(7, ""), (8, None), (10, " \t\n"), (11, "one"), (13, "ONE"), (14, "one two"), (None, "one"), (None, None)]
    rows += [(11, "one"), (11, " ".join(heart)), (0, rows[0][1])]
    rows += [(16, "x " * 30_000)]
    return rows


def test_equal_to_brute_force(spark):
    rows = corpus(3)
    for k in (2, 5):
        df = spark.createDataFrame([(d, t, "q", 1) for d, t in rows], "doc_id long, text string, key string, first int")
        got = sorted((tuple(r) for r in near_duplicates(df, k=k).collect()), key=repr)
        assert got == brute(rows, k, 80)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).collect() == []


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loose = [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(200)]
    edges = [*chain, *star, *loose, (9, 9), (3, 2), (None, 4)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, root(x)) for x in up if root(x) != x}


def test_dropping_rows_of_repeated_and_null_ids(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(7))
    base, other, third = ([word() for _ in range(60)] for _ in range(3))
    near = [*base[:30], "changed", *base[31:]]
    join = " ".join
    rows = [
        (1, join(base)), (5, join(near)), (5, join(other)),  # one row of id 5 is a near copy, the other is not
        (7, join(third)), (7, join(third)), (None, join(third)), (None, "alone"), (None, "alone"), (8, ""), (8, ""), (9, None),
    ]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, kept int")
    got = minhash.drop_near_duplicates(docs.repartition(3))
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(1, join(base)), (5, join(other)), (7, join(third)), (None, "alone"), (8, ""), (9, None)], key=repr
    )
    plain = docs.where("doc_id IN (1, 9)").union(spark.createDataFrame([(5, join(near), 0)], docs.schema))
    assert sorted(r.doc_id for r in minhash.drop_near_duplicates(plain).collect()) == [1, 9]
    assert minhash.drop_near_duplicates(docs.limit(0)).collect() == []


def test_small_groups_of_a_bucket(spark, monkeypatch):
    """Buckets of several components, dealt to many groups of a few documents, give what brute force gives."""
    monkeypatch.setattr(minhash, "OUTSIDE", 20)
    monkeypatch.setattr(minhash, "INSIDE", 40)
    rows = corpus(8)[100:]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    # Bands of one coordinate put unlike documents into one bucket.
    got = sorted((tuple(r) for r in near_duplicates(df, k=2, bands=8, rows=1).collect()), key=repr)
    assert got == brute(rows, 2, 80)


def test_recall_of_bands():
    """Pairs at a Jaccard similarity of exactly 0.8 that share a band: coordinates under shifts miss no more than independent ones would by much."""
    rng = np.random.default_rng(2)
    sign = minhash.Circulant(minhash.BANDS * minhash.ROWS)
    for both in (8, 40, 240):
        missed, pairs = 0, 4000
        for _ in range(pairs):
            own = rng.integers(0, 1 << 64, both + both // 4, dtype=np.uint64)
            a, b = own[: both + both // 8], np.concatenate([own[:both], own[both + both // 8 :]])
            keys = [minhash.band_keys(sign(x), minhash.BANDS) for x in (a, b)]
            missed += not (keys[0] == keys[1]).any()
        assert missed <= 0.005 * pairs
