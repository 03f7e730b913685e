"""Epsilon grid order join against all pairs."""

import math

import numpy as np

from shelfmark.llm import egojoin


def brute(rows, least):
    ids = [r[0] for r in rows]
    size = max((len(v) for _, v in rows if v is not None), default=0)

    def sound(i, v):
        return i is not None and v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [k for k, (i, v) in enumerate(rows) if sound(i, v)]
    u = egojoin.unit(np.array([rows[k][1] for k in good], float)) if good else np.zeros((0, 1))
    near = u @ u.T >= least
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    n = dict.fromkeys(range(len(rows)), 0)
    for p, k in enumerate(good):
        n[k] = int(near[p].sum()) - 1
        for q in np.flatnonzero(near[p]):
            a, b = sorted((root(ids[k]), root(ids[good[q]])))
            up[b] = a
    return sorted(((i, n[k], None if i is None else root(i), i is None or root(i) == i) for k, (i, _) in enumerate(rows)), key=repr)


def vectors():
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(30, 12)) * np.linspace(3, 0.5, 12)
    rows = []
    for i in range(1500):
        v = centers[rng.integers(30)] + rng.normal(size=12) * rng.choice([0.05, 0.3, 1.0])
        rows.append((3 * i, [float(np.float32(x)) for x in v]))
    rows += [(100_000 + i, rows[5][1]) for i in range(400)]  # copies
    rows += [(1, [0.0] * 12), (2, None), (4, [float("nan")] * 12), (5, [1.0, None] * 6), (7, [1.0] * 5), (8, []), (10, [float("inf")] * 12)]
    rows += [(None, rows[5][1]), (11, [x * 1e-200 for x in rows[7][1]]), (13, [x * 1e200 for x in rows[7][1]]), (14, [-0.0, 1.0] * 6), (16, [0.0, 1.0] * 6)]
    return rows


def test_equal_to_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(egojoin, "BLOCK", 64)
    monkeypatch.setattr(egojoin, "INNER", 16)
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n int, links int")
    got = sorted((tuple(r) for r in egojoin.similar(df).collect()), key=repr)
    assert got == brute(rows, 0.95)


def test_pruning_is_sound_and_prunes(spark):
    boxes = [(i, [float(i)], [i + 0.5]) for i in range(100)]
    df = spark.createDataFrame(boxes, "at long, lo array<double>, hi array<double>")
    got = {tuple(r) for r in egojoin.near_blocks(df, 100, 1, 0.6).collect()}
    assert got == {(a, b) for a in range(100) for b in (a, a + 1) if b < 100}


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert egojoin.similar(df).collect() == []
    df = spark.createDataFrame([(1, [0.0]), (2, None)], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, egojoin.similar(df).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_each_length_is_joined(spark, monkeypatch):
    monkeypatch.setattr(egojoin, "BLOCK", 64)
    monkeypatch.setattr(egojoin, "INNER", 16)
    rows = [r for r in vectors() if r[1] is not None and len(r[1]) == 12]
    short = [(200_000 + i, v[:7]) for i, v in rows[:700] if i is not None]
    stray = [(300_000, [1.0] * 20), (300_001, [1.0] * 30 + [float("nan")]), (300_002, [0.0] * 40), (300_003, [2.0])]
    alone = [(i, 0, i, True) for i, _ in stray]
    for sample_rows in (10_000, 1):  # 1: only one length has leading dimensions
        df = spark.createDataFrame([*rows, *short, *stray], "vec_id long, embedding array<double>")
        got = sorted((tuple(r) for r in egojoin.similar(df, sample_rows=sample_rows).collect()), key=repr)
        assert got == sorted(brute(rows, 0.95) + brute(short, 0.95) + alone, key=repr)
