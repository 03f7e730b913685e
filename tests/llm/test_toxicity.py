"""The field against enumeration of all labellings, and held-out accuracy."""

import itertools
import random
import zlib

import numpy as np

from pyspark.sql import functions as F

from shelfmark.llm import toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    moves = rng.normal(size=(2, 2))
    chains = [rng.normal(size=n) * 2 for n in (1, 2, 5, 7, 0, 3)]
    for chain, got in zip(chains, toxicity.marginals(chains, moves), strict=True):
        n, total, on = len(chain), 0.0, np.zeros(len(chain))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(c for c, v in zip(chain, y, strict=True) if v) + sum(moves[a, b] for a, b in itertools.pairwise(y)))
            total += w
            on += w * np.array(y)
        assert np.allclose(got, on / total)


def test_groups_of_long_and_short_chains(monkeypatch):
    rng = np.random.default_rng(4)
    chains = [rng.normal(size=n) for n in (0, 400, 3, 1, 90, 3, 0, 12)]
    moves = rng.normal(size=(2, 2))
    whole = toxicity.marginals(chains, moves)
    monkeypatch.setattr(toxicity, "CELLS", 100)
    assert all(np.allclose(a, b) for a, b in zip(whole, toxicity.marginals(chains, moves), strict=True))


def corpus(n=900):
    rng = random.Random(5)
    words = [f"wort{i}" if i % 2 else f"{chr(97 + i % 26)}o{i}" for i in range(300)]
    clean = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in words]
    docs, labels = [], []
    for i in range(n):
        t = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            t[rng.randrange(len(t))] = rng.choice(["Scumbag", "idiot,", "kretin" + rng.choice(["o", "en", "s", "ig", "um"])])
        docs.append((i, " ".join(t)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_spans(spark):
    docs, labels = corpus()
    truth = dict(labels)
    more = [(5000, None), (5001, ""), (None, "an idiot"), docs[4], (5002, "a idiot scumbag b " + "c " * 30_000)]
    df = spark.createDataFrame([(d, t, "score", 1) for d, t in docs + more], "doc_id long, text string, spans string, y int")
    marks = spark.createDataFrame([*labels, (None, 1), (9999, 1), labels[0]], "doc_id long, toxic int")
    model = toxicity.fit_labelled(df, marks, per_class=150)
    rows = toxicity.score(df, model).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) + len(more) and all(0 <= r.score <= 1 for r in rows)
    held = [d for d, _ in docs if zlib.crc32(str(d).encode()) % 5 == 0]
    assert np.mean([(got[d].score >= 0.5) == truth[d] for d in held]) > 0.97
    assert got[5000].score == got[5001].score < 0.5 and got[5000].spans == ""
    assert got[5002].spans == "2:15" and got[5002].n_toxic == 2 and got[None].score >= 0.5
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.score < 0.5}


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(df, toxicity.fit_labelled(df, none)).first().score < 0.5
    assert toxicity.score(df.limit(0), toxicity.Field()).collect() == []


def test_the_sample_is_bounded_by_rows(spark):
    """An id on many rows gives one of them, the same in every order of the rows."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(i, "other") for i in range(2, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels, "toxic", 10).collect()
    assert len(rows) <= 30
    again = toxicity.training_rows(docs.orderBy(F.rand(3)), labels, "toxic", 10).collect()
    assert sorted(rows) == sorted(again)
    assert toxicity.training_rows(docs.where("doc_id = 1"), labels, "toxic", 10).count() == 1
