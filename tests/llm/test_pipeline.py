"""Stages on planted cases, and the whole pipeline on the small table."""

import random

import corpus_pipeline as cp


def columns(df):
    return df.columns


def test_stages_on_planted_rows(spark, tmp_path):
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passage = text(60)
    rows = [(i, text(80)) for i in range(120)]
    rows += [(200 + i, f"{text(30)}\n{passage}\n{text(30)}") for i in range(5)]  # a passage that repeats
    base = text(100).split()
    for i in range(4):
        near = list(base)
        near[10 * i] = "changed"
        rows.append((300 + i, " ".join(near)))
    rows += [(400, "write to jane.doe@mail.example.com " + text(20)), (401, text(20) + " idiot " + text(5)), (402, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    marks = [(d, 0) for d in range(100)] + [(401, 1)]
    more = [(1000 + i, text(10) + " idiot " + text(10), "en", "s", 1) for i in range(60)]
    spark.createDataFrame([*marks, *((1000 + i, 1) for i in range(60))], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = docs.union(spark.createDataFrame(more, docs.schema))

    now, seen = docs, {}
    for name, stage in cp.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
        seen[name] = {r.doc_id: r for r in out.collect()}
        now = out
    clean = set(range(120))
    assert 401 not in seen["toxicity"] and not {1000 + i for i in range(60)} & set(seen["toxicity"])
    assert clean <= set(seen["packing"]) and 402 in seen["packing"]
    lines = seen["line_dedup"]
    assert passage in lines[200].text and not any(passage in lines[200 + i].text for i in range(1, 5))
    assert {300} == {300, 301, 302, 303} & set(seen["near_dedup"])
    assert seen["pii"][400].text.startswith("write to [EMAIL] ") and seen["pii"][400].n_chars == len(seen["pii"][400].text)
    assert all(seen["pii"][d].text == t for d, t in rows if d in clean)


def test_run(spark, small):
    got = cp.run(spark, small)
    assert got.count() > 100 and {"doc_id", "sequence_id", "offset"} <= set(got.columns)
    assert cp.ORACLE_SQL is None and len(cp.STAGES) == 5
