"""Winnowed line dedup against a plain search for repeated runs."""

import random

from shelfmark.llm.linededup import around, dedup_lines, fingerprints, line_hashes


def brute(rows, w):
    """Same rule without joins: compare every fingerprint with the first place in corpus order that has it."""
    docs = sorted({(d is not None, d, t) for d, t in rows if t}, key=lambda r: (r[0], r[1] or 0, r[2]))
    first, cuts = {}, {}
    for key in docs:
        lines, words = line_hashes(key[2], w)
        for (at, n), _ in sorted(fingerprints(lines, words, w).items()):
            content = tuple(lines[at : at + n])
            here = (around(lines, words, at - 1, -1, w), around(lines, words, at + n, 1, w))
            if content not in first:
                first[content] = here
                continue
            more = []
            for own, other in zip(here, first[content], strict=True):
                i = 0
                while i < min(len(own), len(other)) and own[i] == other[i]:
                    i += 1
                more.append(i)
            cuts.setdefault(key, set()).update(range(at - more[0], at + n + more[1]))
    out = []
    for d, t in rows:
        drop, kept, n = cuts.get((d is not None, d, t), set()), [], 0
        for line in (t or "").split("\n"):
            if line.strip():
                n += 1
                if n - 1 in drop:
                    continue
            kept.append(line)
        left = "\n".join(kept)
        out.append((d, t if not drop else left if left.strip() else "", n, len(drop)))
    return sorted(out, key=repr)


def test_equal_to_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(30)]
    pool = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 3, 7, 60]))) for _ in range(40)]
    rows = []
    for i in range(150):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 8))]
        if rng.random() < 0.4:  # a run of short lines
            at = rng.randrange(30)
            lines += pool[at : at + 6]
        if rng.random() < 0.2:
            lines += ["", "   ", *lines]
        rows.append((i * 2, "\n".join(lines)))
    rows += [(1, None), (3, ""), (5, "\n\n"), (None, pool[0] + "\n" + pool[1]), (7, "x\n" * 2000), (9, "y " * 50_000)]
    rows += [rows[4], (rows[6][0], rows[8][1])]
    df = spark.createDataFrame([(t, d, "k", 1, 2) for d, t in rows], "text string, doc_id long, key string, pos int, n_cut int")
    got = dedup_lines(df)
    assert got.columns == ["text", "doc_id", "key", "pos", "n_lines", "n_cut"]
    # Ties between texts of one doc_id are broken by hash, so leave those to their own test.
    ids = [d for d, _ in rows]
    unique = {d for d in ids if ids.count(d) == 1}
    if len(unique) == len(ids):
        assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_cut").collect()), key=repr) == brute(rows, 5)
    plain = [r for r in rows if r[0] in unique]
    df = spark.createDataFrame(plain, "doc_id long, text string")
    got = dedup_lines(df).select("doc_id", "text", "n_lines", "n_cut")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(plain, 5)


def test_rows_and_ties(spark):
    long = " ".join(f"a{i}" for i in range(60))
    rows = [(1, f"own line of the first one\n{long}\nend"), (2, f"{long}\nend"), (2, f"{long}\nend"), (3, f"yes\n{long}\nend\nnew words that nobody else has")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_cut) for r in dedup_lines(df).collect())
    assert got == [(1, rows[0][1], 0), (2, "", 2), (2, "", 2), (3, "yes\nnew words that nobody else has", 2)]


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
