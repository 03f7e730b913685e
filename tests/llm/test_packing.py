"""Packing against the tokenizer, against the rules of a valid packing, and against plain best fit."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def spread(placed, histogram):
    """Sequences as lists of (offset, length), from the placements."""
    out, n = defaultdict(list), len(placed["length"])
    for i in range(n):
        length, lo, copies, first, offset = (int(placed[k][i]) for k in ("length", "lo", "copies", "sequence", "offset"))
        hi = int(placed["lo"][i + 1]) if i + 1 < n and placed["length"][i + 1] == length else histogram[length]
        for r in range(hi - lo):
            out[first + r // copies].append((offset + r % copies * length, length))
    return out


@given(st.lists(st.integers(1, 60), max_size=300), st.integers(0, 3))
def test_plan_is_a_valid_packing(lengths, doubled):
    histogram = Counter(lengths * (1 + doubled))
    sequences = spread(packing.plan(dict(histogram), 60), histogram)
    assert Counter(n for s in sequences.values() for _, n in s) == histogram
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 60
        assert sum(3 * n > 60 for _, n in s) <= 2
    assert sorted(sequences) == list(range(len(sequences)))


def best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_plan_is_as_good_as_best_fit():
    rng = random.Random(6)
    for _ in range(30):
        lengths = [min(200, 1 + int(rng.expovariate(1 / rng.choice([10, 40, 90])))) for _ in range(rng.choice([5, 100, 600]))]
        n = len(spread(packing.plan(Counter(lengths), 200), Counter(lengths)))
        assert -(-sum(lengths) // 200) <= n <= best_fit(lengths, 200) + 1


def test_ids_equal_the_tokenizer():
    rng, plain = random.Random(7), Tokenizer.from_file(PATH)
    bits = ["Straße", "don't", "12", "<|endoftext|>", "\x1c", "\xa0", "é", "é", "ΣΑΣ", "日本", ",", " ", "\n", "word.", "'ll", "_", "²"]
    words = tokens.WordTokens(PATH, limit=20)
    for _ in range(1500):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert words.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_pack(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["ab", "Zebra", "x.", "été"]) for _ in range(rng.choice([0, 3, 40, 400])))) for i in range(200)]
    rows += [(500, None), (501, "word " * 5000), (None, "no id"), rows[3], rows[3]]
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, offset int, length string")
    got = packing.pack(df, PATH, 64).collect()
    plain = Tokenizer.from_file(PATH)
    expected = Counter()
    for d, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        for i in range(0, len(ids), 64):
            expected[d, i // 64, i, tuple(ids[i : i + 64])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in got) == expected
    assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    at = defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for s in at.values():
        end = 0
        for offset, n in sorted(s):
            assert offset == end
            end += n
        assert end <= 64
    assert packing.pack(df.limit(0), PATH, 64).collect() == []


def test_workers_give_memory_back_after_each_batch(monkeypatch):
    from shelfmark.llm import common

    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    assert list(common.lean(lambda batches: (b + 1 for b in batches))(iter([1, 2, 3]))) == [2, 3, 4]
    assert len(given) == 4
