"""Each registered query against its contract, worked out apart from the operators on the whole small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    return {r.doc_id: r.text or "" for r in rows}


def result(spark, small, name, key="doc_id"):
    return {r[key]: r for r in LLM_QUERIES[name](spark, small).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_query_is_known():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in sorted(LLM_QUERIES, key=lambda n: int(re.match(r"op(\d+)", n)[1]))] == list(range(1, 14))


def test_op1(spark, small, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = LLM_QUERIES["op1_best_fit_packing"](spark, small).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    assert set(pieces) == set(documents)
    for doc, own in pieces.items():
        ids = tokenizer.encode(documents[doc], add_special_tokens=False).ids + [0]
        total += len(ids)
        own.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in own] == [(i, 2048 * i) for i in range(-(-len(ids) // 2048))]
        for r in own:
            cut = ids[r.start : r.start + 2048]
            assert (r.length, r.ids_crc32) == (len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= 1.05 * -(-total // 2048) + 1


def test_op2(spark, small):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    first = {}
    for page in sorted(pages):
        first.setdefault(pages[page], page)
    got = result(spark, small, "op2_sharded_warc", "page_id")
    assert set(got) == set(pages)
    for page, raw in pages.items():
        r, to = got[page], first[raw]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), digest)
        assert (r.record_type, r.refers_to) == (("response", None) if to == page else ("revisit", to))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15),
}


def test_op3(spark, small, documents):
    got = result(spark, small, "op3_weak_pii")
    assert set(got) == set(documents)
    for doc, text in documents.items():
        spans = {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text) if ok(m[0])] for k, (p, ok) in BASE.items()}
        r, base = got[doc], ",".join(s for k in BASE for s in spans[k])
        assert [r[f"n_{k}"] for k in BASE] == [len(spans[k]) for k in BASE]
        assert r.base_sha256 == sha(base) and set(filter(None, base.split(","))) <= set(r.spans.split(","))


def components(nodes, links):
    least = {n: n for n in nodes}

    def top(n):
        while least[n] != n:
            n = least[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        least[b] = a
    return {n: top(n) for n in nodes}


def test_op4(spark, small):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    unit = np.array([v / np.linalg.norm(v) for _, v in rows])
    pairs = [(rows[i][0], rows[j][0]) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.95, 1)), strict=True)]
    links, found = Counter(x for p in pairs for x in p), components([i for i, _ in rows], pairs)
    got = result(spark, small, "op4_epsilon_grid_join", "vec_id")
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (links[i], c, i == c) for i, c in found.items()}


def test_op5(spark, small, documents):
    got = result(spark, small, "op5_crf_toxicity")
    assert set(got) == set(documents)
    for doc, r in got.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    by_text = defaultdict(set)
    for doc, text in documents.items():
        by_text[text].add(got[doc].score)
    assert all(len(s) == 1 for s in by_text.values())


def test_op7(spark, small, documents):
    """A line of five words or more stays at its first place in the corpus and nowhere else; no other line is touched."""
    got = result(spark, small, "op7_winnowed_lines")
    assert set(got) == set(documents)
    seen, cut = set(), 0
    for doc in sorted(documents):
        lines, kept = documents[doc].split("\n"), got[doc].text.split("\n") if got[doc].text else []
        at = 0
        for line in lines:
            if at < len(kept) and kept[at] == line and not (len(line.split()) >= 5 and line in seen):
                at += 1
            elif len(line.split()) >= 5:
                assert line in seen, (doc, line)
                cut += 1
            seen.add(line)
        assert got[doc].kept_chars == len(got[doc].text)
        assert not any(len(x.split()) >= 5 and x not in lines for x in kept)
    again = Counter(x for r in got.values() for x in (r.text or "").split("\n") if len(x.split()) >= 5)
    assert cut > 0 and max(again.values()) == 1


def test_op8(spark, small):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{small}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = result(spark, small, "op8_schema_chat", "conv_id")
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        rows.sort()
        loss, r = "".join(t for _, role, t in rows if role == "assistant"), got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(rows), sha("".join(f"{role}\n{t}\n" for _, role, t in rows)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars >= sum(len(t) for _, _, t in rows)


def test_op9(spark, small, documents):
    got = result(spark, small, "op9_unigram_viterbi")
    assert {d: r.decoded_sha256 for d, r in got.items()} == {d: sha(t) for d, t in documents.items()}
    assert all(r.n_ids == len(r.ids) for r in got.values())


def test_op10(spark, small, documents):
    sets = {}
    for doc, text in documents.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[doc] = {tuple(words[i : i + 2]) for i in range(len(words) - 1)} if len(words) > 1 else {tuple(words)} if words else set()
    ids = sorted(d for d in sets if sets[d])
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = components(list(sets), pairs)
    got = result(spark, small, "op10_circulant_minhash")
    assert pairs and {d: (r.n_shingles, r.component_id, r.kept) for d, r in got.items()} == {d: (len(sets[d]), c, d == c) for d, c in found.items()}
