"""Binary packing: contract columns against the tokenizer itself, buckets and batches."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import binarypack
from shelfmark.llm.queries import LLM_QUERIES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, capacity):
    """Every id of every text lies in one piece; lengths are the binary digits; no sequence has two pieces."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, at = ids_of(texts[doc]), 0
        for r in sorted(pieces, key=lambda r: r.start):
            own = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert (r.start, r.offset, r.doc_tokens) == (at, 0, len(ids))
            assert r.ids_crc32 == zlib.crc32(own)
            at += r.length
        assert at == len(ids)
        rest = len(ids) % capacity
        digits = [1 << b for b in range(20) if rest >> b & 1]
        assert Counter(r.length for r in pieces) == Counter(digits) + Counter({capacity: len(ids) // capacity})
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    check(LLM_QUERIES["op11_binary_packing"](spark, small).collect(), texts, 2048)


def test_odd_texts_and_real_ids(spark):
    texts = {1: None, 2: "", 3: "word", 4: "several words of text " * 5000, 5: "퟿ é 漢字 🙂 \x1c", 6: " \n"}
    docs = spark.createDataFrame([(k, v, 7) for k, v in texts.items()], "doc_id long, text string, start int")
    rows = binarypack.pack(docs, TOKENIZER, 64).collect()
    check(rows, texts, 64)
    whole = {doc: ids_of(text) for doc, text in texts.items()}
    for r in rows:
        assert r.ids == whole[r.doc_id][r.start : r.start + r.length]


def test_repeated_rows_null_id_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (1, "other")], "doc_id long, text string")
    rows = binarypack.pack(docs, TOKENIZER, 4).collect()
    assert sum(r.length for r in rows) == 3 * len(ids_of("a b c")) + len(ids_of("other"))
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert sum(r.length for r in rows if r.doc_id is None) == len(ids_of("a b c"))
    assert binarypack.pack(docs.where("false"), TOKENIZER, 4).collect() == []
    with pytest.raises(ValueError):
        binarypack.pack(docs, TOKENIZER, 48)


def test_batches_and_buckets(spark, small, tmp_path):
    packed = binarypack.pack(spark.read.parquet(f"{small}/documents.parquet").repartition(3), TOKENIZER, 256)
    tokens = defaultdict(list)
    for r in binarypack.batches(packed, 512).collect():
        tokens[r.length, r.task].append(r.batch)
    for (length, _), found in tokens.items():
        counts = Counter(found)
        assert sorted(counts) == list(range(len(counts)))
        assert all(n * length == 512 for b, n in counts.items() if b != max(counts))
        assert counts[max(counts)] * length <= 512
    path = f"{tmp_path}/buckets"
    binarypack.write_buckets(packed, path)
    bucket = binarypack.read_bucket(spark, path, 64)
    assert bucket.count() == packed.where("length = 64").count()
    assert bucket.where(F.size("ids") != 64).count() == 0
    assert "PartitionFilters: [isnotnull(length" in bucket._jdf.queryExecution().toString()
