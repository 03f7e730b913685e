"""One registered query for each operator: it applies the operator to the whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import binarypack, chat, egojoin, fingerprint, linededup, merkle, minhash, packing, pii, toxicity, unigram, warc, whitening
from shelfmark.llm.common import read_table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 2048 tokens."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer, 2048, keep_ids=False)


@query
def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles have a Jaccard similarity of 0.8 or more."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), k=2, percent=80)


@query
def op5_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a field fitted to labels outside the held-out fifth."""
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit_labelled(docs, read_table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "n_toxic", "spans")


@query
def op7_winnowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that stand earlier in the corpus."""
    kept = linededup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_cut", F.char_length("text").cast("long").alias("kept_chars"), "text")


@query
def op3_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: strict counts, their digest, and all spans."""
    found = pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    counts = [F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("found").alias("spans"))


@query
def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text, and their likeness to it and to the next document."""
    rows = fingerprint.edited(fingerprint.with_next(read_table(spark, sf_dir, "documents")))
    rows = fingerprint.add_sketch(rows, "edited", "edited_sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.as_text("sketch").alias("fingerprint"),
        fingerprint.as_text("edited_sketch").alias("edited_fingerprint"),
        fingerprint.likeness("text", "sketch", "edited", "edited_sketch").alias("near_edited"),
        fingerprint.likeness("text", "sketch", "next_text", "next_sketch").alias("near_next"),
    )


@query
def op4_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95 or more."""
    return egojoin.similar(read_table(spark, sf_dir, "embeddings"), 0.95)


@query
def op2_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written and read back."""
    path = warc.archive_folder(spark)
    warc.write(read_table(spark, sf_dir, "pages"), path, roll_bytes=4 << 20)
    return warc.read(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_schema_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings, formatted and read back."""
    rows = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    return chat.digests(chat.format_records(chat.records_of(rows.union(extra)))).withColumnRenamed("record_id", "conv_id")


@query
def op9_unigram_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of the text decoded from them."""
    model = unigram.Model.load(public_tokenizers.path("piece_bpe_32k.model"))
    rows = unigram.decode(unigram.encode(read_table(spark, sf_dir, "documents"), model), model)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.sha2("text", 256).alias("decoded_sha256"), "ids")


@query
def op11_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces of binary length, each a sequence of its own."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    packed = binarypack.pack(read_table(spark, sf_dir, "documents"), tokenizer, 2048)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op12_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all sound vectors on the sixteen leading components."""
    rows = whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=16)
    # Beyond the range of a long there is no value to give.
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@query
def op13_pointer_jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, verified after a change of case in a fifth of them."""
    docs = read_table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    proofs = merkle.manifest(docs, {"text": F.when(chosen, lower).otherwise(F.col("text"))})
    digest = F.sha2(merkle.siblings_text(), 256).alias("proof_sha256")
    return proofs.select("doc_id", "leaf", "subroot", "root", digest, "folded_root", "verified")
