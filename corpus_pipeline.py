"""From raw documents to packed training sequences: five stages, each a written table for the next.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the last return the columns of ``documents``, with
``n_chars`` counting the text as it is then. Columns beside those of ``documents`` go through to the last stage but one, which drops them;
names that begin with an underscore are kept for the stages. An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import linededup, minhash, packing, pii, toxicity
from shelfmark.llm.common import materialize, read_table


def counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, ``n_chars`` counted anew."""
    n = F.char_length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in columns else None
    return docs.select(*(n.alias("n_chars") if c == "n_chars" else F.col(c) for c in columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field, fitted to the labels outside the held-out fifth, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit_labelled(docs, read_table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the runs of lines that stand earlier; one that holds nothing else stays with an empty text."""
    return counted(linededup.dedup_lines(docs), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by a Jaccard similarity of 0.8 over five words.

    Rows whose doc_id repeats or is null are documents of their own text; of equal ones a single row stays.
    """
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind."""
    return counted(pii.mask(pii.find(docs)), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, its token ids and its place in a sequence of at most 2048 tokens.

    Repeated rows and null doc_ids, which no stage but the one before takes out, are packed each for itself.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: The stages hold a trained field, MinHash components and a tokenizer, which SQL does not express; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage, applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
