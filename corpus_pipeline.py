"""Corpus pipeline: from documents to packed training sequences, each stage one operator of lectern.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm import dedup, jaccard, langid, packing, toxicity
from lectern.llm.common import table
from lectern.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.7 or more; learnt from the labels of those that come in.

    Without labels of both kinds nothing is toxic, and all stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.toxicity(docs, model).where("toxic_score < 0.7").select(docs.columns)


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that no language model accepts, and those without letters.

    Where no row names a language nothing can be learnt, and all stay."""
    model = langid.train(docs)
    return docs if model is None else langid.identify(docs, model).where("not lang_rejected").select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of word 5-shingles, the one with the smallest id.

    Rows of one id are one document and stay together; rows with a null id cannot be told apart, so they stay."""
    found = jaccard.jaccard_components(docs, k=5, percent=80)
    return docs.join(found.where("component_id < doc_id").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte strings that also start in a document with a smaller id.

    A character that loses a byte is left out; a document may end up empty and stays."""
    kept = dedup.remove_repeats(docs, keep=True, carry=tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars")))
    return kept.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_languages),
    ("ngram_jaccard", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

ORACLE_SQL = None  # SQL expresses none of the learnt stages; tests hold the pipeline against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: its five columns are read, others are left out; without rows there are none."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
