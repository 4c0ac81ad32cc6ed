"""The thin queries over whole tables: name -> (spark, sf_dir) -> DataFrame, and SQL where SQL expresses them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, chat, dedup, html, langid, packing, topk, toxicity, vptree
from .common import learnable, table
from .jaccard import jaccard_components


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.identify(learnable(docs.select("doc_id", "text"), "doc_id"), langid.train(docs))
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op3_bpe_encode_decode(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer("word_bpe_49k.json"))


def op4_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), every=50, k=5, scale=256)


def op5_suffix_array_dedup(spark, sf_dir):
    return dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), width=50)


def op6_html_extraction(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_vp_tree_neighbours(spark, sf_dir):
    return vptree.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), every=20, k=20)


def op8_preference_pairs(spark, sf_dir):
    """Conversations 2n and 2n + 1 are pair n, the even one chosen."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat.preference_pairs(turns, pair=F.floor(F.col("conv_id") / 2).cast("long"), chosen=F.pmod("conv_id", F.lit(2)) == 0)


def op9_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, percent=90)


def op10_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.toxicity(learnable(docs, "doc_id"), toxicity.train(docs, labels))
    return scored.select("doc_id", "held_out", F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.7).cast("int").alias("predicted"), F.col("toxic_evidence").alias("evidence"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_language_id": op2_language_id,
    "op3_bpe_encode_decode": op3_bpe_encode_decode,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_vp_tree_neighbours": op7_vp_tree_neighbours,
    "op8_preference_pairs": op8_preference_pairs,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_toxicity": op10_toxicity,
}

ORACLE: dict[str, str] = {
    "op4_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
""",
    "op8_preference_pairs": chat.ORACLE,
}
