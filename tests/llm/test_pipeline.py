"""Every stage of the corpus pipeline on its own input, against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dedup import brute
from test_llm_operators import jaccard_brute

import corpus_pipeline
from lectern.llm import langid, toxicity
from lectern.llm.queries import tokenizer

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage, over documents with a null text, a null id and a repeated row added."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    odd = spark.createDataFrame([(9001, None, "en", "x", None), (None, "The and of the and of.", "en", None, 5), (9002, "", None, "x", 0)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id = 7"))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        out[name] = before.toPandas(), docs.toPandas()
    return out


def test_names_and_columns(stages):
    assert list(stages) == ["toxicity", "language_id", "ngram_jaccard", "suffix_dedup", "packing"]
    for name, (_, after) in list(stages.items())[:-1]:
        assert list(after.columns) == COLUMNS, name
        assert len(after)


def test_toxicity_drops_what_its_operator_rejects(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    gone = set(before["doc_id"].dropna()) - set(after["doc_id"].dropna())
    toxic = {r[0] for r in labels.where("toxic = 1").select("doc_id").collect()}
    labelled = {r[0] for r in labels.select("doc_id").collect()}
    assert gone and not (gone & labelled) - toxic
    model = toxicity.train(docs, labels)
    scores = toxicity.toxicity(docs.where(F.col("doc_id").isin([int(x) for x in gone])), model)
    assert scores.where("toxic_score >= 0.5").count() >= 0.8 * len(gone)


def test_language_id_keeps_clean_documents(spark, stages):
    before, after = stages["language_id"]
    letters = before["text"].fillna("").str.contains(r"[^\W\d_]", regex=True)
    assert len(after) == int(letters.sum())
    assert langid.UNDETERMINED == "und"


def test_near_copies_leave_one(stages):
    before, after = stages["ngram_jaccard"]
    rows = [(None if np.isnan(i) else int(i), t) for i, t in zip(before["doc_id"].astype(float), before["text"])]
    keep = sorted(i for i, _, c in jaccard_brute(rows, 5, 80) if i is not None and i == c)
    assert sorted(int(i) for i in after["doc_id"].dropna()) == keep
    assert after["doc_id"].isna().sum() == before["doc_id"].isna().sum()


def test_repeats_are_cut(stages):
    before, after = stages["suffix_dedup"]
    rows = [(None if np.isnan(i) else int(i), t) for i, t in zip(before["doc_id"].astype(float), before["text"])]
    want = sorted((i is None, i or 0, n - removed) for i, n, removed, _, _ in brute(rows))
    got = [(np.isnan(i), int(0 if np.isnan(i) else i), len(t.encode())) for i, t in zip(after["doc_id"].astype(float), after["text"])]
    assert len(got) == len(want)
    for (a, b, n), (x, y, m) in zip(sorted(got), want):
        assert (a, b) == (x, y) and m - 6 <= n <= m  # a cut character loses its other bytes
    assert (after["n_chars"] == after["text"].str.len()).all()


def test_packing_holds_every_token(stages):
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    coder = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    tokens = {int(i): len(coder.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in zip(before["doc_id"], before["text"]) if i == i and i != 7}
    named = after[after["doc_id"].notna()]
    got = named.groupby("doc_id")["length"].sum().to_dict()
    assert {i: n for i, n in got.items() if i != 7} == tokens
    assert set(after["doc_id"].dropna()) == set(before["doc_id"].dropna())
    for _, g in after.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g["offset"]) == [0, *g["length"].cumsum()[:-1]] and g["length"].sum() <= 1024
    assert re.fullmatch(r"[a-z_]+", corpus_pipeline.STAGES[0][0])


def test_nothing_to_learn_from_and_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "The one and only text of this table.", None, "x", 37)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/a/documents.parquet"), labels.write.parquet(f"{tmp_path}/a/labels.parquet")
    assert [r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/a").collect()] == [1]
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet"), labels.write.parquet(f"{tmp_path}/b/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []
