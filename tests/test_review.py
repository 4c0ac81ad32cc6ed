"""Queries without SQL against brute force over the same tables, and the answers that were wrong once."""

import difflib
import itertools
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import geometry, ledger, validate
from lectern.plans import registry, review
from lectern.sources import writers

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def pairs():
    """(conv_id, turn, words, words of the next turn)."""
    c = pd.read_parquet(f"{SF}/conversations.parquet").dropna(subset=["text"])
    said = {(r.conv_id, r.turn): r.text.split() for r in c.itertuples()}
    return [(k, t, a, said[k, t + 1]) for (k, t), a in said.items() if (k, t + 1) in said]


def matcher(a, b):
    return difflib.SequenceMatcher(None, a, b, autojunk=False)


def test_alignment(spark, pairs):
    want = [(k, t, *o) for k, t, a, b in pairs for o in matcher(a, b).get_opcodes()]
    assert rows(review.align.opcodes(review.turn_pairs(spark, SF), "conv_id", "turn")) == sorted(want, key=str)
    assert rows(registry.QUERIES["a1_alignment"](spark, SF)) == sorted(want, key=str)
    got = registry.QUERIES["g11_alignment_accuracy"](spark, SF).first()
    matched, size = sum(m.size for _, _, a, b in pairs for m in matcher(a, b).get_matching_blocks()), sum(len(a) for _, _, a, _ in pairs)
    assert (got["matched"], got["truth_words"]) == (matched, size) and got["rate"] == pytest.approx(matched / size)


def test_positions_and_readings(spark, pairs):
    same, swapped, read, boxes = [], [], [], {}
    for k, t, a, b in pairs:
        for tag, i1, i2, j1, j2 in matcher(a, b).get_opcodes():
            one = [(k, t, i1 + d, j1 + d) for d in range(i2 - i1)]
            same += one if tag == "equal" else []
            if tag == "equal" or tag == "replace" and i2 - i1 == j2 - j1:
                swapped += one
            if tag == "replace" and i2 - i1 == j2 - j1:
                read += [(k, t, i, b[j]) for _, _, i, j in one]
            if tag in ("equal", "replace"):
                for j in range(j1, j2):
                    boxes.setdefault((k, t, j // 40), []).append(i1 + min(j - j1, i2 - i1 - 1))
    q = registry.QUERIES
    assert rows(q["a2_word_positions"](spark, SF)) == sorted(same, key=str)
    assert rows(q["a3_word_positions_with_replaced"](spark, SF)) == sorted(swapped, key=str)
    assert rows(q["a4_readings"](spark, SF)) == sorted(read, key=str)
    got = {(r["conv_id"], r["turn"], r["unit_id"]): r for r in q["a12_attributed_regions"](spark, SF).collect()}
    assert set(got) == set(boxes)
    for k, at in boxes.items():
        assert got[k]["n"] == len(at)
        assert got[k]["x1"] == pytest.approx(min(i % 12 * 0.08 for i in at)) and got[k]["y2"] == pytest.approx(max(i // 12 * 0.01 + 0.008 for i in at))


def test_similarity(spark, pairs):
    want = {(k, t): (matcher(a, b).ratio(), difflib.SequenceMatcher(None, " ".join(a[:20]), " ".join(b[:20])).ratio()) for k, t, a, b in pairs}
    got = {(r[0], r[1]): (r[2], r[3]) for r in registry.QUERIES["a6_similarity"](spark, SF).collect()}
    assert got == want


def test_opening_owners(spark):
    c = pd.read_parquet(f"{SF}/conversations.parquet").dropna(subset=["text"])
    first, second = ([(r.conv_id, r.text.lower().split()[:50]) for r in c[c.turn == t].itertuples() if r.text.split()] for t in (0, 1))
    want = {}
    for k, a in first:
        best = max(((matcher(a, b).ratio(), -o) for o, b in second if o != k), default=(0, 0))
        if best[0] > 0:
            want[k] = (-best[1], best[0])
    assert {r["unit_id"]: (r["owner"], r["score"]) for r in registry.QUERIES["v9_opening_owners"](spark, SF).collect()} == want


def test_title_clusters_and_order(spark):
    d = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    title = lambda t: min((t.split(s)[0] for s in (". ", "\n")), key=len).strip(" ")
    want, before, now = {}, None, None
    for r in d.itertuples():
        here = title(r.text)
        if before is None or difflib.SequenceMatcher(None, before, here).ratio() < 0.8:
            now = r.doc_id
        want[r.doc_id], before = now, here
    assert dict(rows(registry.QUERIES["v3_title_clusters"](spark, SF))) == want
    # the most ranks kept by a non-decreasing labelling is the longest non-decreasing subsequence
    out = registry.QUERIES["d2_order_of_openings"](spark, SF).toPandas()
    for part, g in d.groupby("source"):
        letters = [t.strip()[0].lower() for t in g["text"] if t.strip()]
        ranks = [T.LATIN.alphabet.index(c) for c in letters if c in T.LATIN.alphabet]
        best = [1] * len(ranks)
        for a, b in itertools.combinations(range(len(ranks)), 2):
            if ranks[a] <= ranks[b]:
                best[b] = max(best[b], best[a] + 1)
        known = out[(out["part"] == part) & out["expected"].notna()]
        assert len(known) == len(ranks) - max(best, default=0)


def test_folded_texts(spark):
    d = pd.read_parquet(f"{SF}/documents.parquet")
    marks = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
    fold = str.maketrans(T.FOLD)
    want = [(r.doc_id, " ".join(filter(None, (w.strip(marks) for w in unicodedata.normalize("NFKC", r.text).translate(fold).split())))) for r in d.itertuples()]
    assert rows(registry.QUERIES["n7_folded_texts"](spark, SF)) == sorted(want, key=str)


def test_only_ids_that_follow_each_other_are_trimmed(spark):
    r = spark.createDataFrame([(1, 1, 0.1, 0.5), (3, 1, 0.3, 0.9), (4, 1, 0.85, 0.95), (5, 2, 0.0, 0.1), (6, 1, 0.9, 1.0)], "unit_id long, page long, ry1 double, ry2 double")
    assert [round(x["ry2"], 4) for x in geometry.trim_overlaps(r, 0.002).orderBy("unit_id").collect()] == [0.5, 0.848, 0.95, 0.1, 1.0]


def test_short_chunks(spark):
    u = spark.createDataFrame([(1, "the quick brown fox"), (2, "a quicker fox"), (3, None)], "unit_id int, text string")
    c = spark.createDataFrame([(1, "quick brown"), (2, "quick"), (3, ""), (4, None), (5, "fox jumps")], "chunk_id int, text string")
    assert rows(validate.contained_elsewhere(c, u)) == [(1, 1), (2, 1), (2, 2)]


def test_footnote_marks_close_no_bracket(spark):
    u = spark.createDataFrame([(1, '(a ") b'), (2, '(see ") and (more)'), (3, '(it"s x")'), (4, "*) 1")], "doc_id int, text string")
    got = {r["doc_id"]: r["parens"] for r in validate.characters(u, latin="[^\\x00-\\x{10FFFF}]").collect()}
    assert got == {1: 1, 2: 1, 4: 0}


def test_orphans(spark):
    a = spark.createDataFrame([(1, "one two three four".split())], "unit_id int, ws array<string>")
    b = spark.createDataFrame([(1, "one two three four".split()), (2, "one two three five".split()), (3, "six".split())], "unit_id int, ws array<string>")
    chunks, units = spark.createDataFrame([(9, "three five")], "chunk_id int, text string"), spark.createDataFrame([(2, "one two three five")], "unit_id int, text string")
    ops = spark.createDataFrame([(1, 2, "delete", 0, 9, 0, 0), (2, 4, "delete", 0, 9, 0, 0), (2, 3, "delete", 0, 7, 0, 0)], "unit_id int, next_id int, tag string, i1 int, i2 int, j1 int, j2 int")
    assert rows(validate.orphans(a, b, chunks, units, ops)) == [("chunk", 9, 2), ("gap", 1, 2), ("owner", 1, 2)]


def test_ledger_rows(spark, tmp_path):
    new = spark.createDataFrame([("klal_flag", 1), ("apply_event", 2)], "decision_type string, unit_id int")
    got = writers.stamped(new, 5).collect()
    assert len({r["id"] for r in got}) == 2 and all(len(r["id"]) == 12 and r["seq"] > 5 for r in got)
    with pytest.raises(Exception, match="no such decision type"):
        writers.stamped(new.withColumn("decision_type", F.lit("nonsense")), 0).collect()
    empty = spark.createDataFrame([], "seq bigint, decision_type string, unit_id int")
    writers.append(new, empty, f"{tmp_path}/ledger")
    writers.append(new, spark.read.json(f"{tmp_path}/ledger"), f"{tmp_path}/ledger")
    assert spark.read.json(f"{tmp_path}/ledger").select("seq").distinct().count() == 4


def test_cache_answers_absent_and_empty_alike(spark):
    q = spark.createDataFrame([("c", None, "b", "x", "p"), ("c", "", "b", "x", "p"), ("c", "a", "b", "x", "p")], "crop_hash string, word_a string, word_b string, context_hash string, prompt_hash string")
    assert ledger.cache_key(q).select("key").distinct().count() == 2
    old = ledger.cache_migrated(q.where("word_a = 'a'").drop("prompt_hash").withColumn("answer", F.lit("yes")), "p")
    assert [r["answer"] for r in ledger.cache_get(q, old).orderBy(F.col("word_a").desc_nulls_last()).collect()] == ["yes", None, None]
