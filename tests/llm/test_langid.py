"""Language models against plain Kneser-Ney over strings, and what calibration rejects."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import langid

WORDS = {"banana": 3, "band": 1, "bandana": 2, "an": 7, "nab": 1, "a": 4, "éa": 1, "cab": 2}


def plain(counts, order):
    """word -> cost of its letters and end mark, by recursion over strings."""
    raw = [collections.Counter() for _ in range(order + 1)]
    for w, c in counts.items():
        s = "\x02" + w + "\x03"
        for n in range(1, order + 1):
            for i in range(len(s) - n + 1):
                raw[n][s[i : i + n]] += c
    used = [None] * (order + 1)
    used[order] = dict(raw[order])
    for n in range(order - 1, 0, -1):
        before = collections.Counter(g[1:] for g in raw[n + 1])
        used[n] = {g: before[g] or raw[n][g] for g in raw[n]}
    rate, total, kinds = {}, {}, {}
    for n in range(1, order + 1):
        one, two = (sum(c == k for c in used[n].values()) for k in (1, 2))
        rate[n] = min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5
        total[n], kinds[n] = collections.Counter(), collections.Counter()
        for g, c in used[n].items():
            total[n][g[:-1]] += c
            kinds[n][g[:-1]] += 1

    def p(context, c):
        n = len(context) + 1
        if n == 1:
            low = 1 / (len(used[1]) + 1)
        else:
            low = p(context[1:], c)
        if not total[n][context]:
            return low
        return max(used[n].get(context + c, 0) - rate[n], 0) / total[n][context] + rate[n] * kinds[n][context] / total[n][context] * low

    def cost(w):
        s = "\x02" + w + "\x03"
        return -sum(math.log(p(s[max(0, i - order + 1) : i], s[i])) for i in range(1, len(s)))

    return cost


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_costs_are_those_of_plain_kneser_ney(order):
    other = {"abba": 2, "cabbage": 1, "éé": 3}
    models = [langid.KneserNey(list(c), np.array(list(c.values())), order) for c in (WORDS, other)]
    scorer = langid.Scorer(models)
    asked = [*WORDS, *other, "banane", "zzz", "x", "abanda", "éb"]
    got, size = scorer.word_costs(asked)
    assert list(size) == [len(w) + 1 for w in asked]
    for k, counts in enumerate((WORDS, other)):
        cost = plain(counts, order)
        for w, g in zip(asked, got[:, k]):
            assert g == pytest.approx(cost(w), rel=1e-5), (order, k, w)


def test_lookup():
    key = np.unique(np.random.default_rng(2).integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2))
    look = langid.Lookup(key)
    at, found = look.find(np.concatenate([key, key + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)]))
    assert found[: len(key)].all() and (at[: len(key)] == np.arange(len(key))).all() and not found[len(key) :].any()
    assert not langid.Lookup(key[:0]).find(key[:3])[1].any()


def test_what_is_rejected(spark):
    """Of texts like those learnt from next to none are rejected; foreign and made-up ones are, if long enough to tell."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang").where("length(text) > 200")
    model = langid.train(docs)
    found = langid.identify(docs, model)
    assert found.agg(F.avg(F.col("lang_rejected").cast("int"))).first()[0] <= 0.002
    r = random.Random(5)
    finnish = "Pohjoistuuli ja aurinko väittelivät kummalla olisi enemmän voimaa kun he samalla näkivät kulkijan jolla oli yllään lämmin takki. "
    polish = "Pewnego razu Północny Wiatr i Słońce sprzeczali się kto z nich jest silniejszy właśnie przechodził drogą jakiś człowiek owinięty w ciepły płaszcz. "
    turkish = "Poyraz ile güneş birbirlerinden daha güçlü olduklarını ileri sürerek iddialaşıyorlardı derken kalın bir palto giymiş bir yolcu gördüler. "
    greek = "Ο βοριάς κι ο ήλιος μάλωναν για το ποιος απ τους δυο είναι ο δυνατότερος. "
    kinds = {
        "finnish": finnish * 4, "polish": polish * 4, "turkish": turkish * 4, "greek": greek * 4, "japanese": "日本語の文章です" * 40,
        "random letters": " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(80)),
        "base 64": "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(600)),
        "consonants": " ".join("".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(80)),
    }
    df = spark.createDataFrame([(k, v) for k, v in kinds.items()], "doc_id string, text string")
    kept = {x["doc_id"] for x in langid.identify(df, model).collect() if not x["lang_rejected"]}
    assert not kept


def test_few_rows_of_a_language(spark):
    rows = [(i, "the and of the people and their words " * 3, "en") for i in range(200)] + [(300, "und der die das nicht ist wir ihr euch", "xx")]
    learnt = langid.train(spark.createDataFrame([x for x in rows], "doc_id long, text string, lang string"))
    ids = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = langid.learnable(ids, "doc_id").where("lang = 'xx'").first()["held_out"]
    assert learnt.value.languages == (["en"] if held else ["en", "xx"])
