"""Each operator on a small table of awkward rows, against brute force where it is exact."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import blocks, chat, html, langid, packing, topk, toxicity, vptree
from lectern.llm.common import learnable
from lectern.llm.components import components
from lectern.llm.jaccard import jaccard_components


def text_rows(seed=7, n=120):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdef") for _ in range(r.randint(1, 6))) for _ in range(400)]
    prose = lambda k: [r.choice(words) for _ in range(k)]
    rows = [(1, None), (2, ""), (3, "   \n"), (4, "One"), (5, "one"), (6, "one two"), (None, "one two"), (7, "A b c"), (8, "a B c"), (9, "a b c"), (9, "a b c"), (10, "x" * 5000)]
    for i in range(11, n):
        if r.random() < 0.6 and i > 20:
            w = (r.choice(rows[12:])[1]).split()
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(words)
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(prose(r.choice([3, 5, 30, 80, 200])))))
    r.shuffle(rows)
    return rows


def jaccard_brute(rows, k, percent):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            top[find(a)] = find(b)
    least = {}
    for x in range(len(rows)):
        i = rows[x][0]
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return [(rows[x][0], len(sets[x]), least.get(find(x)) if sets[x] else rows[x][0]) for x in range(len(rows))]


order = lambda rows: sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_equals_brute_force(spark, k, percent):
    rows = text_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).repartition(3)
    assert order(jaccard_components(df, k=k, percent=percent, block_bytes=2000, row_block=8).collect()) == order(jaccard_brute(rows, k, percent))


def test_jaccard_of_nothing(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(None, 1), (5, 5)]
    got = {x["node"]: x["label"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y), todo.append(y)
        assert got[start] == min(seen)
    assert set(got) == set(near)


def test_packing_is_gapless_and_tight(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    rows = [(1, None), (2, ""), (None, "abc"), (3, "word " * 3000), (3, "word " * 3000)] + [(i, "some text " * (i % 97)) for i in range(4, 200)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, capacity=256).collect()
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 256) * 1.03 + 1
    tok = Tokenizer.from_file(path)
    for i, t in {(i, t) for i, t in rows if i not in (None, 3)}:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], np.uint32)
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == i)
        assert sum(m[2] for m in mine) == len(ids)
        for k, (piece, start, length, crc) in enumerate(mine):
            assert piece == k and zlib.crc32(ids[start : start + length].tobytes()) == crc and (k == 0 or length == 256)
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []


def test_fullest_is_the_fullest():
    r = random.Random(1)
    for _ in range(200):
        count = {r.randint(1, 30): r.randint(1, 3) for _ in range(r.randint(1, 6))}
        used = packing.fullest(dict(count), 32)
        items = [k for k, v in count.items() for _ in range(v)]
        items.remove(max(count))
        best = max(sum(c) for n in range(len(items) + 1) for c in itertools.combinations(items, n) if sum(c) <= 32 - max(count))
        assert sum(k * v for k, v in used.items()) == best + max(count)
        assert all(v <= count[k] for k, v in used.items())


def vector_rows(n=700, dim=12, seed=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)).round(2)
    rows = [(int(i), [float(y) for y in v]) for i, v in enumerate(x)]
    rows[20] = (20, rows[40][1])
    rows += [(n, None), (n + 1, []), (n + 2, [None] * dim), (n + 3, [float("nan")] * dim), (n + 4, [float("inf")] * dim), (n + 5, [0.0] * dim), (None, [1.0] * dim)]
    return rows


def best(rows, every, k, score, zero):
    use = [(i, v) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and (zero or any(v))]
    out = []
    for i, v in use:
        if i % every == 0:
            s = sorted(((score(v, w), -j) for j, w in use if j != i), reverse=True)[:k]
            out += [(i, rank + 1, -j, sc) for rank, (sc, j) in enumerate(s)]
    return out


def test_top_k_is_exact(spark):
    rows = vector_rows()
    q = lambda v: np.floor(256 * np.array(v)).astype(np.int64)
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=10, k=5, shard=150).collect()
    assert order(got) == order(best(rows, 10, 5, lambda a, b: int(q(a) @ q(b)), True))
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []
    few = topk.top_k(spark.createDataFrame([(0, [1.0, 2.0]), (50, [1.0, 1.0]), (3, [2.0, 2.0])], "vec_id long, embedding array<float>"), every=50).collect()
    assert len(few) == 4


def test_vp_tree(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = best(rows, 20, 20, lambda a, b: float(np.dot(a, b)), False)
    exact = vptree.nearest(df, every=20, k=20, factor=1.0, shard=200).collect()
    assert [(r["query_id"], r["rank"]) for r in sorted(exact)] == [(w[0], w[1]) for w in sorted(want)]
    assert np.allclose([r["score"] for r in sorted(exact)], [w[3] for w in sorted(want)])
    loose = vptree.nearest(df, every=20, k=20, shard=200).collect()
    assert len({(r["query_id"], r["vec_id"]) for r in loose} & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)


def test_vp_tree_ties_and_repeats():
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 16))
    x[100:500] = x[100]
    x[600:650] = x[7]
    ids = r.permutation(1500) * 3
    index = vptree.build(ids, x)
    asked = np.arange(0, 1500, 10)
    a, b, _ = vptree.query(index, ids[asked], x[asked], 20, 1.0)
    products = np.einsum("ij,kj->ik", x[asked], x)
    for i in range(len(asked)):
        assert list(b[a == i]) == list(ids[np.lexsort((ids, -products[i]))[:21]])


def test_vp_tree_recall_on_provided_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r[0], list(map(float, r[1]))) for r in df.select("vec_id", "embedding").collect()]
    want = {(w[0], w[2]) for w in best(rows, 20, 20, lambda a, b: float(np.dot(a, b)), False)}
    got = {(r["query_id"], r["vec_id"]) for r in vptree.nearest(df, every=20, k=20).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_vectors_of_another_size_take_no_part(spark):
    d = blocks.vectors(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [2.0, 2.0])], "id long, v array<double>"), "id", "v", nonzero=False)
    assert blocks.commonest_size(d) == 2


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies.</p></div><div class=main{n}><div class="content"><h2>A &amp; B</h2><p>First   <b>bold</b>&nbsp;line that is long enough to be prose.<p>Second<br>line, also of some length &lt;here&gt;.</p>
<script>var x = "<p>no</p>";</script><aside>Aside</aside><ul><li>One</li><li>Two</li></ul><form><p>Mail</p></form></div><div id="comments"><p>A reader says a lot, a lot, a lot, a lot, a lot.</p></div></div><footer>&copy; me</footer></body></html>"""
WANT = "A & B\n\nFirst bold line that is long enough to be prose.\n\nSecond line, also of some length <here>.\n\nOne\n\nTwo"


def test_html(spark):
    rows = [(i, f"http://Host.example:80/{i}", PAGE.replace("{n}", str(i))) for i in range(3)] + [(3, None, PAGE), (4, "http://e.example/", None), (5, "x", ""), (5, "x", ""), (None, "http://host.example/", "plain"), (6, "http://host.example/6", "<p>cut <b>of"), (7, "http://host.example/7", '<div class="a" title="b>c"><p>x &zzz; y</div>')]
    got = {(r["page_id"], r["url"]): r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), small=1).collect()}
    assert got[(0, "http://Host.example:80/0")] == got[(1, "http://Host.example:80/1")] == got[(3, None)] == WANT
    assert got[(4, "http://e.example/")] == got[(5, "x")] == ""
    assert got[(None, "http://host.example/")] == "plain" and got[(6, "http://host.example/6")] == "cut of"
    assert got[(7, "http://host.example/7")] == "x &zzz; y"
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_html_hosts_vote(spark):
    body = "<p>" + "Prose of the article, with commas, and with length. " * 5 + "</p>"
    usual = f'<body><div class="story">{body * 3}</div><div class="more">{body}</div></body>'
    odd = f'<body><div class="story">{body}</div><div class="more">{body * 4}</div></body>'
    rows = [(i, "http://h.example/", usual) for i in range(4)] + [(9, "http://h.example/", odd), (10, "http://other.example/", odd)]
    got = {r["page_id"]: r["text"].count("\n\n") + 1 for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == 1 and got[10] == 4 and got[0] == 3


def test_html_parts_of_one_path(spark):
    prose = lambda name, n: f"<p>{name}: " + "prose of the article, with commas. " * n + "</p>"
    links = '<div class="part-9"><ul>' + '<li><a href="x">One of many links</a></li>' * 5 + "</ul></div>"
    for outer in ("div", "article"):
        page = f'<body><{outer}><div class="part-1">{prose("a", 90)}</div>{links}<div class="part-2">{prose("b", 25)}</div></{outer}></body>'
        rows = [(i, url, page) for i, url in enumerate(["http://h.example/", "http://h.example/2", None])]
        for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
            assert [t[:2] for t in r["text"].split("\n\n")] == ["a:", "b:"], r


def test_preference_pairs(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hi"), (1, 1, "assistant", "no!"), (1, 2, "user", None), (2, 0, "user", "alone"), (4, 0, "user", "s"), (5, 0, "user", "s"), (None, 0, "user", "x"), (7, None, None, "late"), (6, 0, "user", "a"), (6, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: r for r in chat.preference_pairs(df, pair=F.floor(F.col("conv_id") / 2).cast("long"), chosen=F.col("conv_id") % 2 == 0).collect()}
    a = got[0]
    assert (a["n_prefix"], a["prompt"], a["chosen"]) == (1, "<|im_start|>user\nhi<|im_end|>\n", "<|im_start|>assistant\nyes<|im_end|>\n")
    assert a["rejected"] == "<|im_start|>assistant\nno!<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert a["chosen_mask"] == "0*22,1*14" and a["rejected_mask"] == "0*22,1*14,0*28"
    assert sum(int(x.split("*")[1]) for x in a["rejected_mask"].split(",")) == len(a["rejected"])
    assert got[1]["rejected_id"] is None and got[1]["rejected"] == "" and got[1]["n_prefix"] == 0
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[2]["n_prefix"] == 1
    assert len(got) == 4 and got[3]["chosen"].count("im_start") == 2


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs)
    found = langid.identify(learnable(docs, "doc_id"), model)
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("lang_rejected").cast("int"))).first()
    assert right[0] > 0.98 and right[1] < 0.01
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 $$ 34"), (None, "the and of"), (5, "日本語の文章です" * 20), (5, "日本語の文章です" * 20)], "doc_id long, text string").withColumn("lang_pred", F.lit("clash"))
    got = [(r["doc_id"], r["lang_pred"], r["lang_rejected"]) for r in langid.identify(odd, model).collect()]
    assert [g[1] for g in got[:3]] == ["und"] * 3 and all(g[2] for g in got[:3])
    assert got[3][1] == "en" and not got[3][2] and got[4][2] and got[4] == got[5]
    assert all(0 <= r["lang_score"] <= 1 for r in langid.identify(odd, model).collect())
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.train(empty) is None and langid.identify(empty, model).collect() == []
    assert [r["lang_pred"] for r in langid.identify(odd, None).collect()] == ["und"] * 6


def test_toxicity(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    bad = ["zxq" + s for s in ("ab", "cd", "ef", "gh", "ij")]
    rows, labels = [], []
    for i in range(900):
        w = [r.choice(words) for _ in range(r.randint(5, 60))]
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(bad))
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic_score string")
    model = toxicity.train(docs, spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int"))
    got = {x["doc_id"]: x for x in toxicity.toxicity(learnable(docs, "doc_id"), model).collect()}
    held = [(i, y) for i, y in labels if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert np.mean([(got[i]["toxic_score"] >= 0.7) == bool(y) for i, y in held]) > 0.97
    assert any(got[i]["toxic_evidence"] for i, _ in held)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "!!"), (3, "!!"), (None, "zxqab zxqcd zxqef")], "doc_id long, text string")
    out = toxicity.toxicity(odd, model).collect()
    assert all(0 <= x["toxic_score"] <= 1 for x in out) and len(out) == 5
    assert out[4]["toxic_score"] > 0.7 > out[0]["toxic_score"] and out[0]["toxic_score"] == out[1]["toxic_score"]
    assert toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None


def test_toxicity_of_more_words_than_the_former_cap(spark):
    """Toxic words over 250 stems, 8 terms each: every one of them is indexed, so no toxic text looks clean."""
    r = random.Random(4)
    word = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    bad, clean = [word("qxzvkj", 10) for _ in range(250)], [word("abcdefgh", 6) for _ in range(300)]
    rows = [(i, " ".join([r.choice(clean) for _ in range(20)] + ([bad[i // 2 % 250]] * 2 if i % 2 else []))) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(12_000)], "doc_id long, toxic int"))
    assert len(model.value.vocabulary.terms) > 1024
    assert set(bad) <= set(model.value.vocabulary.terms)
    asked = spark.createDataFrame([(i, f"{clean[i]} {b} {clean[i + 1]}") for i, b in enumerate(bad)], "doc_id long, text string")
    assert toxicity.toxicity(asked, model).where("toxic_score >= 0.7").count() == 250


def test_index_is_exact():
    r = np.random.default_rng(1)
    vectors = []
    for _ in range(500):
        t = np.sort(r.choice(40, r.integers(1, 6), replace=False))
        w = r.random(len(t)) + 0.1
        vectors.append((t, w / np.linalg.norm(w)))
    index = toxicity.Index(vectors, np.ones(500), r.integers(0, 2, 500), np.arange(500), 40, block=16)
    for t, w in vectors[:60]:
        found, score = index.nearest(t, w, 7)
        every = index.dense[:, t] @ w.astype(np.float32)
        assert np.allclose(np.sort(every)[::-1][:7], score, atol=1e-5)
