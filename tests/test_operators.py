import difflib
import json
import xml.dom.minidom

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import align, apply, detect, freq, geometry, ledger, tokens, trace, validate
from lectern.plans import serving
from lectern.sources import readers, writers
from lectern.streaming import ledger as stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def forms(spark, **n):
    return spark.createDataFrame(list(n.items()), "form string, n long")


def test_repeated_words_keep_their_place(spark):
    u = spark.createDataFrame([(1, "a a , b b, b."), (2, None), (3, "x")], "doc_id long, text string")
    assert rows(tokens.plain_repeats(u)) == [(1, 0, "a"), (1, 3, "b"), (1, 4, "b,")]
    assert rows(tokens.repeated(tokens.positioned(u), T.alnum(F.col("word")), allowed=("a",), least=1)) == [(1, 3, "b"), (1, 4, "b,")]


def test_passages(spark):
    u = spark.createDataFrame([(1, "a b c d a b c x a b c"), (2, "z a b c"), (9, "a b c z"), (70000, "q a b c")], "doc_id long, text string")
    assert rows(tokens.repeated_grams(u, 3)) == [(1, "a b c", 0, 4), (1, "a b c", 0, 8)]
    assert rows(tokens.shared_with_next(u, 3)) == [(1, 2, "a b c"), (2, 9, "a b c"), (9, 70000, "a b c")]
    assert rows(tokens.context(tokens.positioned(u), spark.createDataFrame([(2, 0), (2, 9), (1, 5)], "doc_id long, word_index int"), 1, 2)) == [(1, 5, "a b c"), (2, 0, "z a")]


def test_frequencies(spark):
    w = tokens.positioned(spark.createDataFrame([(1, "a b a"), (2, "a ,"), (3, "a c")], "doc_id long, text string"))
    f = freq.frequency(w, T.alnum(F.col("word")))
    assert rows(f) == [("a", 4), ("b", 1), ("c", 1)] and rows(freq.summary(f)) == [(6, 3, 2)]
    assert rows(freq.spread(w, F.col("word"), "doc_id", 3)) == [("a", 3, 4, "1,2,3")]
    assert rows(freq.unknown(w, T.alnum(F.col("word")), forms(spark, a=1), "doc_id")) == [("b", 1, 1, 1, 1, 1), ("c", 1, 1, 1, 3, 1)]


def test_substitutions(spark):
    s = T.Script("a-z", "abcdefghijklmnopqrstuvwxyz", ("bd", "oa"))
    own = forms(spark, dog=1, cot=3, bat=4, bad=1)
    ref = forms(spark, bog=51, dag=10, cat=50, bat=900, dad=100, bab=20)
    got = {r["form"]: r for r in detect.substitutions(own, ref, s).collect()}
    assert set(got) == {"dog", "bad"}  # cot's neighbour has exactly 50, bat is attested
    assert got["dog"]["candidate"] == "bog" and got["dog"]["verdict"] == "high_confidence"
    tie = {r["form"]: r["verdict"] for r in detect.substitutions(forms(spark, bb=1), forms(spark, db=500, bd=100), s).collect()}
    assert tie == {"bb": "ambiguous"}  # five times is not enough


def test_insertions_and_deletions(spark):
    s = T.Script("a-z", "abcdefghijklmnopqrstuvwxyz", (), "w")
    ref = forms(spark, house=200, ouse=400, hous=199, mouse=300)
    got = {r["form"]: (r["candidate"], r["verdict"]) for r in detect.insertions_deletions(forms(spark, housee=1, hose=2, mous=1, whouse=1, abc=1), ref, s).collect()}
    assert got == {"housee": ("house", "high_confidence"), "hose": ("house", "high_confidence"), "mous": ("mouse", "high_confidence")}


def test_shapes(spark):
    own = forms(spark, te=1, the=9, tt=1, tht=4, tth=5, lleo=1, leo=3)
    assert rows(detect.dropped_letter(own, "t", "h", forms(spark, the=1))) == [("te", 1, "the", 9, "high_confidence")]
    assert rows(detect.fused_first_letter(own, "l")) == [("lleo", 1, "leo", 3)]
    ref = forms(spark, abc=300, defg=400, abcd=299, efg=900)
    assert rows(detect.merged(forms(spark, abcdefg=2), ref)) == [("abcdefg", 2, "abc", 300, "defg", 400)]
    w = tokens.positioned(spark.createDataFrame([(1, "in to xx in to")], "doc_id long, text string"))
    f = freq.frequency(w, F.col("word"))
    assert len(rows(detect.split(w, F.col("word"), f, forms(spark, into=500)))) == 2


def test_triage(spark):
    s = T.Script("a-z", "abcdefghijklmnopqrstuvwxyz", ("bd",), "w", ("t", "h"))
    gaps = spark.createDataFrame([("dog", 1, False), ("wcat", 2, False), ("qu", 5, True), ("zzz", 1, False), ("tere", 1, False), ("many", 3, False), ("few", 3, False)], "form string, occurrences long, all_quoted boolean")
    ref = forms(spark, bog=20, cat=25, there=50, many=25, few=1)
    got = {r["form"]: (r["bucket"], r["score"]) for r in detect.triage(gaps, forms(spark, x=1), ref, s).collect()}
    assert got["dog"] == ("ocr_shape_to_read", 9) and got["wcat"] == ("prefix_resolved", 3 + 2) and got["qu"] == ("abbreviation_artifact", 1)
    assert got["zzz"] == ("unresolved", 6) and got["tere"][1] == 6 + 3 + 2 and got["many"] == ("independently_attested", 2) and got["few"] == ("weakly_attested", 3)


def test_abbreviations(spark):
    s = T.Script("a-z", "abcdefghijklmnopqrstuvwxyz", (), "w")
    f = spark.createDataFrame([("rb'", "rb"), ("wrb'", "wrb"), ("hous'", "hous"), ("k'", "k"), ("zzz'", "zzz")], "form string, stem string")
    d = spark.createDataFrame([("rb", "rabbi", "title")], "stem string, expansion string, category string")
    got = {r["form"]: (r["category"], r["expansion"]) for r in detect.resolve_abbreviations(f, d, forms(spark, house=51), s).collect()}
    assert got == {"rb'": ("title", "rabbi"), "wrb'": ("prefix_title", "rabbi"), "hous'": ("truncated", "house"), "k'": ("numeral", None), "zzz'": ("unresolved", None)}


def test_verdicts(spark):
    a = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    cases = [(a(), a("x"), a("y"), "UNREADABLE"), (a("x", "y"), a("x"), a("y"), "BOTH"), (a("x"), a("x"), a("y"), "A"), (a("y"), a("x"), a("y"), "B"), (a("z"), a("x"), a("y"), "THIRD")]
    assert spark.range(1).select(*[detect.verdict(t, x, y) for t, x, y, _ in cases]).first() == tuple(c[3] for c in cases)
    t = detect.tier(F.lit("a"), F.lit("b"), F.lit(False), F.lit(True))
    assert spark.range(1).select(t).first()[0] == "A"


def test_ledger(spark):
    led = spark.createDataFrame([(1, "a", 1, 5, "x"), (2, "b", 1, 5, "y"), (3, "c", 1, None, "z"), (4, "d", 1, None, "w"), (5, "e", 2, 5, "v")], "seq long, id string, unit_id long, word_index int, chosen_text string")
    assert [r[3] for r in rows(ledger.current(led, "unit_id", "word_index").select("unit_id", "word_index", "seq", "chosen_text"))] == ["y", "w", "v"]
    assert ledger.history(led, 1).count() == 4 and ledger.history(led, 1, 5).count() == 2
    applied = spark.createDataFrame([("a",), ("c",), ("d",), ("q",)], "applied_id string")
    got = {r["id"]: r["superseded"] for r in ledger.superseded(led, applied, "unit_id", "word_index").collect()}
    assert got == {"a": False, "c": True, "d": False}
    assert rows(ledger.unapplied(led, applied).select("id")) == [("b",), ("e",)] and rows(ledger.dangling(applied, led)) == [("q",)]
    assert spark.range(1).select(ledger.kind(F.lit("disputed_choice"))).first()[0] == "candidate_choice"
    units = spark.createDataFrame([(1, "p q x y")], "unit_id long, text string")
    d = spark.createDataFrame([("1", 1, 2, "x", False), ("2", 1, 0, "q", False), ("3", 1, 2, "x", True), ("4", 1, 0, "", False), ("5", 9, 0, "x", False)], "id string, unit_id long, word_index int, chosen_text string, superseded boolean")
    assert {r["id"]: r["outcome"] for r in ledger.audit(d, units, T.words).collect()} == {"1": "ok", "2": "mismatch", "3": "superseded", "4": "unverifiable", "5": "missing"}
    k = "crop_hash string, word_a string, word_b string, context_hash string, prompt_hash string"
    assert ledger.missing_verdicts(spark.createDataFrame([("c", None, "b", "x", "p"), ("c", "", "b", "x", "p")], k), spark.createDataFrame([("c", None, "b", "x", "p")], k)).count() == 1


def test_flags_and_drift(spark):
    c = lambda o, s, p: ledger.classify(F.lit(o), F.lit(s), F.lit(p).cast("double"))
    want = {("replace", "A", 0.7): "current_text_may_be_wrong", ("replace", "A", 0.69): "ambiguous", ("replace", "B", None): "ambiguous", ("replace", "B", 0.0): "ambiguous", ("replace", "ERROR", 1.0): "error", ("delete", "A", 0.9): "possible_omission", ("delete", "B", 0.9): "ambiguous", ("delete", "ERROR", 0.9): "error", ("insert", "A", 1.0): "unverified_insertion", ("x", "A", 1.0): "unverified"}
    assert spark.range(1).select(*[c(*k) for k in want]).first() == tuple(want.values())
    ws = F.split(F.lit("a b c"), " ")
    d = lambda o, i, e: ledger.drifted(ws, F.lit(o), F.lit(i), F.lit(e), T.words)
    assert spark.range(1).select(d("replace", 1, "b c"), d("replace", 2, "c d"), d("insert", -1, "c"), d("delete", 3, None), d("delete", 4, None), d("replace", 0, "b")).first() == (False, True, True, False, True, True)
    assert set(serving.FLAG_LABELS) >= set(want.values())


def test_edits(spark):
    assert apply.edit("a b c".split(), "replace", 1, "b c", "x") == ["a", "x"]
    assert apply.edit("a b c".split(), "replace", 3, "", "x") is None and apply.edit("a b".split(), "replace", -1, "b", "x") is None
    assert apply.edit("a b".split(), "insert", 1, "b", "") == ["a"] and apply.edit("a b".split(), "delete", 2, None, "c") == ["a", "b", "c"]
    assert apply.edit("a b".split(), "delete", 1, None, "b") is None  # not twice
    assert apply.edit("a b".split(), "manual", 1, "b", None) == ["a"] and apply.edit("a b".split(), "manual", 0, None, "z") == ["z", "a", "b"]
    ws = F.split(F.lit("a b c"), " ")
    arr = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    assert spark.range(1).select(apply.put(ws, F.lit(1), arr("b"), arr("x", "y")), apply.put(ws, F.lit(-1), arr("c"), arr()), apply.put(ws, F.lit(3), arr(), arr("d")), apply.put(ws, F.lit(1), arr(), arr("b"))).first() == (["a", "x", "y", "c"], None, ["a", "b", "c", "d"], None)


def test_apply_decisions(spark):
    units = spark.createDataFrame([(1, "a b c"), (2, "x y")], "unit_id long, text string")
    d = spark.createDataFrame([("1", 1, 0, "insert", "a", None), ("2", 1, 2, "insert", "c", None), ("3", 1, 9, "replace", "q", "z"), ("4", 2, 1, "replace", "y", "y"), ("5", 3, 0, "replace", "y", "y"), ("6", 2, 0, "manual", "x", "X")], "id string, unit_id long, word_index int, op string, old string, new string")
    got = {r["id"]: (r["text"], r["outcome"]) for r in apply.apply_decisions(units, d).collect()}
    assert got == {"1": ("b c", "applied"), "2": ("b c", "deferred"), "3": ("b c", "drift"), "4": ("X y", "confirmed"), "6": ("X y", "applied"), "5": (None, "missing")}
    p = spark.createDataFrame([("a", 1, 1, "a", "b", ","), ("b", 1, 2, "b", "c", "."), ("c", 1, 2, "x", "c", ".")], "id string, unit_id long, before_word_index int, word_before string, word_after string, mark string")
    assert {r["id"]: (r["text"], r["outcome"]) for r in apply.apply_punctuation(units, p).collect()} == {"a": ("a, b. c", "applied"), "b": ("a, b. c", "applied"), "c": ("a, b. c", "drift")}


def test_alignment(spark):
    a, b = "the quick brown fox jumps over it all".split(), "the quack brown fox leaps high over all of".split()
    p = spark.createDataFrame([(1, a, b), (2, ["x"] * 30, b)], "k long, a array<string>, b array<string>")
    ops = align.opcodes(p, "k", limit=20)
    assert [tuple(r)[1:] for r in sorted(ops.where("k = 1").collect(), key=lambda r: (r["i1"], r["j1"]))] == difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
    assert rows(ops.where("k = 2")) == [(2, "guarded", 0, 30, 0, 9)]
    side = lambda c: p.select("k", F.col(c).alias("words"))
    good, left = align.candidates(ops, side("a"), side("b"), "k")
    assert ("replace", "quick", "quack") in {(r["opcode"], r["ocr_reading"], r["stored_text"]) for r in good.collect()}
    assert {r["reason"] for r in left.collect()} >= {"guarded", "unequal_words"}
    long = [str(i % 7) for i in range(300)]
    junk = spark.createDataFrame([(1, long, long[5:])], "k long, a array<string>, b array<string>")
    assert align.opcodes(junk, "k", autojunk=True).collect() != align.opcodes(junk, "k").collect()
    assert len(rows(align.positions(ops.where("k = 1"), "k"))) == 5
    d = spark.createDataFrame([(1, 0), (1, 3), (1, 4)], "page long, j1 int")
    s = spark.createDataFrame([(1, 7, 0, 3), (1, 8, 3, 5)], "page long, unit_id long, start int, size int")
    assert rows(align.owners(d, s)) == [(1, 0, None, None), (1, 3, 7, 3), (1, 4, 8, 1)]


def box(page, i, text, x, y):
    return (page, i, text, x, y, x + 0.05, y + 0.01)


def test_geometry(spark):
    schema = "page long, token_index int, text string, x1 double, y1 double, x2 double, y2 double"
    t = spark.createDataFrame([box(1, 0, "b", 0.1, 0.1), box(1, 1, "a", 0.8, 0.104), box(1, 2, "c", 0.8, 0.2), box(2, 0, "c", 0.5, 0.1)], schema)
    order = {(r["page"], r["text"]): (r["line"], r["rank"]) for r in geometry.reading_order(t).collect()}
    assert order == {(1, "a"): (0, 0), (1, "b"): (0, 1), (1, "c"): (1, 2), (2, "c"): (0, 0)}
    assert geometry.overlapping_lines(t).where("page = 1").select("line").distinct().count() == 2
    m = spark.createDataFrame([(1, 1, 0.1, "p", "ok", True), (2, 1, 0.15, "p", "marker_not_found_in_window", True), (3, 3, 0.2, "p", "ok", False), (4, 3, 0.3, "p", "ok", True)], "unit_id long, page long, y double, part string, status string, trusted boolean")
    s = geometry.starts(m)
    assert rows(s.select("unit_id", "next_page")) == [(1, 3), (4, None)]
    assert rows(geometry.continuations(s)) == [(1, 2), (1, 3)]
    assert geometry.in_band(s, t).count() == 3
    r = spark.createDataFrame([(1, 1, 0.0, 0.0, 1.0, 0.5), (1, 2, 0.0, 0.4, 1.0, 0.9)], "page long, unit_id long, rx1 double, ry1 double, rx2 double, ry2 double")
    assert [x["ry2"] for x in sorted(geometry.trim_overlaps(r).collect(), key=lambda x: x["unit_id"])] == [0.4, 0.9]
    assert geometry.contained(t, r.where("unit_id = 1")).count() == 3
    spots = spark.createDataFrame([(1, 1, "c", 0.9)], "spot long, page long, text string, share double")
    ranks = spark.createDataFrame([(1, "c", 0, 10), (1, "c", 8, 10), (1, "c", 10, 10)], "page long, text string, rank long, n long")
    assert rows(geometry.nearest_rank(spots, ranks)) == [(1, 8)]
    known = spark.createDataFrame([(1, 4, None), (1, 2, "x"), (1, 6, "y")], "page long, word_index long, value string")
    assert rows(geometry.first_neighbour(spark.createDataFrame([(1, 3), (1, 5)], "page long, word_index long"), known)) == [(1, 3, "x"), (1, 5, "y")]
    assert round(geometry.line_height(t).where("page = 1").first()["height"], 6) == 0.01
    assert geometry.insert_box(spark.createDataFrame([(1, 1), (1, 0)], "page long, token_index int"), t).where("x1 is null").count() == 0
    u = spark.createDataFrame([(1, 80), (2, 4)], "unit_id long, n_words long")
    c = geometry.coverage(u, spark.createDataFrame([(1, 2, 100), (2, 3, 0)], "first_id long, last_id long, tokens long"))
    assert rows(c.select("words", "unmeasured", "low")) == [(4, 1, False), (84, 0, True)]
    assert rows(geometry.catchwords(t, F.col("text") != "b")) == [(1, "c", True)]


def test_trace():
    def tok(page, rank, word, band=False):
        return {"page": page, "rank": rank, "index": rank * 10, "word": word, "in_band": band}

    words = "one two three four five six seven eight".split()
    unit = lambda i, e, f: {"unit_id": i, "exact": {e}, "near": {e.upper()}, "forms": [f]}
    page = [tok(1, 0, "a", True)] + [tok(1, k + 1, w) for k, w in enumerate(words)]
    more = [tok(2, 0, "b", True), tok(2, 1, "zzz"), tok(2, 2, "C", True)] + [tok(2, k + 3, w) for k, w in enumerate(reversed(words))]
    q = [tok(3, 0, "q", True)] + [tok(3, k + 1, w) for k, w in enumerate(words[::2] + words[1::2])]
    units = [unit(1, "a", words), unit(2, "b", []), unit(3, "c", words[::-1]), unit(4, "d", words[::2] + words[1::2]), unit(5, "e", words)]
    got = {r["unit_id"]: (r["status"], r["marker_position"], r["how"]) for r in trace.trace_part(units, page + more + q)}
    assert got[1] == ("ok", 0, "exact") and got[2] == ("marker_found_content_mismatch", 0, "positional")
    assert got[3] == ("ok", 20, "near") and got[4] == ("ok", 0, "anchored") and got[5][0] == "marker_not_found_in_window"


def test_title_order(spark):
    assert trace.isotonic([0, 0, 2, 1, 1, 2], 3) == [0, 0, 0, 1, 1, 2] and trace.isotonic([], 3) == []
    t = spark.createDataFrame([("p", 1, "alpha"), ("p", 2, "gamma"), ("p", 3, "beta"), ("p", 4, "bb"), ("p", 5, " "), ("p", 6, "9"), ("p", 7, None)], "part string, unit_id long, title string")
    assert rows(trace.title_order(t, "abcdefg")) == [("p", 2, "g", "a"), ("p", 6, "9", None)]


def test_validators(spark):
    u = spark.createDataFrame([(1, "א", "א text"), (2, "ג", "ב' text"), (3, "ג", "ג' x : ד"), (4, "ד", "ד y : ו"), (5, "ה", "ה")], "unit_id long, numeral string, text string")
    assert [r[0] for r in rows(validate.numerals(u))] == [2]
    assert rows(validate.next_markers(u, "א-ת")) == [(4, "ו", "ה")]
    assert rows(validate.foreign(spark.createDataFrame([(1, "ab1c!"), (2, None)], "doc_id long, text string"), "a-z")) == [(1, 2, "1"), (1, 4, "!")]
    assert rows(validate.spacing(spark.createDataFrame([(1, "a  b"), (2, "a b"), (3, "")], "doc_id long, text string"))) == [(1, 2, 3)]
    assert rows(validate.characters(spark.createDataFrame([(1, "(x"), (2, "א*) ב"), (3, "א")], "doc_id long, text string"))) == [(1, 1, 0, 1, 0)]
    e = spark.createDataFrame([(1, "abc", "abc def. x"), (2, "zzz", "abc. x")], "unit_id long, title string, text string")
    assert rows(validate.title_echo(e, (".",))) == [(2, "zzz", "abc")]
    assert validate.dense(spark.range(1, 6), "id").first()["is_dense"] and not validate.dense(spark.range(0, 5), "id").first()["is_dense"]
    f = lambda w: validate.furniture(F.lit(w), ("top", "page"))
    assert spark.range(1).select(f("Top"), f('t"op'), f("Google"), f("12"), f(".."), f("word")).first() == (True, False, True, True, True, False)


def test_views(spark):
    items = spark.createDataFrame([(1, 0, "ambiguous", 1), (1, 1, "current_text_confirmed", 1), (2, 0, "ai_flag", 2)], "unit_id long, word_index int, flag string, page long")
    done = spark.createDataFrame([(1, 0, "x", True)], "unit_id long, word_index int, chosen_text string, needs_revisit boolean")
    assert rows(serving.unit_rollup(items, done)) == [(1, 2, 1, 0, 1, 1, True), (2, 1, 0, 1, 0, 0, False)]
    assert serving.unit_view(1, items, items.where("false"), done).count() == 2
    r, a = spark.createDataFrame([(1, 5)], "unit_id long, page long"), spark.createDataFrame([(1, 9, True), (2, 7, True), (3, 8, False)], "unit_id long, matched_page long, trusted boolean")
    assert rows(serving.page_of(a, r, a)) == [(1, 5), (2, 7), (3, None)]
    assert rows(serving.units_on_page(7, a, spark.createDataFrame([(1, 7)], "unit_id long, page long"))) == [(1,), (2,)]


def test_files(spark, tmp_path):
    unit = {"unit_id": 1, "numeral": "א", "section": "s", "title": "t", "text": "x", "page": 3}
    (tmp_path / "bare.json").write_text(json.dumps([unit]))
    (tmp_path / "wrapped.json").write_text(json.dumps({"units": [unit | {"unit_id": 2}]}))
    paths = [str(tmp_path / n) for n in ("bare.json", "wrapped.json")]
    both = readers.corpus_parts(spark, paths)
    assert [r["unit_id"] for r in sorted(both.collect())] == [1, 2]
    try:
        readers.corpus_parts(spark, [paths[0], paths[0]])
        raise AssertionError
    except ValueError:
        pass
    assert readers.json_or_empty(spark, str(tmp_path / "none.json"), readers.UNIT).count() == 0
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/page_7.json").write_text(json.dumps([{"text": "a&b", "x1": 0.1, "y1": 0.1, "x2": 0.2, "y2": 0.2}, {"text": "c", "x1": 0.3, "y1": 0.1, "x2": 0.4, "y2": 0.2}]))
    t = readers.page_tokens(spark, str(tmp_path / "pages"))
    assert rows(t.select("page", "token_index", "text")) == [(7, 0, "a&b"), (7, 1, "c")]
    assert rows(readers.missing_pages(t, spark.createDataFrame([(7,), (8,)], "page long"))) == [(8,)]
    for kind in writers.LAYOUTS:
        xml.dom.minidom.parseString(writers.layout(t, kind).first()["xml"])
    assert 'HPOS="1000"' in writers.layout(t, "alto").first()["xml"]
    (tmp_path / "s.txt").write_text("=== U 3 (x)\nabc\ndef\n=== U 4\nghi\n")
    assert rows(readers.sections(spark, str(tmp_path / "s.txt"), r"=== U (\d+)")) == [(3, "abc\ndef"), (4, "ghi")]
    (tmp_path / "l.jsonl").write_text('{"seq": 1, "id": "a"}\n\n{"seq": 2, "id": "b"}\n')
    assert readers.ledger(spark, str(tmp_path / "l.jsonl")).count() == 2
    (tmp_path / "n.json").write_text(json.dumps({"a": ["x y", {"b": "z"}], "c": "w"}))
    assert rows(readers.nested_texts(spark, str(tmp_path / "n.json")).select("text")) == [("w",), ("x y",), ("z",)]
    writers.small_json(both.select("unit_id", "numeral").orderBy("unit_id"), str(tmp_path / "o.json"))
    assert json.loads((tmp_path / "o.json").read_text()) == [{"unit_id": 1, "numeral": "א"}, {"unit_id": 2, "numeral": "א"}]
    w = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "unit_id long, word_index int")
    b = spark.createDataFrame([(1, 0, 0.1, 0.1, 0.2, 0.2)], "unit_id long, word_index int, x1 double, y1 double, x2 double, y2 double")
    r = spark.createDataFrame([(1, 0.0, 0.0, 0.5, 0.5)], "unit_id long, x1 double, y1 double, x2 double, y2 double")
    assert [x[-1] for x in rows(writers.boxed(w, b, r))] == [0.2, 0.5, 1.0]


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("event_id").alias("seq"), "user_id", "event_type", "value")
    e.repartition(3).write.parquet(src)
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = s.writeStream.foreachBatch(stream.upsert(str(tmp_path / "view"), "user_id", "event_type")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    last = max((tmp_path / "view").iterdir(), key=lambda p: int(p.name[1:]))
    want = ledger.current(e, "user_id", "event_type")
    assert rows(spark.read.parquet(str(last)).select("user_id", "event_type", "seq", "value")) == rows(want.select("user_id", "event_type", "seq", "value"))


def test_containment_and_directions(spark):
    u = spark.createDataFrame([(1, "see no. 5 above and no. 9 below, the quick brown fox jumps over a lazy dog"), (7, "xthe quick brown fox jumps over a lazy dogs, no. 3 below")], "unit_id long, text string")
    c = spark.createDataFrame([(1, "the quick brown fox jumps over a lazy dog"), (2, "quick brown fox"), (3, "quick red fox"), (4, "the quick brown foxes jump over it")], "chunk_id long, text string")
    assert rows(validate.contained_elsewhere(c, u)) == [(1, 1), (1, 7), (2, 1), (2, 7)]
    assert rows(validate.directions(u, r"no\. (\d+) above", r"no\. (\d+) below")) == [(1, 5, "above"), (7, 3, "below")]


def test_repairs(spark):
    d = spark.createDataFrame([("שלוםי םבא שלום abc",)], "t string")
    assert d.select(T.repaired(F.col("t"), "מ", "ם")).first()[0] == "שלומי מבא שלום abc"
    assert d.select(T.replaced(F.col("t"), {"abc": "xyz", "של": "?"})).first()[0] == "שלוםי םבא שלום xyz"
    assert d.select(T.is_running_header(F.split("t", " "), "abc")).first()[0]


def test_long_pairs_are_aligned(spark):
    """20,001 words on a side: identical, and changed in places."""
    a = [f"w{i % 5003}" for i in range(20_001)]
    b = [*a[:700], "odd", *a[702:15_000], "new", *a[15_000:]]
    p = spark.createDataFrame([(1, a, a), (2, a, b), (3, ["x"] * 20_001, ["x"] * 20_001), (4, [], [])], "k int, a array<string>, b array<string>")
    ops = align.opcodes(p, "k").cache()
    got = {k: [tuple(r)[1:] for r in ops.where(F.col("k") == k).orderBy("i1", "j1").collect()] for k in (1, 2, 3, 4)}
    assert got[1] == got[3] == [("equal", 0, 20_001, 0, 20_001)] and got[4] == []
    assert got[2] == difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
    r = align.accuracy(ops, p.select(F.size("a").alias("n"))).first()
    assert (r["matched"], r["truth_words"]) == (60_001, 60_003)
