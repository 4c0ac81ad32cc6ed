from pyspark.sql import functions as F

from lectern.functions import text as T


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items())).select(column.alias("x")).first()[0]


def test_words_split_like_python(spark):
    for t in ["", "  a  b ", "a b", "a\u001cb\u0085c", "a​b", "\ta\nb\r\n", "x" * 10, "a.b ,c"]:
        assert one(spark, T.words(F.col("t")), t=t) == t.split()
    assert spark.sql("select cast(null as string) t").select(T.words(F.col("t"))).first()[0] == []


def test_normal_forms(spark):
    w = "אב\"ג-Xy9,é"
    assert one(spark, T.alnum(F.col("w")), w=w) == "אבגXy9é"
    assert one(spark, T.letters(F.col("w"), T.HEBREW), w=w) == "אבג"
    assert one(spark, T.is_abbreviation(F.col("w")), w=w) and not one(spark, T.is_abbreviation(F.col("w")), w="אב")
    assert one(spark, T.without_markup(F.col("w")), w="<b>שָׁ</b>לום") == " ש לום"


def test_numerals(spark):
    want = {1: "א", 15: "טו", 16: "טז", 20: "כ", 50: "נ", 115: "קטו", 120: "קכ", 150: "קן", 180: "קף", 190: "קץ", 220: "רכ", 500: "תק", 667: "תרסז", 800: "תת"}
    got = {r["n"]: (r["s"], r["v"]) for r in spark.createDataFrame([(n,) for n in want], "n long").select("n", T.numeral(F.col("n")).alias("s"), T.numeral_value(T.numeral(F.col("n"))).alias("v")).collect()}
    assert {n: s for n, (s, _) in got.items()} == want
    assert got[667][1] == 667 and got[150][1] == 100  # final letters count nothing


def test_folded(spark):
    assert one(spark, T.folded(F.col("t")), t="ﬁne “word”, (x)") == "fine word x"


def test_phrases(spark):
    assert one(spark, T.is_placeholder(F.col("t"), F.lit(7), "unit"), t="ז unit 7")
    assert not one(spark, T.is_placeholder(F.col("t"), F.lit(7), "unit"), t="ז unit 7 x")
    assert one(spark, T.opening(F.col("t"), (".", ":"), "[א-ת]+ "), t="ג abc: d. e") == "abc"
    assert one(spark, T.opening(F.col("t"), (".",)), t="no stop") == "no stop"
    assert one(spark, T.trailing_marker(F.col("t"), "א-ת"), t="text : קכ  ") == "קכ"
    assert one(spark, T.trailing_marker(F.col("t"), "א-ת"), t="text קכ") is None


def test_lenient_json(spark):
    c = T.lenient_json(F.col("t"), {"selected": "string", "confidence": "double"})
    for t in ['{"selected": "A", "confidence": 0.9}', '{"selected": "A\\d", "confidence": 0.9}', 'so: "selected": "A", "confidence": 0.9 ...']:
        r = one(spark, c, t=t)
        assert r["selected"][0] == "A" and r["confidence"] == 0.9
    assert one(spark, c, t="nothing")["selected"] is None


def test_notes_and_suggestions(spark):
    got = one(spark, T.notes(F.col("t"), r"(\d+)/(\d+): '(\w+)' -> '(\w+)'"), t="see 3/14: 'ab' -> 'ac'; 4/1: 'x' -> 'y'")
    assert [tuple(r) for r in got] == [(3, 14, "ab", "ac"), (4, 1, "x", "y")]
    assert one(spark, T.suggestion(F.col("t"), (r"read (\w+)", r"maybe (\w+)")), t="maybe this") == "this"
