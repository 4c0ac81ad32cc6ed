"""The library's queries over the provided tables, each with DuckDB's SQL where SQL says the same.

The corpus under audit is what the largest source wrote, the independent reference what all others wrote; the
ledger is ``events`` (key user_id and event_type, order event_id); pages of words are documents laid out in
lines of twelve.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import align, detect, freq, geometry, ledger, tokens, trace, validate
from ..session import reachable
from ..streaming import ledger as stream
from . import serving

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

SPACE = r"[\t-\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
LETTERS = T.LATIN.letters
OWN = "src0"


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


def read(spark, sf, name):
    reachable(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark, sf):
    return read(spark, sf, "documents")


def placed(spark, sf):
    return tokens.positioned(docs(spark, sf), "doc_id", "text", "source", "lang")


def form():
    return T.letters(F.lower("word"), T.LATIN)


def evidence(spark, sf):
    """(form, own, other): how often the audited source and all others write a form.

    Both frequencies below come from this one aggregate; the condition asks for both columns, so that a query that uses
    the two of them shuffles the words once."""
    n = placed(spark, sf).select(form().alias("form"), (F.col("source") == OWN).alias("mine")).where("form <> ''")
    return n.groupBy("form").agg(F.count_if("mine").alias("own"), F.count_if(~F.col("mine")).alias("other")).where("own + other > 0")


def own(spark, sf):
    return evidence(spark, sf).where("own > 0").select("form", F.col("own").alias("n"))


def reference(spark, sf):
    return evidence(spark, sf).where("other > 0").select("form", F.col("other").alias("n"))


def trusted_forms(spark, sf):
    good = read(spark, sf, "labels").where("quality = 1").select("doc_id").distinct()
    return tokens.positioned(docs(spark, sf).join(good, "doc_id", "left_semi")).select(form().alias("form")).where("form <> ''").distinct()


def book(spark, sf):
    """Events as a ledger."""
    return read(spark, sf, "events").select(F.col("event_id").alias("seq"), F.col("event_id").alias("id"), "ts", F.col("user_id").alias("unit_id"), "event_type", "value")


def laid_out(spark, sf):
    """Words as tokens on pages: twelve to a line, right to left, lines a hundredth high."""
    i = F.col("word_index")
    line, col = F.floor(i / 12), i % 12
    return placed(spark, sf).select(F.col("doc_id").alias("page"), i.alias("token_index"), F.col("word").alias("text"), ((11 - col) * 0.08).alias("x1"), (line * 0.01 + (i % 3) * 0.0005).alias("y1"), ((11 - col) * 0.08 + 0.07).alias("x2"), (line * 0.01 + (i % 3) * 0.0005 + 0.008).alias("y2"))


W = rf"""w AS (
  SELECT doc_id, source, lang, unnest(range(len(ws))) AS word_index, unnest(ws) AS word
  FROM (SELECT doc_id, source, lang, list_filter(regexp_split_to_array(text, '{SPACE}'), lambda x: x <> '') AS ws FROM documents) q)"""
FORM = f"regexp_replace(lower(word), '[^{LETTERS}]', '', 'g')"
OWN_REF = f"""{W},
f AS (SELECT source = '{OWN}' AS mine, {FORM} AS form FROM w),
own AS (SELECT form, count(*) AS n FROM f WHERE mine AND form <> '' GROUP BY form),
ref AS (SELECT form, count(*) AS n FROM f WHERE NOT mine AND form <> '' GROUP BY form)"""
TRUSTED = f"""lex AS (SELECT DISTINCT {FORM} AS form FROM w WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND {FORM} <> '')"""
LAID = f"""{W},
tok AS (SELECT doc_id AS page, word_index AS token_index, word AS text, (11 - word_index % 12) * CAST(0.08 AS DOUBLE) AS x1,
  (word_index // 12) * CAST(0.01 AS DOUBLE) + (word_index % 3) * CAST(0.0005 AS DOUBLE) AS y1,
  (11 - word_index % 12) * CAST(0.08 AS DOUBLE) + CAST(0.07 AS DOUBLE) AS x2,
  (word_index // 12) * CAST(0.01 AS DOUBLE) + (word_index % 3) * CAST(0.0005 AS DOUBLE) + CAST(0.008 AS DOUBLE) AS y2 FROM w)"""


# normal forms


@query("n1_alnum_forms", rf"WITH {W} SELECT DISTINCT word, regexp_replace(word, '[^\p{{L}}\p{{N}}]', '', 'g') AS form FROM w")
def n1(spark, sf):
    return placed(spark, sf).select("word").distinct().withColumn("form", T.alnum(F.col("word")))


@query("n2_letters_per_document", f"WITH {W} SELECT doc_id, sum(length({FORM})) AS letters FROM w GROUP BY doc_id")
def n2(spark, sf):
    return placed(spark, sf).groupBy("doc_id").agg(F.sum(F.length(form())).alias("letters"))


@query("n4_numerals", """
WITH c AS (SELECT c_custkey AS n FROM customer),
p AS (SELECT n, replace(repeat('ת', CAST(n // 400 AS INTEGER)) || substr(' קרש', CAST(n % 400 // 100 + 1 AS INTEGER), 1)
  || CASE WHEN n % 100 IN (15, 16) THEN 'ט' ELSE substr(' יכלמנסעפצ', CAST(n % 100 // 10 + 1 AS INTEGER), 1) END
  || CASE n % 100 WHEN 15 THEN 'ו' WHEN 16 THEN 'ז' ELSE substr(' אבגדהוזחט', CAST(n % 10 + 1 AS INTEGER), 1) END, ' ', '') AS s FROM c)
SELECT n, CASE WHEN length(s) > 1 THEN substr(s, 1, length(s) - 1) || translate(right(s, 1), 'נפצ', 'ןףץ') ELSE s END AS numeral FROM p""")
def n4(spark, sf):
    return read(spark, sf, "customer").select(F.col("c_custkey").alias("n"), T.numeral(F.col("c_custkey")).alias("numeral"))


@query("n5_numeral_values", """
WITH l AS (SELECT unnest(['א','ב','ג','ד','ה','ו','ז','ח','ט','י','כ','ל','מ','נ','ס','ע','פ','צ','ק','ר','ש','ת']) AS c,
  unnest([1,2,3,4,5,6,7,8,9,10,20,30,40,50,60,70,80,90,100,200,300,400]) AS v),
c AS (SELECT c_custkey AS n FROM customer),
p AS (SELECT n, replace(repeat('ת', CAST(n // 400 AS INTEGER)) || substr(' קרש', CAST(n % 400 // 100 + 1 AS INTEGER), 1)
  || CASE WHEN n % 100 IN (15, 16) THEN 'ט' ELSE substr(' יכלמנסעפצ', CAST(n % 100 // 10 + 1 AS INTEGER), 1) END
  || CASE n % 100 WHEN 15 THEN 'ו' WHEN 16 THEN 'ז' ELSE substr(' אבגדהוזחט', CAST(n % 10 + 1 AS INTEGER), 1) END, ' ', '') AS s FROM c),
q AS (SELECT n, CASE WHEN length(s) > 1 THEN substr(s, 1, length(s) - 1) || translate(right(s, 1), 'נפצ', 'ןףץ') ELSE s END AS s FROM p),
e AS (SELECT n, unnest(string_split(s, '')) AS c FROM q)
SELECT n, CAST(coalesce(sum(v), 0) AS INTEGER) AS value FROM e LEFT JOIN l USING (c) GROUP BY n""")
def n5(spark, sf):
    return n4(spark, sf).select("n", T.numeral_value(F.col("numeral")).alias("value"))


@query("n6_markup_words", rf"SELECT page_id, CAST(len(list_filter(regexp_split_to_array(regexp_replace(html, '<[^>]*>', ' ', 'g'), '{SPACE}'), lambda x: x <> '')) AS INTEGER) AS n_words FROM pages")
def n6(spark, sf):
    return read(spark, sf, "pages").select("page_id", F.size(T.words(T.without_markup(F.col("html")))).alias("n_words"))


@query("n7_folded_texts")
def n7(spark, sf):
    return docs(spark, sf).select("doc_id", T.folded("text").alias("text"))


@query("n12_openings", "SELECT doc_id, trim(substr(text, 1, least(CASE WHEN instr(text, '. ') > 0 THEN instr(text, '. ') ELSE length(text) + 1 END, CASE WHEN instr(text, ',') > 0 THEN instr(text, ',') ELSE length(text) + 1 END, CASE WHEN instr(text, chr(10)) > 0 THEN instr(text, chr(10)) ELSE length(text) + 1 END) - 1)) AS opening FROM documents")
def n12(spark, sf):
    return docs(spark, sf).select("doc_id", T.opening(F.col("text"), (". ", ",", "\n")).alias("opening"))


@query("n15_event_properties", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def n15(spark, sf):
    return read(spark, sf, "events").select("event_id", T.lenient_json(F.col("props"), {"k": "bigint"})["k"].alias("k"))


# frequencies


@query("g1_word_frequency", f"WITH {W} SELECT word AS form, count(*) AS n FROM w WHERE NOT regexp_matches(word, '[\"''׳״]') GROUP BY word")
def g1(spark, sf):
    return freq.frequency(placed(spark, sf).where(~T.is_abbreviation(F.col("word"))), F.col("word"))


@query("g2_form_summary", f"WITH {W}, f AS (SELECT {FORM} AS form, count(*) AS n FROM w GROUP BY 1 HAVING {FORM} <> '') SELECT CAST(sum(n) AS BIGINT) AS total_words, count(*) AS unique_forms, count(*) FILTER (WHERE n = 1) AS hapax_count FROM f")
def g2(spark, sf):
    return freq.summary(freq.frequency(placed(spark, sf), form()))


@query("g3_words_by_source", f"WITH {W}, f AS (SELECT source, {FORM} AS form FROM w) SELECT source, count(*) FILTER (WHERE form <> '') AS total_words, count(DISTINCT form) FILTER (WHERE form <> '') AS unique_forms FROM f GROUP BY source UNION ALL SELECT NULL, count(*), count(DISTINCT form) FROM f WHERE form <> ''")
def g3(spark, sf):
    return freq.by_book(placed(spark, sf), form(), "source")


@query("g4_spread_forms", f"WITH {W}, f AS (SELECT doc_id, {FORM} AS form FROM w) SELECT form, count(DISTINCT doc_id) AS n_units, count(*) AS n, string_agg(DISTINCT CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS unit_ids FROM f WHERE length(form) >= 6 GROUP BY form HAVING count(DISTINCT doc_id) >= 3".replace("string_agg(DISTINCT CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id)", "array_to_string(list_sort(list_distinct(list(doc_id))), ',')"))
def g4(spark, sf):
    return freq.spread(placed(spark, sf), form(), "doc_id", 3, 6)


@query("g6_unknown_forms", f"WITH {W}, {TRUSTED}, f AS (SELECT *, {FORM} AS form FROM w), u AS (SELECT * FROM f WHERE form <> '' AND form NOT IN (SELECT form FROM lex)) SELECT form, count(*) AS occurrences, count(DISTINCT doc_id) AS n_units, count(DISTINCT word) AS n_surfaces, min(doc_id) AS first_unit, arg_min(word_index, doc_id * 1000000 + word_index) AS first_index FROM u GROUP BY form")
def g6(spark, sf):
    return freq.unknown(placed(spark, sf), form(), trusted_forms(spark, sf), "doc_id")


@query("v5_lexicon_coverage", f"WITH {W}, {TRUSTED}, f AS (SELECT {FORM} AS form, count(*) AS n FROM w GROUP BY 1 HAVING {FORM} <> '') SELECT count(*) AS forms, count(*) FILTER (WHERE form IN (SELECT form FROM lex)) AS known, CAST(sum(n) AS BIGINT) AS words, CAST(coalesce(sum(n) FILTER (WHERE form IN (SELECT form FROM lex)), 0) AS BIGINT) AS known_words, count(*) FILTER (WHERE n = 1) AS hapax FROM f")
def v5(spark, sf):
    f = freq.frequency(placed(spark, sf), form()).join(trusted_forms(spark, sf).withColumn("k", F.lit(1)), "form", "left")
    return f.agg(F.count(F.lit(1)).alias("forms"), F.count("k").alias("known"), F.sum("n").alias("words"), F.coalesce(F.sum(F.when(F.col("k") == 1, F.col("n"))), F.lit(0)).alias("known_words"), F.count_if(F.col("n") == 1).alias("hapax"))


@query("c14_lexicon_attestation", f"WITH {OWN_REF}, {TRUSTED} SELECT count(*) AS lexicon_forms, count(*) FILTER (WHERE n > 0) AS attested, count(*) FILTER (WHERE n IS NULL) AS unattested FROM lex LEFT JOIN ref USING (form)")
def c14(spark, sf):
    return freq.attestation(trusted_forms(spark, sf), reference(spark, sf))


@query("o2_frequent_words_by_language", f"WITH {W}, f AS (SELECT lang, word, count(*) AS n FROM w GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM f) SELECT lang, CAST(rank AS INTEGER) AS rank, word, n FROM r WHERE rank <= 20")
def o2(spark, sf):
    from pyspark.sql import Window

    f = placed(spark, sf).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return f.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where("rank <= 20").select("lang", "rank", "word", "n")


# neighbours


@query("w1_repeated_words", rf"WITH {W}, x AS (SELECT doc_id, word_index, word, regexp_replace(word, '[^\p{{L}}\p{{N}}]', '', 'g') AS n FROM w), y AS (SELECT *, lead(n) OVER (PARTITION BY doc_id ORDER BY word_index) AS nx FROM x) SELECT doc_id, CAST(word_index AS INTEGER) AS word_index, word FROM y WHERE n = nx AND n <> ''")
def w1(spark, sf):
    return tokens.plain_repeats(docs(spark, sf)).select("doc_id", "word_index", "word")


@query("w2_contexts", rf"WITH {W}, x AS (SELECT doc_id, word_index, regexp_replace(word, '[^\p{{L}}\p{{N}}]', '', 'g') AS n FROM w), y AS (SELECT *, lead(n) OVER (PARTITION BY doc_id ORDER BY word_index) AS nx FROM x), s AS (SELECT doc_id, list(word ORDER BY word_index) AS ws FROM w GROUP BY doc_id) SELECT doc_id, CAST(word_index AS INTEGER) AS word_index, array_to_string(ws[greatest(word_index - 3, 0) + 1 : least(word_index + 5, len(ws))], ' ') AS context FROM y JOIN s USING (doc_id) WHERE n = nx AND n <> ''")
def w2(spark, sf):
    return tokens.context(placed(spark, sf), w1(spark, sf).select("doc_id", "word_index"), 3, 5).select("doc_id", "word_index", "context")


GRAMS = f"""s AS (SELECT doc_id, list(word ORDER BY word_index) AS ws FROM w GROUP BY doc_id HAVING count(*) >= 10),
g AS (SELECT doc_id, unnest(range(len(ws) - 9)) AS position, unnest(list_transform(range(1, len(ws) - 8), lambda i: array_to_string(ws[i : i + 9], ' '))) AS gram FROM s)"""


@query("w7_repeated_passages", f"WITH {W}, {GRAMS}, f AS (SELECT doc_id, gram, min(position) AS first_position FROM g GROUP BY ALL) SELECT doc_id, gram, CAST(first_position AS INTEGER) AS first_position, CAST(position AS INTEGER) AS position FROM g JOIN f USING (doc_id, gram) WHERE position - first_position >= 10")
def w7(spark, sf):
    return tokens.repeated_grams(docs(spark, sf), 10)


@query("j14_passages_shared_with_next", f"WITH {W}, {GRAMS}, d AS (SELECT DISTINCT doc_id, gram FROM g), o AS (SELECT doc_id, lead(doc_id) OVER (ORDER BY doc_id) AS next_id FROM (SELECT DISTINCT doc_id FROM documents) q) SELECT o.doc_id, o.next_id, d.gram FROM o JOIN d USING (doc_id) JOIN d e ON e.doc_id = o.next_id AND e.gram = d.gram")
def j14(spark, sf):
    return tokens.shared_with_next(docs(spark, sf), 10)


# detectors


def dominant(cands: str, ratio: int = 5) -> str:
    return f"""r AS (SELECT *, row_number() OVER (PARTITION BY form ORDER BY m DESC, candidate) AS k, lead(m) OVER (PARTITION BY form ORDER BY m DESC, candidate) AS second, count(*) OVER (PARTITION BY form) AS options FROM {cands})
SELECT form, n AS own_n, candidate, m AS candidate_n, CAST(options AS INTEGER) AS n_options, CASE WHEN second IS NOT NULL AND m <= {ratio} * second THEN 'ambiguous' ELSE 'high_confidence' END AS verdict FROM r WHERE k = 1"""


BLANK = "unnest(list_transform(range(1, length(form) + 1), lambda i: {'at': i, 'letter': substr(form, CAST(i AS BIGINT), 1), 'key': substr(form, 1, CAST(i - 1 AS BIGINT)) || '#' || substr(form, CAST(i + 1 AS BIGINT))}))"
DROP = "unnest(list_transform(range(1, length(form) + 1), lambda i: {'at': i, 'letter': substr(form, CAST(i AS BIGINT), 1), 'key': substr(form, 1, CAST(i - 1 AS BIGINT)) || substr(form, CAST(i + 1 AS BIGINT))}))"
PAIRS = "[" + ", ".join(f"'{p}', '{p[::-1]}'" for p in T.LATIN.pairs) + "]"


@query("c3_substitutions", f"""WITH {OWN_REF},
a AS (SELECT form, n, {BLANK} AS b FROM own WHERE n <= 3 AND form NOT IN (SELECT form FROM ref)),
z AS (SELECT form AS candidate, n AS m, {BLANK} AS b FROM ref WHERE n > 10),
c AS (SELECT DISTINCT a.form, a.n, z.candidate, z.m FROM a JOIN z ON a.b.key = z.b.key WHERE list_contains({PAIRS}, a.b.letter || z.b.letter)), {dominant('c')}""")
def c3(spark, sf):
    return detect.substitutions(own(spark, sf), reference(spark, sf), T.LATIN, most=3, over=10)


@query("c4_insertions_deletions", f"""WITH {OWN_REF},
rare AS (SELECT form, n FROM own WHERE n <= 2 AND length(form) >= 4 AND form NOT IN (SELECT form FROM ref)),
strong AS (SELECT form, n FROM ref WHERE n >= 20),
z AS (SELECT form AS candidate, n AS m, {DROP} AS b FROM strong),
y AS (SELECT form, n, {DROP} AS b FROM rare),
c AS (SELECT rare.form, rare.n, candidate, m FROM rare JOIN z ON rare.form = z.b.key WHERE instr('{T.LATIN.alphabet}', z.b.letter) > 0
  UNION SELECT y.form, y.n, strong.form, strong.n FROM y JOIN strong ON y.b.key = strong.form WHERE length(y.b.key) >= 2), {dominant('c')}""")
def c4(spark, sf):
    return detect.insertions_deletions(own(spark, sf), reference(spark, sf), T.LATIN, most=2, least=20)


@query("c1_dropped_letters", f"""WITH {OWN_REF},
e AS (SELECT DISTINCT form, n, unnest(list_transform(list_filter(range(1, length(form) + 1), lambda i: substr(form, CAST(i AS BIGINT), 1) = 't'), lambda i: substr(form, 1, CAST(i AS BIGINT)) || 'h' || substr(form, CAST(i + 1 AS BIGINT)))) AS candidate FROM own),
c AS (SELECT e.form, e.n, candidate, o.n AS m FROM e JOIN own o ON o.form = e.candidate)
SELECT form, n AS own_n, min(candidate) AS candidate, min(m) AS candidate_n, 'ambiguous' AS verdict FROM c GROUP BY form, n HAVING count(*) = 1 AND min(m) > n""")
def c1(spark, sf):
    return detect.dropped_letter(own(spark, sf), "t", "h")


@query("c2_fused_first_letters", f"WITH {OWN_REF} SELECT a.form, a.n AS own_n, b.form AS candidate, b.n AS candidate_n FROM own a JOIN own b ON b.form = substr(a.form, 2) WHERE a.form LIKE 'll%' AND length(a.form) > 2 AND b.n > a.n")
def c2(spark, sf):
    return detect.fused_first_letter(own(spark, sf), "l")


@query("c5_merged_words", f"""WITH {OWN_REF},
rare AS (SELECT form, n FROM own WHERE n <= 2 AND length(form) >= 7 AND form NOT IN (SELECT form FROM ref)),
e AS (SELECT form, n, unnest(range(3, length(form) - 2)) AS cut FROM rare),
c AS (SELECT e.form, e.n, cut, l.form AS lf, l.n AS ln, r.form AS rf, r.n AS rn FROM e JOIN ref l ON l.form = substr(e.form, 1, cut) JOIN ref r ON r.form = substr(e.form, cut + 1) WHERE l.n >= 20 AND r.n >= 20),
k AS (SELECT *, row_number() OVER (PARTITION BY form ORDER BY least(ln, rn) DESC, cut) AS o FROM c)
SELECT form, n AS own_n, lf AS left, ln AS left_n, rf AS right, rn AS right_n FROM k WHERE o = 1""".replace(" AS left,", ' AS "left",').replace(" AS right,", ' AS "right",'))
def c5(spark, sf):
    return detect.merged(own(spark, sf), reference(spark, sf), most=2, least=20)


@query("c6_split_words", f"""WITH {OWN_REF},
x AS (SELECT doc_id, word_index, {FORM} AS a, lead({FORM}) OVER (PARTITION BY doc_id ORDER BY word_index) AS b FROM w WHERE source = '{OWN}'),
p AS (SELECT * FROM x WHERE length(a) BETWEEN 1 AND 5 AND length(b) BETWEEN 1 AND 5)
SELECT doc_id, CAST(word_index AS INTEGER) AS word_index, a AS "left", b AS "right", a || b AS form, r.n AS joined_n FROM p JOIN ref r ON r.form = a || b JOIN own l ON l.form = a JOIN own q ON q.form = b WHERE r.n >= 3 AND NOT (l.n > 100 AND q.n > 100)""")
def c6(spark, sf):
    mine = placed(spark, sf).where(F.col("source") == OWN)
    return detect.split(mine, form(), own(spark, sf), reference(spark, sf), letters=5, often=100, least=3)


@query("c7_across_documents", f"""WITH {OWN_REF}, {TRUSTED},
x AS (SELECT doc_id, {FORM} AS form FROM w WHERE source = '{OWN}')
SELECT form, count(DISTINCT doc_id) AS n_units, count(*) AS n, form IN (SELECT form FROM lex) AS in_lexicon FROM x WHERE length(form) >= 3 AND form NOT IN (SELECT form FROM ref) GROUP BY form HAVING count(DISTINCT doc_id) >= 3""")
def c7(spark, sf):
    mine = placed(spark, sf).where(F.col("source") == OWN)
    return detect.across_units(mine, form(), reference(spark, sf), trusted_forms(spark, sf))


@query("c8_gap_triage", f"""WITH {OWN_REF}, {TRUSTED},
g AS (SELECT form, n AS occurrences, coalesce(ref.n, 0) AS attested FROM own LEFT JOIN ref USING (form) WHERE form NOT IN (SELECT form FROM lex)),
g2 AS (SELECT own.form, own.n AS occurrences, coalesce(ref.n, 0) AS attested FROM own LEFT JOIN ref ON ref.form = own.form WHERE own.form NOT IN (SELECT form FROM lex)),
bare AS (SELECT form FROM g2 WHERE attested = 0),
sure AS (SELECT form, n FROM ref WHERE n >= 10),
a AS (SELECT form, {BLANK} AS b FROM bare), z AS (SELECT form, n, {BLANK} AS b FROM sure),
ad AS (SELECT form, {DROP} AS b FROM bare), zd AS (SELECT form, n, {DROP} AS b FROM sure),
near AS (
  SELECT a.form, z.form AS candidate, z.n AS m, list_contains({PAIRS}, a.b.letter || z.b.letter) AS confusable FROM a JOIN z ON a.b.key = z.b.key WHERE a.b.letter <> z.b.letter
  UNION ALL SELECT bare.form, zd.form, zd.n, false FROM bare JOIN zd ON bare.form = zd.b.key WHERE instr('{T.LATIN.alphabet}', zd.b.letter) > 0
  UNION ALL SELECT ad.form, sure.form, sure.n, false FROM ad JOIN sure ON ad.b.key = sure.form),
nb AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY form ORDER BY confusable DESC, m DESC, candidate DESC) = 1),
sh AS (SELECT DISTINCT form, unnest(list_transform(list_filter(range(1, length(form) + 1), lambda i: substr(form, CAST(i AS BIGINT), 1) = 't'), lambda i: substr(form, 1, CAST(i AS BIGINT)) || 'h' || substr(form, CAST(i + 1 AS BIGINT)))) AS target FROM g2),
st AS (SELECT sh.form, sh.target FROM sh JOIN ref ON ref.form = sh.target WHERE ref.n >= 50 QUALIFY row_number() OVER (PARTITION BY sh.form ORDER BY ref.n DESC, sh.target DESC) = 1),
fe AS (SELECT form, unnest(range(2, length(form) - 1)) AS cut FROM bare WHERE length(form) >= 5),
fu AS (SELECT DISTINCT fe.form FROM fe JOIN ref l ON l.form = substr(fe.form, 1, cut) JOIN ref r ON r.form = substr(fe.form, cut + 1) WHERE l.n >= 500 AND r.n >= 500)
SELECT g2.form, occurrences, attested, nb.candidate AS neighbour, coalesce(nb.confusable, false) AS confusable, CAST(NULL AS VARCHAR) AS root, st.target, fu.form IS NOT NULL AS parts,
  CASE WHEN coalesce(nb.confusable, false) AND attested = 0 THEN 'ocr_shape_to_read' WHEN attested >= 25 THEN 'independently_attested' WHEN attested > 0 THEN 'weakly_attested' ELSE 'unresolved' END AS bucket,
  CAST(CASE WHEN attested = 0 THEN 3 WHEN attested < 25 THEN 1 ELSE 0 END + 2 + CASE WHEN occurrences = 1 THEN 1 ELSE 0 END + CASE WHEN st.target IS NOT NULL THEN 3 ELSE 0 END
    + CASE WHEN nb.form IS NULL THEN 0 WHEN nb.confusable THEN 3 ELSE 2 END + CASE WHEN fu.form IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN length(g2.form) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS score
FROM g2 LEFT JOIN nb ON nb.form = g2.form LEFT JOIN st ON st.form = g2.form LEFT JOIN fu ON fu.form = g2.form""")
def c8(spark, sf):
    o = own(spark, sf)
    gaps = o.join(trusted_forms(spark, sf), "form", "left_anti").select("form", F.col("n").alias("occurrences"), F.lit(False).alias("all_quoted"))
    return detect.triage(gaps, trusted_forms(spark, sf), reference(spark, sf), T.LATIN, neighbour=10)


# validators


@query("v2_foreign_characters", "WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS character, unnest(range(length(text))) AS position FROM documents) SELECT doc_id, CAST(position AS INTEGER) AS position, character FROM c WHERE regexp_matches(character, '[$%&#*]')")
def v2(spark, sf):
    return validate.foreign(docs(spark, sf), r"^$%&#*").select("doc_id", "position", "character")


@query("v2_character_counts", r"""WITH c AS (SELECT doc_id, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits, length(regexp_replace(text, '[^(]', '', 'g')) - (length(regexp_replace(text, '[^)]', '', 'g')) - len(regexp_extract_all(text, '\*+\s*\)'))) AS parens, length(regexp_replace(text, '[^\[]', '', 'g')) - length(regexp_replace(text, '[^\]]', '', 'g')) AS brackets FROM documents)
SELECT doc_id, CAST(digits AS INTEGER) AS digits, CAST(parens AS INTEGER) AS parens, CAST(brackets AS INTEGER) AS brackets FROM c WHERE digits > 0 OR parens <> 0 OR brackets <> 0""")
def v2b(spark, sf):
    return validate.characters(docs(spark, sf), latin=r"[^\x00-\x{10FFFF}]").drop("latin")


@query("v_spacing", rf"WITH c AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '{SPACE}'), lambda x: x <> '') AS a, string_split(text, ' ') AS b FROM documents WHERE text <> '') SELECT doc_id, CAST(len(a) AS INTEGER) AS n_words, CAST(len(b) AS INTEGER) AS n_spaced FROM c WHERE a <> b")
def vs(spark, sf):
    return validate.spacing(docs(spark, sf))


@query("v_dense_ids", "SELECT min(p_partkey) AS lo, max(p_partkey) AS hi, count(*) AS n, count(DISTINCT p_partkey) AS d, min(p_partkey) = 1 AND max(p_partkey) = count(*) AND count(*) = count(DISTINCT p_partkey) AS is_dense FROM part")
def vd(spark, sf):
    return validate.dense(read(spark, sf, "part"), "p_partkey")


@query("g14_accounting", "WITH d AS (SELECT DISTINCT doc_id FROM labels) SELECT (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM d)) AS measured, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM d)) AS unmeasured, (SELECT count(*) FROM documents) AS eligible, true AS holds")
def g14(spark, sf):
    d, k = docs(spark, sf).select("doc_id"), read(spark, sf, "labels").select("doc_id").distinct()
    return validate.accounted(d.join(k, "doc_id", "left_semi"), d.join(k, "doc_id", "left_anti"), d)


@query("j15_best_owner", f"""WITH c AS (SELECT DISTINCT conv_id, turn, unnest(list_filter(regexp_split_to_array(lower(text), '{SPACE}'), lambda x: x <> '')) AS w FROM conversations WHERE turn <= 1),
z AS (SELECT conv_id, turn, w, count(*) OVER (PARTITION BY conv_id, turn) AS n FROM c),
s AS (SELECT a.conv_id AS unit_id, b.conv_id AS owner, count(*) / CAST(any_value(a.n) + any_value(b.n) - count(*) AS DOUBLE) AS score FROM z a JOIN z b ON a.w = b.w AND a.conv_id <> b.conv_id AND a.turn = 0 AND b.turn = 1 GROUP BY ALL)
SELECT unit_id, owner, score FROM s QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY score DESC, owner) = 1""")
def j15(spark, sf):
    c = read(spark, sf, "conversations").select(F.col("conv_id").alias("unit_id"), "turn", T.words(F.lower("text")).alias("ws"))
    return validate.most_shared_words(c.where("turn = 0"), c.where("turn = 1"))


# ledger


@query("w3_current_decisions", "SELECT user_id AS unit_id, event_type, max(event_id) AS seq, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def w3(spark, sf):
    return ledger.current(book(spark, sf), "unit_id", "event_type").select("unit_id", "event_type", "seq", "value")


@query("w5_superseded_decisions", "WITH a AS (SELECT event_id AS id, user_id AS unit_id, event_type FROM events WHERE value > 50) SELECT id, unit_id, event_type, max(id) OVER (PARTITION BY unit_id, event_type ORDER BY id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) IS NOT NULL AS superseded FROM a")
def w5(spark, sf):
    b = book(spark, sf)
    return ledger.superseded(b, b.where("value > 50").select(F.col("id").alias("applied_id")), "unit_id", "event_type").select("id", "unit_id", "event_type", "superseded")


@query("j5_unapplied_decisions", "SELECT event_id AS id, user_id AS unit_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE value > 50)")
def j5(spark, sf):
    b = book(spark, sf)
    return ledger.unapplied(b, b.where("value > 50").select(F.col("id").alias("applied_id"))).select("id", "unit_id")


@query("j18_dangling_applications", "SELECT o_custkey AS applied_id, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)")
def j18(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_custkey").alias("applied_id"), "o_orderkey")
    return ledger.dangling(o, read(spark, sf, "events").select(F.col("user_id").alias("id")).distinct())


CLASS = """CASE WHEN op = 'replace' THEN CASE WHEN sel = 'A' THEN CASE WHEN conf >= 0.7 THEN 'current_text_may_be_wrong' ELSE 'ambiguous' END WHEN sel = 'B' THEN CASE WHEN conf >= 0.7 THEN 'current_text_confirmed' ELSE 'ambiguous' END WHEN sel = 'UNCERTAIN' THEN 'ambiguous' ELSE 'error' END
WHEN op = 'delete' THEN CASE WHEN sel = 'A' AND conf >= 0.7 THEN 'possible_omission' WHEN sel = 'ERROR' THEN 'error' ELSE 'ambiguous' END WHEN op = 'insert' THEN 'unverified_insertion' ELSE 'unverified' END"""
ITEMS = f"""i AS (SELECT event_id, user_id AS unit_id, event_id % 40 AS word_index, ['replace', 'delete', 'insert'][CAST(event_id % 3 + 1 AS INTEGER)] AS op, ['A', 'B', 'UNCERTAIN', 'ERROR'][CAST(event_id % 4 + 1 AS INTEGER)] AS sel, (event_id % 10) / 10.0 AS conf FROM events),
c AS (SELECT *, {CLASS} AS flag FROM i)"""


def items(spark, sf):
    """Events as candidates with a machine's verdict."""
    e, i = read(spark, sf, "events"), F.col("event_id")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (i % len(xs) + 1).cast("int"))
    return e.select(i, F.col("user_id").alias("unit_id"), (i % 40).alias("word_index"), ledger.classify(pick(["replace", "delete", "insert"]), pick(["A", "B", "UNCERTAIN", "ERROR"]), (i % 10) / 10.0).alias("flag"), "value")


@query("l3_candidate_flags", f"WITH {ITEMS} SELECT event_id, flag FROM c")
def l3(spark, sf):
    return items(spark, sf).select("event_id", "flag")


@query("g9_flag_histogram", f"WITH {ITEMS} SELECT flag, count(*) AS n FROM c GROUP BY flag")
def g9(spark, sf):
    return items(spark, sf).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


@query("q1_unit_rollup", f"""WITH {ITEMS}, d AS (SELECT DISTINCT user_id AS unit_id, event_id % 40 AS word_index FROM events WHERE value > 80),
s AS (SELECT c.unit_id, flag, d.unit_id IS NOT NULL AS decided, CASE WHEN d.unit_id IS NOT NULL THEN 'human' WHEN flag = 'current_text_confirmed' THEN 'machine' ELSE 'open' END AS state FROM c LEFT JOIN d USING (unit_id, word_index))
SELECT unit_id, count(*) AS total, count(*) FILTER (WHERE decided) AS decided, count(*) FILTER (WHERE state = 'open') AS open, count(*) FILTER (WHERE flag = 'ambiguous') AS disputed, count(*) FILTER (WHERE state = 'machine') AS machine, false AS needs_revisit FROM s GROUP BY unit_id""")
def q1(spark, sf):
    it = items(spark, sf)
    decided = it.where("value > 80").select("unit_id", "word_index").distinct().withColumn("needs_revisit", F.lit(False))
    return serving.unit_rollup(it, decided)


@query("u3_key_changes", "SELECT o_custkey AS k, 'new' AS change FROM (SELECT DISTINCT o_custkey FROM orders) q WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) UNION ALL SELECT user_id, 'stale' FROM (SELECT DISTINCT user_id FROM events) q WHERE user_id NOT IN (SELECT o_custkey FROM orders)")
def u3(spark, sf):
    a = read(spark, sf, "events").select(F.col("user_id").alias("k")).distinct()
    b = read(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct()
    return ledger.changes(a, b)


@query("u5_first_of_each_text", "SELECT md5(text) AS digest, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY md5(text)")
def u5(spark, sf):
    d = docs(spark, sf).select(F.md5("text").alias("digest"), "doc_id", "source")
    return ledger.first_seen(d, ("digest",), "doc_id").select("digest", "doc_id", "source")


# pages


@query("g7_line_boxes", f"WITH {LAID} SELECT page, token_index // 12 AS line, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS n FROM tok GROUP BY ALL")
def g7(spark, sf):
    return geometry.union_box(laid_out(spark, sf).withColumn("line", F.floor(F.col("token_index") / 12)), "page", "line")


@query("w9_reading_order", f"""WITH {LAID}, l AS (SELECT *, (y1 + y2) / 2 AS cy FROM tok), d AS (SELECT *, CASE WHEN cy - lag(cy) OVER (PARTITION BY page ORDER BY cy, token_index) > 0.008 THEN 1 ELSE 0 END AS nw FROM l),
s AS (SELECT *, sum(nw) OVER (PARTITION BY page ORDER BY cy, token_index ROWS UNBOUNDED PRECEDING) AS line FROM d)
SELECT page, token_index, CAST(line AS INTEGER) AS line, CAST(row_number() OVER (PARTITION BY page ORDER BY line, x2 DESC, token_index) - 1 AS INTEGER) AS rank FROM s""")
def w9(spark, sf):
    return geometry.reading_order(laid_out(spark, sf)).select("page", "token_index", "line", "rank")


@query("w15_catchwords", f"""WITH {LAID}, t AS (SELECT * FROM tok WHERE length(text) > 2), e AS (SELECT page, arg_max(text, token_index) AS catchword FROM t GROUP BY page),
r AS (SELECT page, text, row_number() OVER (PARTITION BY page ORDER BY token_index) AS k FROM t), h AS (SELECT page - 1 AS page, list(text) AS hs FROM r WHERE k <= 4 GROUP BY page)
SELECT page, catchword, list_contains(hs, catchword) AS found FROM e JOIN h USING (page)""")
def w15(spark, sf):
    return geometry.catchwords(laid_out(spark, sf), F.length("text") > 2)


@query("j11_contained_words", f"WITH {LAID} SELECT page, token_index, CAST(page AS BIGINT) AS unit_id FROM tok WHERE x1 >= 0.3 - 0.006 AND y1 >= 0.02 - 0.006 AND x2 <= 0.7 + 0.006 AND y2 <= 0.09 + 0.006")
def j11(spark, sf):
    region = docs(spark, sf).select(F.col("doc_id").alias("page"), F.col("doc_id").alias("unit_id"), F.lit(0.3).alias("rx1"), F.lit(0.02).alias("ry1"), F.lit(0.7).alias("rx2"), F.lit(0.09).alias("ry2"))
    return geometry.contained(laid_out(spark, sf), region).select("page", "token_index", "unit_id")


@query("j8_next_starts", "WITH m AS (SELECT event_id AS unit_id, event_id // 7 AS page, value / 100 AS y, event_type AS part, event_id % 3 <> 0 AS trusted FROM events WHERE value IS NOT NULL AND event_id % 4 <> 0), n AS (SELECT *, lead(page) OVER (PARTITION BY part ORDER BY unit_id) AS next_page FROM m) SELECT unit_id, part, page, next_page FROM n WHERE trusted")
def j8(spark, sf):
    i = F.col("event_id")
    m = read(spark, sf, "events").select(i.alias("unit_id"), F.floor(i / 7).alias("page"), (F.col("value") / 100).alias("y"), F.col("event_type").alias("part"), (i % 3 != 0).alias("trusted"), F.when(i % 4 == 0, "marker_not_found_in_window").otherwise("ok").alias("status"))
    return geometry.starts(m).select("unit_id", "part", "page", "next_page")


# sequences


def turn_pairs(spark, sf):
    """Each turn with the next turn of its conversation, as word arrays."""
    c = read(spark, sf, "conversations").select("conv_id", "turn", T.words(F.col("text")).alias("a"))
    return c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b")), ["conv_id", "turn"])


@query("a1_alignment")
def a1(spark, sf):
    return align.opcodes(turn_pairs(spark, sf), "conv_id", "turn")


@query("g11_alignment_accuracy")
def g11(spark, sf):
    p = turn_pairs(spark, sf)
    return align.accuracy(align.opcodes(p, "conv_id", "turn"), p.select(F.size("a").alias("n")))


@query("d2_order_of_openings")
def d2(spark, sf):
    t = docs(spark, sf).select(F.col("source").alias("part"), F.col("doc_id").alias("unit_id"), F.lower("text").alias("title"))
    return trace.title_order(t, T.LATIN.alphabet)


@query("j16_passages_in_documents", "SELECT item_id AS chunk_id, doc_id AS unit_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def j16(spark, sf):
    b = read(spark, sf, "benchmark").select(F.col("item_id").alias("chunk_id"), "text")
    return validate.contained_elsewhere(b, docs(spark, sf).select(F.col("doc_id").alias("unit_id"), "text"))


@query("w11_remaining_by_unit", "WITH c AS (SELECT event_type AS part, user_id AS unit_id, count(*) AS n FROM events GROUP BY ALL) SELECT part, unit_id, n, CAST(sum(n) OVER (PARTITION BY part ORDER BY unit_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS remaining FROM c")
def w11(spark, sf):
    c = read(spark, sf, "events").groupBy(F.col("event_type").alias("part"), F.col("user_id").alias("unit_id")).agg(F.count(F.lit(1)).alias("n"))
    return validate.remaining(c, "part", "unit_id", "n")


@query("g3_windowed_events", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def g3w(spark, sf):
    """The windowed aggregate of the streaming extension, run as a batch."""
    return stream.windowed(read(spark, sf, "events")).select("start", "event_type", "n")
