"""More of the library's queries over the provided tables: text checks, page geometry, the ledger and the review views.

Where a query needs columns that no table has, it derives them from ids by arithmetic, and so does its SQL.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import text as T
from ..operators import align, apply, detect, freq, geometry, ledger, tokens, validate
from . import serving
from .registry import BLANK, FORM, LAID, SPACE, TRUSTED, W, docs, form, laid_out, placed, query, read, trusted_forms, turn_pairs  # noqa: F401

WORDS = f"list_filter(regexp_split_to_array(text, '{SPACE}'), lambda x: x <> '')"


def pick(by, *values):
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


# normal forms and phrases


PAGE_WORDS = f"w AS (SELECT page_id, unnest(range(len(ws))) AS word_index, unnest(ws) AS word FROM (SELECT page_id, list_filter(regexp_split_to_array(html, '{SPACE}'), lambda x: x <> '') AS ws FROM pages) q)"


def page_words(spark, sf):
    """Words of raw pages: their attributes hold the marks that abbreviations have."""
    return tokens.positioned(read(spark, sf, "pages"), "page_id", "html")


@query("n3_abbreviations", rf"WITH {PAGE_WORDS} SELECT word, count(*) AS n FROM w WHERE regexp_matches(word, '[\"''׳״]') GROUP BY word")
def n3(spark, sf):
    return page_words(spark, sf).where(T.is_abbreviation(F.col("word"))).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


HEADER = ("the", "de", "und")


@query("n9_furniture_rules", rf"""WITH {W}, c AS (SELECT word, count(*) AS n, lower(word) AS low, regexp_replace(lower(word), '[^\p{{L}}\p{{N}}]', '', 'g') AS bare FROM w GROUP BY word)
SELECT word, n, bare IN ('the', 'de', 'und') AS cleaned, word IN ('the', 'de', 'und') OR regexp_matches(word, '^[0-9]+$') AS exact,
(bare IN ('the', 'de', 'und') AND NOT regexp_matches(word, '["''׳״]')) OR regexp_matches(low, '^(digitized|by|google)$') OR regexp_matches(word, '^[0-9]+$') OR bare = '' AS pattern FROM c""")
def n9(spark, sf):
    c, w = freq.frequency(placed(spark, sf), F.col("word"), "word"), F.col("word")
    return c.select("word", "n", validate.furniture_cleaned(w, HEADER).alias("cleaned"), validate.furniture_exact(w, HEADER).alias("exact"), validate.furniture(w, HEADER).alias("pattern"))


@query("n9_furniture_segments", f"WITH {W}, s AS (SELECT doc_id, word_index // 3 AS run, bool_and(word IN ('the', 'de', 'und') OR regexp_matches(word, '^[0-9]+$')) AS furniture FROM w GROUP BY ALL) SELECT doc_id, CAST(count(*) FILTER (WHERE furniture) AS BIGINT) AS n FROM s GROUP BY doc_id")
def n9s(spark, sf):
    ws = T.words(F.col("text"))
    runs = docs(spark, sf).select("doc_id", ws.alias("ws")).where("size(ws) > 0").select("doc_id", F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.size("ws") - 1) / 3).cast("int")), lambda k: F.slice("ws", k * 3 + 1, 3))).alias("seg"))
    return runs.groupBy("doc_id").agg(F.count_if(validate.furniture_segment(F.col("seg"), HEADER)).alias("n"))


@query("n10_running_headers", f"SELECT doc_id, list_contains({WORDS}, 'the') AS has_header FROM documents")
def n10(spark, sf):
    return docs(spark, sf).select("doc_id", T.is_running_header(T.words(F.col("text")), "the").alias("has_header"))


@query("n11_placeholders", "SELECT c_custkey AS unit_id, c_custkey % 3 = 0 AS is_placeholder FROM customer")
def n11(spark, sf):
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, F.concat_ws(" ", "c_mktsegment", F.lit("unit"), k.cast("string"))).when(k % 3 == 1, F.concat_ws(" ", "c_mktsegment", F.lit("unit"), (k + 1).cast("string"))).otherwise(F.concat_ws("  ", "c_mktsegment", F.lit("unit"), k.cast("string")))
    return read(spark, sf, "customer").select(k.alias("unit_id"), T.is_placeholder(text, k, "unit").alias("is_placeholder"))


@query("n13_trailing_markers", r"WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE text || ': ' || lang || '  ' END AS text FROM documents) SELECT doc_id, nullif(regexp_extract(regexp_replace(text, '\s+$', ''), ':\s*([a-z]{1,4})$', 1), '') AS marker FROM t")
def n13(spark, sf):
    t = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.concat("text", F.lit(": "), "lang", F.lit("  ")))
    return docs(spark, sf).select("doc_id", T.trailing_marker(t, "a-z").alias("marker"))


@query("n14_replaced_words", r"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(text, '(^|[^\p{L}])the($|[^\p{L}])', '\1$THE\2', 'g'), '(^|[^\p{L}])the($|[^\p{L}])', '\1$THE\2', 'g') AS text FROM documents) SELECT doc_id, md5(text) AS digest FROM a""")
def n14(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.replaced(F.col("text"), {"the": "$THE"})).alias("digest"))


@query("n14_repaired_words", r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, 'm(\p{L})', 'n\1', 'g'), 'm(\p{L})', 'n\1', 'g')) AS digest FROM documents")
def n14r(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.repaired(F.col("text"), "n", "m")).alias("digest"))


@query("n16_suggestions", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN 'k' || user_id END AS suggested FROM events""")
def n16(spark, sf):
    i = F.col("event_id")
    note = F.when(i % 3 == 0, F.concat(F.lit('should read "'), "event_type", F.lit('" here'))).when(i % 3 == 1, F.concat(F.lit("perhaps k"), F.col("user_id").cast("string"), F.lit(", or not"))).otherwise("no idea")
    return read(spark, sf, "events").select("event_id", T.suggestion(note, ('read "([^"]*)"', "perhaps (\\w+)")).alias("suggested"))


@query("n17_noted_candidates", "SELECT event_id, CAST(u AS INTEGER) AS unit_id, CAST(u + 1 AS INTEGER) AS word_index, event_type AS original, 'x' || u AS candidate FROM (SELECT event_id, event_type, unnest([event_id % 50, event_id % 7]) AS u FROM events) q")
def n17(spark, sf):
    i = F.col("event_id")
    one = lambda u: F.concat(F.lit("unit "), u.cast("string"), F.lit(" word "), (u + 1).cast("string"), F.lit(': "'), "event_type", F.lit('" -> "x'), u.cast("string"), F.lit('"; '))
    found = T.notes(F.concat(one(i % 50), one(i % 7)), r'unit (\d+) word (\d+): "([^"]*)" -> "([^"]*)"')
    return read(spark, sf, "events").select("event_id", F.inline(found))


# pages

MARKERS = """m AS (SELECT event_id AS unit_id, event_id // 7 AS page, (event_id % 7) * CAST(0.05 AS DOUBLE) AS y, 'a' AS part, event_id % 3 <> 0 AS trusted FROM events WHERE event_id % 4 <> 0),
n AS (SELECT *, lead(page) OVER (ORDER BY unit_id) AS next_page, lead(y) OVER (ORDER BY unit_id) AS next_y FROM m)"""


def marked(spark, sf):
    i = F.col("event_id")
    m = read(spark, sf, "events").select(i.alias("unit_id"), F.floor(i / 7).alias("page"), ((i % 7) * F.lit(0.05)).alias("y"), F.lit("a").alias("part"), (i % 3 != 0).alias("trusted"), F.when(i % 4 == 0, "marker_not_found_in_window").otherwise("ok").alias("status"))
    return geometry.starts(m)


@query("j9_words_in_bands", f"WITH {LAID.replace('WITH ', '')}, {MARKERS} SELECT unit_id, n.page, token_index FROM n JOIN tok ON tok.page = n.page WHERE trusted AND (y1 + y2) / 2 >= y - 0.004 AND (next_page IS NULL OR next_page <> n.page OR (y1 + y2) / 2 < next_y - 0.004)")
def j9(spark, sf):
    return geometry.in_band(marked(spark, sf), laid_out(spark, sf)).select("unit_id", "page", "token_index")


@query("j10_continuations", f"WITH {MARKERS} SELECT unit_id, CAST(p AS BIGINT) AS page FROM (SELECT unit_id, unnest(generate_series(page + 1, next_page)) AS p FROM n WHERE trusted AND next_page > page) q")
def j10(spark, sf):
    return geometry.continuations(marked(spark, sf)).select("unit_id", "page")


@query("f1_trusted_pages", "SELECT event_id AS unit_id, event_id // 7 AS matched_page, event_id % 3 <> 0 AND event_id // 7 BETWEEN 20 AND 900 AS accepted FROM events")
def f1(spark, sf):
    i = F.col("event_id")
    a = read(spark, sf, "events").select(i.alias("unit_id"), F.floor(i / 7).alias("matched_page"), (i % 3 != 0).alias("trusted"))
    yes, no = geometry.trusted(a, 20, 900)
    return yes.withColumn("accepted", F.lit(True)).unionByName(no.withColumn("accepted", F.lit(False))).drop("trusted")


REGIONS = """r AS (SELECT event_id * 1 + event_id // 50 AS unit_id, event_id // 4 AS page, (event_id % 4) * CAST(0.2 AS DOUBLE) AS ry1, (event_id % 4) * CAST(0.2 AS DOUBLE) + CAST(0.1 AS DOUBLE) + (event_id % 5) * CAST(0.06 AS DOUBLE) AS ry2 FROM events)"""


@query("w12_trimmed_regions", f"WITH {REGIONS}, x AS (SELECT a.*, b.ry1 AS top FROM r a LEFT JOIN r b ON b.unit_id = a.unit_id + 1 AND b.page = a.page) SELECT unit_id, page, ry1, CASE WHEN ry2 > top THEN greatest(ry1 + CAST(0.002 AS DOUBLE), top - CAST(0.002 AS DOUBLE)) ELSE ry2 END AS ry2 FROM x")
def w12(spark, sf):
    i = F.col("event_id")
    top = (i % 4) * F.lit(0.2)
    r = read(spark, sf, "events").select((i + F.floor(i / 50)).alias("unit_id"), F.floor(i / 4).alias("page"), top.alias("ry1"), (top + F.lit(0.1) + (i % 5) * F.lit(0.06)).alias("ry2"))
    return geometry.trim_overlaps(r, 0.002)


@query("w8_page_offsets", f"WITH {LAID.replace('WITH ', '')}, c AS (SELECT page, count(*) AS n FROM tok GROUP BY page) SELECT page, n, CAST(coalesce(sum(n) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM c")
def w8(spark, sf):
    return geometry.page_offsets(laid_out(spark, sf).groupBy("page").agg(F.count(F.lit(1)).alias("n")), width=64)


@query("g12_line_heights", f"WITH {LAID.replace('WITH ', '')} SELECT page, list_sort(list(y2 - y1))[CAST(len(list(y2 - y1)) // 2 + 1 AS BIGINT)] AS height FROM tok GROUP BY page")
def g12(spark, sf):
    return geometry.line_height(laid_out(spark, sf))


@query("g13_x_bands", f"WITH {LAID.replace('WITH ', '')} SELECT page, min(x1) AS \"left\", max(x2) AS \"right\", count(*) AS n FROM tok GROUP BY page")
def g13(spark, sf):
    return geometry.x_band(laid_out(spark, sf))


@query("d3_insert_boxes", f"WITH {LAID.replace('WITH ', '')}, g AS (SELECT page, token_index FROM tok WHERE token_index % 11 = 0) SELECT g.page, CAST(g.token_index AS INTEGER) AS token_index, least(b.x1, a.x1) AS x1, least(b.y1, a.y1) AS y1, greatest(b.x2, a.x2) AS x2, greatest(b.y2, a.y2) AS y2 FROM g LEFT JOIN tok b ON b.page = g.page AND b.token_index = g.token_index - 1 LEFT JOIN tok a ON a.page = g.page AND a.token_index = g.token_index")
def d3(spark, sf):
    t = laid_out(spark, sf)
    return geometry.insert_box(t.where("token_index % 11 = 0").select("page", "token_index"), t)


SPOTS = "s AS (SELECT doc_id AS page, doc_id AS spot, CASE lang WHEN 'en' THEN 'the' ELSE 'de' END AS text, (doc_id % 10) / CAST(10 AS DOUBLE) AS share FROM documents)"


@query("j12_nearest_ranks", f"WITH {LAID.replace('WITH ', '')}, {SPOTS}, t AS (SELECT page, text, token_index AS rank, count(*) OVER (PARTITION BY page) AS n FROM tok), j AS (SELECT spot, rank, abs(rank - share * n) AS far FROM s JOIN t USING (page, text)) SELECT spot, CAST(rank AS INTEGER) AS rank FROM j QUALIFY row_number() OVER (PARTITION BY spot ORDER BY far, rank) = 1")
def j12(spark, sf):
    d = docs(spark, sf)
    spots = d.select(F.col("doc_id").alias("page"), F.col("doc_id").alias("spot"), F.when(F.col("lang") == "en", "the").otherwise("de").alias("text"), ((F.col("doc_id") % 10) / F.lit(10.0)).alias("share"))
    t = laid_out(spark, sf).select("page", "text", F.col("token_index").alias("rank"))
    n = t.groupBy("page").agg(F.count(F.lit(1)).alias("n"))
    return geometry.nearest_rank(spots, t.join(n, "page"))


@query("j13_first_neighbours", """WITH e AS (SELECT event_id % 97 AS page, event_id // 97 AS word_index, CASE WHEN event_id % 5 = 0 THEN event_id END AS value FROM events),
o AS (SELECT unnest([0, 1, 2, 3, 4, 5]) AS p, unnest([1, -1, 2, -2, 3, -3]) AS d), j AS (SELECT a.page, a.word_index, o.p, k.value FROM e a CROSS JOIN o JOIN e k ON k.page = a.page AND k.word_index = a.word_index + o.d AND k.value IS NOT NULL WHERE a.value IS NULL)
SELECT page, word_index, arg_min(value, p) AS value FROM j GROUP BY ALL""")
def j13(spark, sf):
    i = F.col("event_id")
    e = read(spark, sf, "events").select((i % 97).alias("page"), F.floor(i / 97).alias("word_index"), F.when(i % 5 == 0, i).alias("value"))
    return geometry.first_neighbour(e.where("value is null"), e)


@query("g8_span_coverage", f"""WITH {W}, u AS (SELECT doc_id AS unit_id, count(*) AS n_words FROM w GROUP BY doc_id), s AS (SELECT p_partkey AS first_id, p_partkey + p_size % 4 AS last_id, CAST(p_size * 40 AS BIGINT) AS tokens FROM part WHERE p_partkey < 500),
c AS (SELECT first_id, last_id, tokens, CAST(coalesce(sum(n_words), 0) AS BIGINT) AS words, count(*) FILTER (WHERE n_words IS NULL) AS unmeasured FROM (SELECT *, unnest(generate_series(first_id, last_id)) AS unit_id FROM s) q LEFT JOIN u USING (unit_id) GROUP BY ALL)
SELECT *, words / CAST(nullif(tokens, 0) AS DOUBLE) AS coverage, coalesce(words / CAST(nullif(tokens, 0) AS DOUBLE) < 0.85, false) AS low FROM c""")
def g8(spark, sf):
    u = docs(spark, sf).select(F.col("doc_id").alias("unit_id"), F.size(T.words(F.col("text"))).alias("n_words")).where("n_words > 0")
    return geometry.coverage(u, spans(spark, sf))


def spans(spark, sf):
    return read(spark, sf, "part").where("p_partkey < 500").select(F.col("p_partkey").alias("first_id"), (F.col("p_partkey") + F.col("p_size") % 4).alias("last_id"), (F.col("p_size") * 40).cast("long").alias("tokens"))


@query("g8_mean_coverage", f"""WITH {W}, u AS (SELECT doc_id AS unit_id, count(*) AS n_words FROM w GROUP BY doc_id), s AS (SELECT p_partkey AS first_id, p_partkey + p_size % 4 AS last_id, CAST(p_size * 40 AS BIGINT) AS tokens FROM part WHERE p_partkey < 500),
c AS (SELECT first_id, last_id, coalesce(sum(n_words), 0) / CAST(nullif(tokens, 0) AS DOUBLE) AS coverage FROM (SELECT *, unnest(generate_series(first_id, last_id)) AS unit_id FROM s) q LEFT JOIN u USING (unit_id) GROUP BY first_id, last_id, tokens)
SELECT first_id // 8 = last_id // 8 AS same_page, round(avg(coverage), 6) AS mean, count(*) AS n FROM c WHERE coverage IS NOT NULL GROUP BY 1""")
def g8m(spark, sf):
    c = g8(spark, sf).select("coverage", (F.floor(F.col("first_id") / 8) == F.floor(F.col("last_id") / 8)).alias("same_page"))
    return geometry.coverage_means(c).withColumn("mean", F.round("mean", 6))


@query("v7_unmeasured_spans", "WITH s AS (SELECT CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE (p_size % 5) * 10 END AS tokens, p_partkey AS f, p_partkey + p_size % 4 - 1 AS l, p_partkey % 7 = 0 AS m FROM part), r AS (SELECT CASE WHEN tokens IS NULL THEN 'no_end' WHEN tokens <= 0 THEN 'no_tokens' WHEN l < f THEN 'out_of_order' WHEN m THEN 'unit_missing' END AS reason FROM s) SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason")
def v7(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    s = read(spark, sf, "part").select(F.when(k % 9 != 0, (size % 5) * 10).alias("tokens"), k.alias("first_id"), (k + size % 4 - 1).alias("last_id"), (k % 7 == 0).cast("int").alias("unmeasured"))
    return geometry.unmeasured_reasons(s)


# frequencies and neighbours of words


@query("g5_abbreviations_by_page", rf"WITH {PAGE_WORDS}, f AS (SELECT page_id, word_index, {FORM} AS form FROM w WHERE regexp_matches(word, '[\"''׳״]')) SELECT form, page_id, count(*) AS n, CAST(min(word_index) AS INTEGER) AS first_index FROM f WHERE form <> '' GROUP BY form, page_id")
def g5(spark, sf):
    return freq.forms_by_unit(page_words(spark, sf).where(T.is_abbreviation(F.col("word"))), form(), "page_id")


@query("o1_sorted_spread", f"WITH {W}, f AS (SELECT {FORM} AS form, doc_id FROM w), s AS (SELECT form, count(DISTINCT doc_id) AS n_units, count(*) AS n FROM f WHERE length(form) >= 6 GROUP BY form) SELECT form, n_units, n, CAST(row_number() OVER (ORDER BY n_units DESC, n DESC, form) AS INTEGER) AS place FROM s ORDER BY place LIMIT 200")
def o1(spark, sf):
    s = placed(spark, sf).select(form().alias("form"), "doc_id").where(F.length("form") >= 6).groupBy("form", "doc_id").agg(F.count(F.lit(1)).alias("k")).groupBy("form").agg(F.count(F.lit(1)).alias("n_units"), F.sum("k").alias("n"))
    top = s.orderBy(F.desc("n_units"), F.desc("n"), "form").limit(200)  # the report's length; its order is then a small one
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n_units"), F.desc("n"), "form")))


@query("v3_title_clusters")
def v3(spark, sf):
    return validate.title_clusters(docs(spark, sf).select(F.col("doc_id").alias("unit_id"), T.opening(F.col("text"), (". ", "\n")).alias("title")))


# the ledger


@query("w4_history", "SELECT event_id AS id, event_type, value FROM events WHERE user_id = 7")
def w4(spark, sf):
    i = F.col("event_id")
    b = read(spark, sf, "events").select(i.alias("seq"), i.alias("id"), F.col("user_id").alias("unit_id"), "event_type", "value")
    return ledger.history(b, 7).select("id", "event_type", "value")


@query("j3_live_candidates", """WITH c AS (SELECT DISTINCT event_id % 300 AS unit_id, event_id % 4 AS opcode, event_id % 11 AS word_index, CASE WHEN event_id % 5 > 0 THEN event_type END AS a, CASE WHEN event_id % 3 > 0 THEN event_type END AS b FROM events WHERE event_id % 2 = 0),
d AS (SELECT event_id, event_id % 300 AS unit_id, event_id % 4 AS opcode, event_id % 11 AS word_index, CASE WHEN event_id % 5 > 0 THEN event_type END AS a, CASE WHEN event_id % 3 > 0 THEN event_type END AS b FROM events)
SELECT event_id FROM d WHERE EXISTS (SELECT 1 FROM c WHERE c.unit_id = d.unit_id AND c.opcode = d.opcode AND c.word_index = d.word_index AND c.a IS NOT DISTINCT FROM d.a AND c.b IS NOT DISTINCT FROM d.b)""")
def j3(spark, sf):
    i = F.col("event_id")
    d = read(spark, sf, "events").select("event_id", (i % 300).alias("unit_id"), (i % 4).alias("opcode"), (i % 11).alias("word_index"), F.when(i % 5 > 0, F.col("event_type")).alias("ocr_reading"), F.when(i % 3 > 0, F.col("event_type")).alias("stored_text"))
    return ledger.live(d, d.where("event_id % 2 = 0").drop("event_id")).select("event_id")


@query("j6_fresh_disputes", "SELECT event_id // 40 AS unit_id, event_id % 40 AS i FROM events WHERE value > 20 AND NOT (event_id % 3 = 0) AND NOT (event_id % 5 = 0 AND event_type IN ('click', 'view'))")
def j6(spark, sf):
    i = F.col("event_id")
    e = read(spark, sf, "events").select(F.floor(i / 40).alias("unit_id"), (i % 40).alias("i"), i.alias("k"), "value", F.col("event_type").alias("decision_type"))
    return align.fresh(e.where("value > 20").select("unit_id", "i"), e.where("k % 3 = 0"), e.where("k % 5 = 0"), "unit_id", types=("click", "view"))


@query("l2_flagged_units", "WITH g AS (SELECT user_id AS unit_id, max(event_id) AS seq, arg_max(value, event_id) AS v FROM events WHERE event_type = 'click' AND event_id % 3 > 0 GROUP BY 1) SELECT unit_id, seq FROM g WHERE v > 50")
def l2(spark, sf):
    i = F.col("event_id")
    b = read(spark, sf, "events").select(i.alias("seq"), F.col("user_id").alias("unit_id"), F.when(F.col("event_type") == "click", ledger.UNIT_FLAG).otherwise("other").alias("decision_type"), F.when(i % 3 == 0, 1).alias("word_index"), (F.col("value") > 50).alias("needs_revisit"), F.lit("").alias("note"))
    return ledger.flagged(b).select("unit_id", "seq")


CAND = f"""u AS (SELECT doc_id AS unit_id, {WORDS} AS ws FROM documents), e AS (SELECT event_id, event_id % 1200 AS unit_id, CAST(event_id % 31 - 1 AS INTEGER) AS word_index, ['replace', 'insert', 'delete'][CAST(event_id % 3 + 1 AS INTEGER)] AS opcode, CASE WHEN event_id % 7 < 3 THEN 'the' WHEN event_id % 7 = 3 THEN '' END AS stored_text FROM events),
c AS (SELECT e.*, ws, CASE WHEN coalesce(stored_text, '') = '' THEN 1 ELSE 1 END AS span FROM e LEFT JOIN u USING (unit_id)),
d AS (SELECT *, CASE WHEN ws IS NULL THEN true WHEN opcode IN ('replace', 'insert') THEN NOT (word_index >= 0 AND word_index + span <= len(ws)) OR ws[word_index + 1] <> coalesce(stored_text, '') ELSE word_index < 0 OR word_index > len(ws) END AS stale FROM c)"""


def candidates(spark, sf):
    i = F.col("event_id")
    return read(spark, sf, "events").select("event_id", (i % 1200).alias("unit_id"), (i % 31 - 1).cast("int").alias("word_index"), pick(i, "replace", "insert", "delete").alias("opcode"), F.when(i % 7 < 3, "the").when(i % 7 == 3, "").alias("stored_text"), F.lit("A").alias("selected"), F.lit(0.9).alias("confidence"))


@query("l4_stale_candidates", f"WITH {CAND} SELECT event_id, CASE WHEN stale THEN 'stale_candidate' WHEN opcode = 'replace' THEN 'current_text_may_be_wrong' WHEN opcode = 'delete' THEN 'possible_omission' ELSE 'unverified_insertion' END AS flag FROM d")
def l4(spark, sf):
    u = docs(spark, sf).select(F.col("doc_id").alias("unit_id"), "text")
    return ledger.flag_of(candidates(spark, sf), u, T.words).select("event_id", "flag")


@query("l5_edited_texts", f"WITH t AS (SELECT doc_id, {WORDS} AS ws FROM documents) SELECT doc_id, CASE WHEN len(ws) >= 1 AND doc_id % 2 = 0 THEN array_to_string(list_concat(['A', 'B'], ws[2:]), ' ') WHEN len(ws) >= 1 THEN array_to_string(list_concat(['new'], ws), ' ') END AS text FROM t")
def l5(spark, sf):
    ws = T.words(F.col("text"))
    first, none = F.slice(ws, 1, 1), F.array().cast("array<string>")
    even = apply.put(ws, F.lit(0), first, F.array(F.lit("A"), F.lit("B")))
    return docs(spark, sf).select("doc_id", F.when(F.size(ws) >= 1, F.array_join(F.when(F.col("doc_id") % 2 == 0, even).otherwise(apply.put(ws, F.lit(0), none, F.array(F.lit("new")))), " ")).alias("text"))


@query("l8_audit", f"""WITH t AS (SELECT doc_id AS unit_id, {WORDS} AS ws FROM documents), e AS (SELECT event_id AS id, event_id % 1200 AS unit_id, CAST(event_id % 31 - 1 AS INTEGER) AS word_index, CASE WHEN event_id % 6 = 0 THEN '' WHEN event_id % 6 = 1 THEN NULL ELSE 'the' END AS chosen_text, event_id % 5 = 0 AS superseded FROM events)
SELECT id, CASE WHEN ws IS NULL THEN 'missing' WHEN superseded THEN 'superseded' WHEN coalesce(chosen_text, '') = '' THEN 'unverifiable' WHEN word_index >= 0 AND ws[word_index + 1] = chosen_text THEN 'ok' ELSE 'mismatch' END AS outcome FROM e LEFT JOIN t USING (unit_id)""")
def l8(spark, sf):
    i = F.col("event_id")
    d = read(spark, sf, "events").select(i.alias("id"), (i % 1200).alias("unit_id"), (i % 31 - 1).cast("int").alias("word_index"), F.when(i % 6 == 0, "").when(i % 6 > 1, "the").alias("chosen_text"), (i % 5 == 0).alias("superseded"))
    return ledger.audit(d, docs(spark, sf).select(F.col("doc_id").alias("unit_id"), "text"), T.words).select("id", "outcome")


ASKED = """q AS (SELECT event_id, 'c' || (event_id % 50) AS crop, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN '' END AS a, event_type AS b FROM events),
k AS (SELECT *, sha256(crop || chr(31) || coalesce(nullif(a, ''), chr(0) || 'NONE' || chr(0)) || chr(31) || b || chr(31) || 'x' || chr(31) || 'p') AS key FROM q)"""


def questions(spark, sf):
    i = F.col("event_id")
    return read(spark, sf, "events").select("event_id", F.concat(F.lit("c"), (i % 50).cast("string")).alias("crop_hash"), F.when(i % 4 == 0, F.col("event_type")).when(i % 4 == 1, "").alias("word_a"), F.col("event_type").alias("word_b"), F.lit("x").alias("context_hash"), F.lit("p").alias("prompt_hash"))


@query("l9_cached_answers", f"WITH {ASKED}, o AS (SELECT key, arg_max(event_id, event_id) AS answer FROM k WHERE event_id % 3 = 0 AND event_id < 5000 GROUP BY key), n AS (SELECT key, max(event_id) AS answer FROM k WHERE event_id % 7 = 0 GROUP BY key), c AS (SELECT * FROM n UNION ALL SELECT * FROM o WHERE key NOT IN (SELECT key FROM n)) SELECT event_id, CAST(answer AS VARCHAR) AS answer FROM k LEFT JOIN c USING (key)")
def l9(spark, sf):
    i = F.col("event_id")
    q = questions(spark, sf)
    kept = lambda d: d.withColumn("answer", i.cast("string")).withColumn("seq", i)
    old = ledger.cache_put(spark.createDataFrame([], "key string, answer string"), kept(q.where("event_id % 3 = 0 and event_id < 5000")))
    return ledger.cache_get(q, ledger.cache_put(old, kept(q.where("event_id % 7 = 0")))).select("event_id", "answer")


@query("l12_remaining_work", "SELECT event_id FROM events WHERE event_id % 3 <> 0")
def l12(spark, sf):
    e = read(spark, sf, "events").select("event_id")
    return ledger.remaining_work(e, e.where("event_id % 3 = 0"), "event_id")


@query("u4_overlaid_values", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN -1.0 ELSE value END AS value FROM events")
def u4(spark, sf):
    e = read(spark, sf, "events").select("event_id", "value")
    return ledger.overlay(e, e.where("event_id % 4 = 0").select("event_id", F.lit(-1.0).alias("value")), "event_id")


# verdicts


@query("c11_tiers", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'C' WHEN event_id % 2 = 0 AND event_id % 3 > 0 THEN 'A' WHEN event_id % 2 = 0 THEN 'B' WHEN event_id % 3 > 0 THEN 'C' ELSE 'D' END AS tier FROM events")
def c11(spark, sf):
    i = F.col("event_id")
    left = F.when(i % 7 != 0, F.col("event_type"))
    return read(spark, sf, "events").select("event_id", detect.tier(left, F.col("event_type"), i % 3 == 0, i % 2 == 0).alias("tier"))


@query("c12_witness_verdicts", f"WITH t AS (SELECT doc_id, {WORDS} AS ws FROM documents) SELECT doc_id, CASE WHEN len(ws) = 0 THEN 'UNREADABLE' WHEN list_contains(ws, 'the') AND list_contains(ws, 'de') THEN 'BOTH' WHEN list_contains(ws, 'the') THEN 'A' WHEN list_contains(ws, 'de') THEN 'B' ELSE 'THIRD' END AS verdict FROM t")
def c12(spark, sf):
    ws = T.words(F.col("text"))
    return docs(spark, sf).select("doc_id", detect.verdict(ws, F.array(F.lit("the")), F.array(F.lit("de"))).alias("verdict"))


@query("c13_witness_against_candidates", "SELECT event_id AS i, CASE WHEN event_id % 4 = 0 THEN 'unaligned' WHEN event_id % 4 = 1 THEN 'corrected' WHEN event_id % 4 = 2 THEN 'original' ELSE 'third' END AS verdict FROM events")
def c13(spark, sf):
    i = F.col("event_id")
    e = read(spark, sf, "events").select(F.lit(1).alias("u"), i.alias("i"), F.lit("new").alias("ocr_reading"), F.lit("old").alias("stored_text"), pick(i, "", "new", "old", "other").alias("reading"))
    return align.witness_verdict(e.drop("reading"), e.where("i % 4 > 0").select("u", "i", "reading"), "u").select("i", "verdict")


# validators


@query("v1_numerals", "SELECT c_custkey AS unit_id, c_custkey % 5 = 0 AS field_differs, c_custkey % 7 = 0 OR c_custkey % 5 = 0 AS opening_differs FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0")
def v1(spark, sf):
    k = F.col("c_custkey")
    wrong = F.when(k % 5 == 0, F.lit("?")).otherwise(T.numeral(k))
    u = read(spark, sf, "customer").select(k.alias("unit_id"), wrong.alias("numeral"), F.concat(F.when((k % 7 == 0) | (k % 5 == 0), F.lit("no")).otherwise(T.numeral(k)), F.when(k % 2 == 0, F.lit("' x")).otherwise(F.lit(" y"))).alias("text"))
    return validate.numerals(u).select("unit_id", "field_differs", "opening_differs")


@query("v10_title_echoes", "WITH d AS (SELECT doc_id AS unit_id, trim(substr(text, CASE WHEN doc_id % 3 = 0 THEN 4 ELSE 1 END, 30)) AS title, trim(CASE WHEN instr(text, '. ') > 0 THEN substr(text, 1, instr(text, '. ') - 1) ELSE text END) AS opening FROM documents) SELECT unit_id, title, opening FROM d WHERE title <> '' AND opening <> '' AND NOT (starts_with(title, opening) OR starts_with(opening, title))")
def v10(spark, sf):
    return validate.title_echo(docs(spark, sf).select(F.col("doc_id").alias("unit_id"), F.substring("text", F.when(F.col("doc_id") % 3 == 0, 4).otherwise(1), F.lit(30)).alias("title"), "text"), (". ",))


@query("v10_next_markers", "SELECT c_custkey AS unit_id FROM customer WHERE c_custkey % 4 = 0 AND c_custkey + 1 IN (SELECT c_custkey FROM customer)")
def v10m(spark, sf):
    k = F.col("c_custkey")
    u = read(spark, sf, "customer").select(k.alias("unit_id"), F.concat(F.lit("text : "), F.when(k % 4 == 0, F.lit("אאאא")).otherwise(T.numeral(k + 1)), F.lit("  ")).alias("text"))
    return validate.next_markers(u, T.HEBREW.letters).select("unit_id")


@query("v4_directions", "SELECT event_id AS unit_id, event_id + 5 AS target, 'above' AS way FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id, event_id - 5, 'below' FROM events WHERE event_id % 3 = 1 AND event_id >= 5")
def v4(spark, sf):
    i = F.col("event_id")
    say = F.when(i % 3 == 0, F.concat(F.lit("see above "), (i + 5).cast("string"))).when(i % 3 == 1, F.concat(F.lit("below "), (i - 5).cast("string"))).otherwise(F.concat(F.lit("above "), (i - 1).cast("string"), F.lit(", below "), (i + 1).cast("string")))
    return validate.directions(read(spark, sf, "events").select(i.alias("unit_id"), say.alias("text")), r"above (\d+)", r"below (\d+)")


@query("v9_opening_owners")
def v9(spark, sf):
    c = read(spark, sf, "conversations").select(F.col("conv_id").alias("unit_id"), "turn", T.words(F.lower("text")).alias("ws"))
    return validate.best_owner(c.where("turn = 0").drop("turn"), c.where("turn = 1").drop("turn"))


@query("j16_short_passages", "WITH w AS (SELECT unnest(['the', 'of the', 'the and', 'e', 'und der', 'de la', 'no such words here']) AS t, unnest([1, 2, 3, 4, 5, 6, 7]) AS chunk_id) SELECT chunk_id, doc_id AS unit_id FROM w JOIN documents d ON contains(d.text, w.t)")
def j16s(spark, sf):
    c = spark.createDataFrame(list(enumerate(("the", "of the", "the and", "e", "und der", "de la", "no such words here"), 1)), "chunk_id int, text string")
    return validate.contained_elsewhere(c, docs(spark, sf).select(F.col("doc_id").alias("unit_id"), "text"))


# alignment


@query("a2_word_positions")
def a2(spark, sf):
    return align.positions(align.opcodes(turn_pairs(spark, sf), "conv_id", "turn"), "conv_id", "turn")


@query("a3_word_positions_with_replaced")
def a3(spark, sf):
    return align.positions(align.opcodes(turn_pairs(spark, sf), "conv_id", "turn"), "conv_id", "turn", replaced=True)


@query("a4_readings")
def a4(spark, sf):
    p = turn_pairs(spark, sf)
    return align.readings(align.opcodes(p, "conv_id", "turn"), p.select("conv_id", "turn", F.col("b").alias("words")), "conv_id", "turn")


@query("a6_similarity")
def a6(spark, sf):
    return turn_pairs(spark, sf).select("conv_id", "turn", align.word_ratio("a", "b").alias("words"), align.ratio(F.array_join(F.slice("a", 1, 20), " "), F.array_join(F.slice("b", 1, 20), " ")).alias("characters"))


@query("a12_attributed_regions")
def a12(spark, sf):
    p = turn_pairs(spark, sf)
    at = lambda c, k: p.select("conv_id", "turn", F.posexplode(c).alias(k, "w"))
    x = F.col("i") % 12
    toks = at("a", "i").select("conv_id", "turn", "i", (x * 0.08).alias("x1"), (F.floor(F.col("i") / 12) * 0.01).alias("y1"), (x * 0.08 + 0.07).alias("x2"), (F.floor(F.col("i") / 12) * 0.01 + 0.008).alias("y2"))
    return geometry.attributed(align.opcodes(p, "conv_id", "turn"), at("b", "j").select("conv_id", "turn", "j", F.floor(F.col("j") / 40).alias("unit_id")), toks, "conv_id", "turn")


@query("d1_owners_of_gaps", "WITH e AS (SELECT event_id, event_id % 60 AS page, CAST(event_id % 23 AS INTEGER) AS j1 FROM events), s AS (SELECT p AS page, p * 10 + k AS unit_id, k * 5 AS start, 5 AS size FROM range(60) t(p), range(4) u(k)) SELECT event_id, unit_id, CAST(j1 - start AS INTEGER) AS word_index FROM e JOIN s ON s.page = e.page AND j1 > start AND j1 <= start + size UNION ALL SELECT event_id, NULL, NULL FROM e WHERE j1 = 0")
def d1(spark, sf):
    i = F.col("event_id")
    e = read(spark, sf, "events").select("event_id", (i % 60).alias("page"), (i % 23).cast("int").alias("j1"))
    s = spark.range(240).select(F.floor(F.col("id") / 4).alias("page"), (F.floor(F.col("id") / 4) * 10 + F.col("id") % 4).alias("unit_id"), (F.col("id") % 4 * 5).alias("start"), F.lit(5).alias("size"))
    return align.owners(e, s).select("event_id", "unit_id", F.col("word_index").cast("int").alias("word_index"))


# review views

UNITS = "u AS (SELECT c_custkey AS unit_id, c_custkey % 40 AS n_words FROM customer)"
EV = "e AS (SELECT event_id AS k, event_id % 1600 AS unit_id, event_id // 1600 % 40 AS word_index, event_id % 5 AS kind, event_id % 7 AS odd FROM events)"
DONE = "d AS (SELECT DISTINCT unit_id, word_index, CASE k % 3 WHEN 0 THEN 'candidate_choice' WHEN 1 THEN 'witness_choice' ELSE 'punctuation_choice' END AS t FROM e WHERE odd < 3)"


def reviewed(spark, sf):
    """Events as items, witness items, manual corrections, flags and punctuation, and as decisions on them."""
    i = F.col("event_id")
    e = read(spark, sf, "events").select(i.alias("k"), (i % 1600).alias("unit_id"), (F.floor(i / 1600) % 40).alias("word_index"), (i % 5).alias("kind"), (i % 7).alias("odd"))
    on = ["unit_id", "word_index"]
    return {
        "items": e.where("kind = 0").select(*on, F.when(F.col("odd") % 2 == 0, "current_text_confirmed").otherwise("ambiguous").alias("flag")),
        "witness": e.where("kind = 1").select(*on),
        "manual": e.where("kind = 2").select(*on),
        "flags": e.where("kind = 3").select("unit_id", F.when(F.col("odd") > 0, F.col("word_index")).alias("word_index"), (F.col("odd") < 5).alias("needs_revisit")),
        "punctuation": e.where("kind = 4").select(*on),
        "decisions": e.where("odd < 3").select(*on, pick(F.col("k"), "candidate_choice", "witness_choice", "punctuation_choice").alias("decision_type")).distinct(),
    }


@query("q1_unit_counts", f"""WITH {UNITS}, {EV}, {DONE},
c AS (SELECT e.unit_id, count(*) AS c, count(t) AS c_done, count(*) FILTER (WHERE t IS NULL AND odd % 2 = 0) AS machine, count(*) FILTER (WHERE t IS NULL AND odd % 2 = 1) AS c_open FROM e LEFT JOIN d ON d.unit_id = e.unit_id AND d.word_index = e.word_index AND t = 'candidate_choice' WHERE kind = 0 GROUP BY 1),
w AS (SELECT e.unit_id, count(*) AS w, count(t) AS w_done FROM e LEFT JOIN d ON d.unit_id = e.unit_id AND d.word_index = e.word_index AND t = 'witness_choice' WHERE kind = 1 GROUP BY 1),
p AS (SELECT e.unit_id, count(*) AS punctuation, count(t) AS punctuation_decided FROM e LEFT JOIN d ON d.unit_id = e.unit_id AND d.word_index = e.word_index AND t = 'punctuation_choice' WHERE kind = 4 GROUP BY 1),
m AS (SELECT unit_id, count(*) AS m FROM e WHERE kind = 2 GROUP BY 1),
f AS (SELECT e.unit_id, count(*) AS ai_flags FROM e JOIN u USING (unit_id) WHERE kind = 3 AND odd > 0 AND odd < 5 AND word_index < n_words AND NOT EXISTS (SELECT 1 FROM e x WHERE x.kind = 2 AND x.unit_id = e.unit_id AND x.word_index = e.word_index) GROUP BY 1),
r AS (SELECT DISTINCT unit_id, true AS again FROM e WHERE kind = 3 AND odd = 0),
j AS (SELECT unit_id, coalesce(c, 0) AS c, coalesce(c_done, 0) AS c_done, coalesce(machine, 0) AS machine, coalesce(c_open, 0) AS c_open, coalesce(w, 0) AS w, coalesce(w_done, 0) AS w_done, coalesce(punctuation, 0) AS punctuation, coalesce(punctuation_decided, 0) AS punctuation_decided, coalesce(m, 0) AS m, coalesce(ai_flags, 0) AS ai_flags, coalesce(again, false) AS needs_revisit FROM u LEFT JOIN c USING (unit_id) LEFT JOIN w USING (unit_id) LEFT JOIN p USING (unit_id) LEFT JOIN m USING (unit_id) LEFT JOIN f USING (unit_id) LEFT JOIN r USING (unit_id))
SELECT unit_id, c + w + m + ai_flags AS total, c_done + w_done + m AS decided, c + w + ai_flags - c_done - w_done AS open, c_open + w - w_done + ai_flags AS disputed, machine, ai_flags, punctuation, punctuation_decided, needs_revisit FROM j""")
def q1c(spark, sf):
    units = read(spark, sf, "customer").select(F.col("c_custkey").alias("unit_id"), (F.col("c_custkey") % 40).alias("n_words"))
    return serving.unit_counts(units, **reviewed(spark, sf))


@query("q2_unit_items", f"""WITH {EV}, d AS (SELECT DISTINCT unit_id, word_index FROM e WHERE odd < 3), m AS (SELECT unit_id, word_index FROM e WHERE kind = 2 AND word_index < 3 AND odd % 2 = 0),
f AS (SELECT unit_id, word_index FROM e WHERE kind = 3 AND odd > 0 AND odd < 5 AND (unit_id, word_index) NOT IN (SELECT (unit_id, word_index) FROM m)),
a AS (SELECT unit_id, word_index, CASE WHEN odd % 2 = 0 THEN 'current_text_confirmed' ELSE 'ambiguous' END AS flag, NULL AS sel FROM e WHERE kind = 0 UNION ALL SELECT *, 'manual_correction', NULL FROM m UNION ALL SELECT *, 'ai_flag', NULL FROM f UNION ALL SELECT unit_id, word_index, 'witness', 'A' FROM e WHERE kind = 1)
SELECT a.unit_id, a.word_index, flag, CASE WHEN a.word_index < 2 THEN a.unit_id // 10 END AS page, CASE WHEN d.unit_id IS NOT NULL THEN 'x' END AS chosen_text,
CASE WHEN flag = 'ai_flag' THEN 'open' WHEN d.unit_id IS NOT NULL THEN 'human' WHEN flag = 'current_text_confirmed' OR flag = 'witness' THEN 'machine' ELSE 'open' END AS state FROM a LEFT JOIN d USING (unit_id, word_index)""")
def q2(spark, sf):
    i = F.col("event_id")
    r, on = reviewed(spark, sf), ["unit_id", "word_index"]
    e = read(spark, sf, "events").select((i % 1600).alias("unit_id"), (F.floor(i / 1600) % 40).alias("word_index"), (i % 5).alias("kind"), (i % 7).alias("odd"))
    units = spark.range(1600).select(F.col("id").alias("unit_id"), F.array(*[F.lit(f"w{k}") for k in range(3)]).alias("ws"))
    manual = e.where("kind = 2").select(*on, F.concat(F.lit("w"), F.when(F.col("odd") % 2 == 0, F.col("word_index")).otherwise(F.lit(99)).cast("string")).alias("new"))
    pages = spark.range(3200).select(F.floor(F.col("id") / 2).alias("unit_id"), (F.col("id") % 2).alias("word_index"), F.floor(F.col("id") / 20).alias("page"))
    return serving.unit_items(r["items"], manual, r["flags"], r["witness"].withColumn("selected", F.lit("A")), units, pages, r["decisions"].select(*on).distinct().withColumn("chosen_text", F.lit("x")))


@query("q3_page_words", f"WITH {LAID.replace('WITH ', '')} SELECT page, page * 2 AS unit_id, CAST(token_index AS INTEGER) AS word_index, CASE WHEN token_index % 5 = 0 THEN 'ambiguous' END AS flag, x1, y1, x2, y2 FROM tok WHERE page = 3")
def q3(spark, sf):
    t = laid_out(spark, sf).select("page", (F.col("page") * 2).alias("unit_id"), F.col("token_index").alias("word_index"), "x1", "y1", "x2", "y2")
    return serving.page_view(3, t.where("word_index % 5 = 0").withColumn("flag", F.lit("ambiguous")), t)


@query("q4_unit_history", "SELECT event_id AS seq, event_type FROM events WHERE user_id = 5 AND event_type IN ('click', 'view')")
def q4(spark, sf):
    i = F.col("event_id")
    b = read(spark, sf, "events").select(i.alias("seq"), F.col("user_id").alias("unit_id"), "event_type")
    kinds = [ledger.history(b.where(F.col("event_type") == k), 5) for k in ("click", "view")]
    return kinds[0].unionByName(kinds[1]).orderBy("seq").select("seq", "event_type")


@query("q5_unit_flags", "WITH h AS (SELECT user_id AS unit_id, event_id, value FROM events WHERE event_type = 'click' AND event_id % 3 > 0) SELECT unit_id, coalesce(arg_max(value, event_id) > 50, false) AS needs_revisit, 'n' || max(event_id) AS note, count(*) AS n_history FROM h GROUP BY unit_id")
def q5(spark, sf):
    i = F.col("event_id")
    b = read(spark, sf, "events").select(i.alias("seq"), F.col("user_id").alias("unit_id"), F.when(F.col("event_type") == "click", ledger.UNIT_FLAG).otherwise("other").alias("decision_type"), F.when(i % 3 == 0, 1).alias("word_index"), (F.col("value") > 50).alias("needs_revisit"), F.concat(F.lit("n"), i.cast("string")).alias("note"))
    return serving.unit_flag(ledger.current(b.where(F.col("decision_type") == ledger.UNIT_FLAG), "unit_id", "word_index"), b)


@query("q5_witness_pages", "WITH q AS (SELECT event_id % 60 AS page, event_id // 60 AS unit_id, event_id % 9 AS word_index, ['A', 'B', 'C', 'D'][CAST(event_id % 4 + 1 AS INTEGER)] AS tier, event_id FROM events), d AS (SELECT DISTINCT unit_id, word_index FROM q WHERE event_id % 5 = 0) SELECT page, tier, count(*) AS total, count(d.unit_id) AS decided FROM q LEFT JOIN d USING (unit_id, word_index) GROUP BY page, tier")
def q5w(spark, sf):
    i = F.col("event_id")
    q = read(spark, sf, "events").select((i % 60).alias("page"), F.floor(i / 60).alias("unit_id"), (i % 9).alias("word_index"), pick(i, "A", "B", "C", "D").alias("tier"), "event_id")
    return serving.witness_pages(q, q.where("event_id % 5 = 0").withColumn("decision_type", F.lit("witness_choice")))


@query("q5_witness_context", f"WITH {W}, t AS (SELECT doc_id AS page, list(word ORDER BY word_index) AS ws FROM w WHERE length(word) > 2 GROUP BY doc_id), s AS (SELECT doc_id AS page, CAST(doc_id % 60 - 1 AS INTEGER) AS token_index FROM documents), j AS (SELECT s.page, token_index, ws, token_index >= 0 AND token_index < len(ws) AS inside FROM s LEFT JOIN t USING (page)) SELECT page, token_index, CASE WHEN inside THEN array_to_string(ws[greatest(token_index - 8, 0) + 1 : token_index + 9], ' ') ELSE '' END AS words, CASE WHEN inside THEN CAST(token_index - greatest(token_index - 8, 0) AS INTEGER) END AS target_index FROM j")
def q5c(spark, sf):
    t = placed(spark, sf).select(F.col("doc_id").alias("page"), F.col("word_index").alias("token_index"), F.col("word").alias("text"))
    spots = docs(spark, sf).select(F.col("doc_id").alias("page"), (F.col("doc_id") % 60 - 1).cast("int").alias("token_index"))
    return serving.witness_context(spots, t, F.length("text") > 2).withColumn("words", F.array_join("words", " "))


@query("q7_unit_pages", "SELECT c_custkey AS unit_id, CASE WHEN c_custkey % 3 = 0 THEN c_custkey // 9 WHEN c_custkey % 2 = 0 THEN c_custkey // 8 END AS page FROM customer")
def q7(spark, sf):
    k = F.col("unit_id")
    u = read(spark, sf, "customer").select(F.col("c_custkey").alias("unit_id"))
    return serving.page_of(u, u.where("unit_id % 3 = 0").withColumn("page", F.floor(k / 9)), u.withColumn("matched_page", F.floor(k / 8)).withColumn("trusted", k % 2 == 0))


@query("q8_units_on_page", "SELECT c_custkey AS unit_id FROM customer WHERE c_custkey // 8 = 5 AND c_custkey % 2 = 0 UNION SELECT c_custkey FROM customer WHERE c_custkey % 11 = 5")
def q8(spark, sf):
    k = F.col("unit_id")
    u = read(spark, sf, "customer").select(F.col("c_custkey").alias("unit_id"))
    return serving.units_on_page(5, u.withColumn("matched_page", F.floor(k / 8)).withColumn("trusted", k % 2 == 0), u.withColumn("page", k % 11))


@query("j1_units_with_pages", "SELECT doc_id AS unit_id, url FROM documents JOIN pages ON page_id = doc_id")
def j1(spark, sf):
    return docs(spark, sf).select(F.col("doc_id").alias("unit_id")).join(read(spark, sf, "pages").select(F.col("page_id").alias("unit_id"), "url"), "unit_id")


@query("l1_stamped_rows", "SELECT user_id AS unit_id, 'klal_flag' AS decision_type, 12 AS id_length, true AS later FROM events")
def l1(spark, sf):
    from ..sources import writers

    new = writers.stamped(read(spark, sf, "events").select(F.col("user_id").alias("unit_id"), F.lit(ledger.UNIT_FLAG).alias("decision_type")), 100)
    return new.select("unit_id", "decision_type", F.length("id").alias("id_length"), (F.col("seq") > 100).alias("later"))
