"""Invariants of a corpus: each check returns its violations as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import numeral, opening, trailing_marker, words
from . import nearest
from .align import gaps, ratio


def numerals(units: DataFrame) -> DataFrame:
    """Units (unit_id, numeral, text) whose numeral is not that of their id, or whose text does not open with it."""
    want, first = numeral(F.col("unit_id")), F.get(words(F.col("text")), F.lit(0))
    field = ~F.col("numeral").eqNullSafe(want)
    head = ~(first.eqNullSafe(F.col("numeral")) | first.eqNullSafe(F.concat("numeral", F.lit("'"))))
    return units.select("unit_id", "numeral", want.alias("expected"), first.alias("opens"), field.alias("field_differs"), head.alias("opening_differs")).where("field_differs or opening_differs")


def foreign(units: DataFrame, allowed: str, unit: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each character outside the class ``allowed``: (unit, position, character)."""
    odd = F.filter(F.transform(F.split(text, ""), lambda c, i: F.struct(i.alias("position"), c.alias("character"))), lambda x: (x["character"] != "") & ~x["character"].rlike(f"^[{allowed}]$"))
    return units.where(F.col(text).rlike(f"[^{allowed}]")).select(unit, F.inline(odd))


def characters(units: DataFrame, latin: str = "[A-Za-z]", unit: str = "doc_id", text: str = "text", letter: str = r"\p{L}") -> DataFrame:
    """Latin letters, digits and unbalanced brackets of each unit that has any; ``)`` behind asterisks, or behind a quote
    that follows no letter (``letter``), closes a footnote's mark and no bracket."""
    n = lambda p: F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(p))
    round_ = n(r"\(") - (n(r"\)") - n(rf'(?:\*+|(?<!{letter})")\s*\)'))
    return units.select(unit, n(latin).alias("latin"), n("[0-9]").alias("digits"), round_.alias("parens"), (n(r"\[") - n(r"\]")).alias("brackets")).where("latin > 0 or digits > 0 or parens <> 0 or brackets <> 0")


def next_markers(units: DataFrame, letters: str) -> DataFrame:
    """Trailing markers that are not the next unit's numeral, where there is a next unit."""
    m = units.select("unit_id", trailing_marker(F.col("text"), letters).alias("marker")).where("marker is not null")
    known = units.select((F.col("unit_id") - 1).alias("unit_id"))
    return m.join(known, "unit_id", "left_semi").withColumn("expected", numeral(F.col("unit_id") + 1)).where("marker <> expected")


def title_echo(units: DataFrame, stops: tuple[str, ...], head: str = "") -> DataFrame:
    """Units whose title and opening phrase are not the one a prefix of the other."""
    o = opening(F.col("text"), stops, head)
    t = F.trim("title")
    return units.select("unit_id", t.alias("title"), o.alias("opening")).where("title <> '' and opening <> ''").where(~(F.col("title").startswith(F.col("opening")) | F.col("opening").startswith(F.col("title"))))


def spacing(units: DataFrame, unit: str = "doc_id", text: str = "text") -> DataFrame:
    """Units in which word numbers by any white space and by single spaces differ."""
    a, b = words(F.col(text)), F.split(text, " ")
    return units.select(unit, F.size(a).alias("n_words"), F.size(b).alias("n_spaced")).where(F.col(text).isNotNull() & (F.col(text) != "") & (a != b))


def dense(ids: DataFrame, unit: str) -> DataFrame:
    """Least, largest and number of ids, and whether they are 1 to n without gap or repeat."""
    a = ids.agg(F.min(unit).alias("lo"), F.max(unit).alias("hi"), F.count(unit).alias("n"), F.count_distinct(unit).alias("d"))
    return a.withColumn("is_dense", (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("n") == F.col("d")))


def accounted(measured: DataFrame, unmeasured: DataFrame, eligible: DataFrame) -> DataFrame:
    """The three counts and whether the first two make the third."""
    n = lambda d, c: d.agg(F.count(F.lit(1)).alias(c))
    return n(measured, "measured").join(n(unmeasured, "unmeasured")).join(n(eligible, "eligible")).withColumn("holds", F.col("measured") + F.col("unmeasured") == F.col("eligible"))


def furniture(word: Column, header: tuple[str, ...], pattern: str = "(?i)^(digitized|by|google)$") -> Column:
    """Running headers as bare words, scanner's marks, digits and pure punctuation."""
    bare = F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}]", "")
    return (bare.isin(*header) & ~word.rlike("[\"'׳״]")) | word.rlike(pattern) | word.rlike(r"^[0-9]+$") | (bare == "")


def furniture_cleaned(word: Column, header: tuple[str, ...]) -> Column:
    """The rule for corrections: a word's letters and digits, in lower case, are one of the header's."""
    return F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}]", "").isin(*header)


def furniture_exact(word: Column, header: tuple[str, ...]) -> Column:
    """The rule for orphans: the word as it stands is one of the header's, or all digits."""
    return word.isin(*header) | word.rlike(r"^[0-9]+$")


def furniture_segment(ws: Column, header: tuple[str, ...]) -> Column:
    """The rule for witnesses: every word of a run is one of the header's or digits; an empty run is none."""
    return (F.size(ws) > 0) & F.forall(ws, lambda w: w.isin(*header) | w.rlike(r"^[0-9]+$"))


def most_shared_words(mismatched: DataFrame, openings: DataFrame, shared: int = 1) -> DataFrame:
    """Of each text (unit_id, ws), the other unit whose opening words overlap most, by Jaccard of word sets, the smaller
    id of equals; rows of one id are one text.

    All pairs are compared in blocks (``nearest``); no row is made for a pair."""
    return nearest.most_alike(mismatched, openings, lambda a, b: nearest.by_sets(a, b, shared), sets=True)


def best_owner(mismatched: DataFrame, openings: DataFrame, words: int = 50) -> DataFrame:
    """Of each mismatched text (unit_id, ws), the other unit whose opening (unit_id, ws) it resembles most: the ratio of
    the matcher over the first ``words`` words, the smaller id of equals; none if nothing is alike.

    All pairs are bounded in blocks (``nearest``), and the matcher looks only at those that can be the best."""
    clip = lambda d: d.select("unit_id", F.slice("ws", 1, words).alias("ws"))
    return nearest.most_alike(clip(mismatched), clip(openings), nearest.by_matcher)


def contained_elsewhere(chunks: DataFrame, units: DataFrame, n: int = 5, block: int = 1000) -> DataFrame:
    """(chunk_id, unit_id): units whose text holds a chunk's text; chunks (chunk_id, text), units (unit_id, text).

    Only units that share a run of ``n`` words with the chunk's middle are compared; a chunk's outer words may be parts
    of words in the unit, so they are no key. Chunks too short for that are sent to every unit in blocks of ``block``:
    they are a stated set of queries, each unit is looked through once a block. An empty or null chunk is in none."""
    ws = words(F.col("text"))
    k = F.size("ws")
    inner = F.when(k > 2, F.slice("ws", 2, F.greatest(k - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    c = chunks.where("text <> ''").select("chunk_id", "text", ws.alias("ws")).withColumn("inner", inner)
    long = c.where(F.size("inner") >= n).select("chunk_id", "text", F.array_join(F.slice("inner", 1, n), " ").alias("key"))
    grams = F.transform(F.sequence(F.lit(1), F.size("ws") - (n - 1)), lambda i: F.array_join(F.slice("ws", i, n), " "))
    keys = units.select("unit_id", ws.alias("ws")).where(F.size("ws") >= n).select("unit_id", F.explode(F.array_distinct(grams)).alias("key"))
    near = long.join(keys, "key").select("chunk_id", "unit_id", F.col("text").alias("chunk"))
    found = near.join(units.select("unit_id", "text"), "unit_id").where(F.contains("text", "chunk")).select("chunk_id", "unit_id")
    few = c.where(F.size("inner") < n).groupBy(F.pmod(F.xxhash64("chunk_id"), F.lit(64)).alias("_b")).agg(F.collect_list(F.struct("chunk_id", "text")).alias("_c"))
    # a bucket's chunks in pieces, so that no row grows with their number
    few = few.select(F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.size("_c") - 1) / block).cast("int")), lambda i: F.slice("_c", i * block + 1, block))).alias("_c"))
    hits = F.filter("_c", lambda x: F.contains(F.col("text"), x["text"]))
    short = units.select("unit_id", "text").join(few, F.expr("unit_id is not null")).select(F.explode(F.transform(hits, lambda x: x["chunk_id"])).alias("chunk_id"), "unit_id")
    return found.unionByName(short).distinct()


def orphans(mismatched: DataFrame, openings: DataFrame, chunks: DataFrame, units: DataFrame, ops: DataFrame, *, least: float = 0.5, gap: int = 8) -> DataFrame:
    """The three passes over words that no unit owns, as one report (check, unit_id, other): texts that open like another
    unit, chunks that stand in a unit, and long runs of the page that the units between two adjacent ids lack.

    ops: opcodes with (unit_id, next_id); pairs whose ids do not follow each other are left out."""
    a = best_owner(mismatched, openings).where(F.col("score") >= least).select(F.lit("owner").alias("check"), "unit_id", F.col("owner").alias("other"))
    b = contained_elsewhere(chunks, units).select(F.lit("chunk").alias("check"), F.col("chunk_id").alias("unit_id"), F.col("unit_id").alias("other"))
    c = gaps(ops.where("next_id = unit_id + 1"), least=gap).select(F.lit("gap").alias("check"), "unit_id", F.col("next_id").alias("other")).distinct()
    return a.unionByName(b).unionByName(c)


def title_clusters(units: DataFrame, least: float = 0.8) -> DataFrame:
    """(unit_id, cluster): a new cluster begins where a unit's title is less like that of the id before than ``least``."""
    before = units.select((F.col("unit_id") + 1).alias("unit_id"), F.col("title").alias("_t"))
    near = units.join(before, "unit_id", "left").withColumn("_new", F.coalesce(ratio("_t", "title") < least, F.lit(True)))
    starts = near.where("_new").select("unit_id")
    return next_start(near.select("unit_id"), starts)


def next_start(ids: DataFrame, starts: DataFrame, width: int = 1 << 16) -> DataFrame:
    """(unit_id, cluster): the last start at or before each id, found in stretches of ids and then among stretches."""
    from pyspark.sql import Window

    both = ids.select("unit_id", F.floor(F.col("unit_id") / width).alias("_b")).join(starts.select("unit_id", F.col("unit_id").alias("_s")), "unit_id", "left")
    last = F.last("_s", ignorenulls=True)
    inside = both.withColumn("_in", last.over(Window.partitionBy("_b").orderBy("unit_id")))
    ends = both.groupBy("_b").agg(F.max("_s").alias("_e")).select("_b", F.last("_e", ignorenulls=True).over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    return inside.join(ends, "_b").select("unit_id", F.coalesce("_in", "_before").alias("cluster"))


def directions(units: DataFrame, above: str, below: str) -> DataFrame:
    """References to units above or below that point the other way: patterns whose first group is a number.

    A disclaimed check: a reader decides."""
    ref = lambda p, way: units.select("unit_id", F.explode(F.regexp_extract_all("text", F.lit(p), F.lit(1))).alias("target"), F.lit(way).alias("way"))
    r = ref(above, "above").unionByName(ref(below, "below")).withColumn("target", F.expr("try_cast(target as long)")).where("target is not null")
    return r.where(((F.col("way") == "above") & (F.col("target") >= F.col("unit_id"))) | ((F.col("way") == "below") & (F.col("target") <= F.col("unit_id"))))


def remaining(counts: DataFrame, part: str, order: str, n: str) -> DataFrame:
    """What is left of a part's counts from each row on, its own included, never below 0."""
    from pyspark.sql import Window

    w = Window.partitionBy(part).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return counts.withColumn("remaining", F.greatest(F.sum(n).over(w), F.lit(0)))
