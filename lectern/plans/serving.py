"""Views that answer a review front end's questions from materialised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.ledger import UNIT_FLAG

# Labels of the flags that a unit's items carry.
FLAG_LABELS = {
    "current_text_may_be_wrong": "text may be wrong", "current_text_confirmed": "text confirmed", "ambiguous": "ambiguous", "possible_omission": "possible omission", "unverified_insertion": "unverified insertion",
    "unverified": "unverified", "error": "error", "manual_correction": "manual correction", "ai_flag": "machine's flag",
    "stale_candidate": "text has changed since", "witness": "witness disagrees",
}


def state(flag, decided, selected=None):
    """open, human or machine: whose word counts for an item; of a witness item, vision's choice of a side."""
    s = F.when(flag == "ai_flag", "open").when(decided, "human").when(flag == "current_text_confirmed", "machine")
    return (s if selected is None else s.when((flag == "witness") & selected.isin("A", "B"), "machine")).otherwise("open")


def unit_rollup(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per unit: items (unit_id, word_index, flag) by state, with current decisions (unit_id, word_index, needs_revisit)."""
    d = decisions.select("unit_id", "word_index", F.lit(True).alias("_d"), F.coalesce("needs_revisit", F.lit(False)).alias("_r"))
    s = items.join(d, ["unit_id", "word_index"], "left").withColumn("state", state(F.col("flag"), F.coalesce("_d", F.lit(False))))
    return s.groupBy("unit_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("_d")).alias("decided"), F.count_if(F.col("state") == "open").alias("open"), F.count_if(F.col("flag") == "ambiguous").alias("disputed"), F.count_if(F.col("state") == "machine").alias("machine"), F.coalesce(F.bool_or("_r"), F.lit(False)).alias("needs_revisit"))


def unit_counts(units: DataFrame, items: DataFrame, witness: DataFrame, manual: DataFrame, flags: DataFrame, punctuation: DataFrame, decisions: DataFrame) -> DataFrame:
    """The front page's counts of every unit, those without items too.

    units: (unit_id, n_words); items: (unit_id, word_index, flag); witness, punctuation: (unit_id, word_index); manual:
    (unit_id, word_index) that hold; flags: (unit_id, word_index or null, needs_revisit), current; decisions: (unit_id,
    word_index, decision_type), current. A word's flag counts if it is open, inside the text and no manual correction
    covers it; a flag without a word marks the unit."""
    done = lambda kind: decisions.where(F.col("decision_type") == kind).select("unit_id", "word_index", F.lit(1).alias("_d")).distinct()
    on = ["unit_id", "word_index"]
    sums = lambda d, **c: d.groupBy("unit_id").agg(*[F.count_if(v).alias(k) for k, v in c.items()])
    got, sure = F.col("_d").isNotNull(), F.col("flag") == "current_text_confirmed"
    c = sums(items.join(done("candidate_choice"), on, "left"), c=F.lit(True), c_done=got, machine=~got & sure, c_open=~got & ~F.coalesce(sure, F.lit(False)))
    w = sums(witness.join(done("witness_choice"), on, "left"), w=F.lit(True), w_done=got)
    p = sums(punctuation.join(done("punctuation_choice"), on, "left"), punctuation=F.lit(True), punctuation_decided=got)
    m = sums(manual, m=F.lit(True))
    word = flags.where("needs_revisit and word_index >= 0").join(manual.select(*on).distinct(), on, "left_anti").join(units.select("unit_id", "n_words"), "unit_id").where("word_index < n_words")
    f, again = sums(word, ai_flags=F.lit(True)), flags.where("needs_revisit and word_index is null").select("unit_id", F.lit(True).alias("_r")).distinct()
    j = units.select("unit_id")
    for d in (c, w, p, m, f, again):
        j = j.join(d, "unit_id", "left")
    n = lambda name: F.coalesce(F.col(name), F.lit(0))
    total, decided = n("c") + n("w") + n("m") + n("ai_flags"), n("c_done") + n("w_done") + n("m")
    return j.select("unit_id", total.alias("total"), decided.alias("decided"), (total - decided).alias("open"), (n("c_open") + n("w") - n("w_done") + n("ai_flags")).alias("disputed"), n("machine").alias("machine"), n("ai_flags").alias("ai_flags"), n("punctuation").alias("punctuation"), n("punctuation_decided").alias("punctuation_decided"), F.coalesce("_r", F.lit(False)).alias("needs_revisit"))


def unit_view(unit, items: DataFrame, manual: DataFrame, decisions: DataFrame) -> DataFrame:
    """A unit's machine and manual items with what was decided."""
    keep = ["unit_id", "word_index", "flag"]
    u = items.select(keep).where(F.col("unit_id") == unit).unionByName(manual.select("unit_id", "word_index", F.lit("manual_correction").alias("flag")).where(F.col("unit_id") == unit))
    return u.join(decisions.select("unit_id", "word_index", "chosen_text"), ["unit_id", "word_index"], "left")


def unit_items(items: DataFrame, manual: DataFrame, flags: DataFrame, witness: DataFrame, units: DataFrame, word_pages: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every unit's items as its view shows them: (unit_id, word_index, flag, page, chosen_text, state).

    units: (unit_id, ws) of words. Manual corrections (unit_id, word_index, new) show while the text holds them; a
    machine's flag of a word shows while it is open and no manual correction covers the word; witness items carry what
    vision ``selected``; word_pages: (unit_id, word_index, page)."""
    on = ["unit_id", "word_index"]
    m = manual.join(units, "unit_id").where((F.col("word_index") >= 0) & (F.get("ws", F.col("word_index")) == F.col("new"))).select(*on, F.lit("manual_correction").alias("flag"))
    f = flags.where("needs_revisit and word_index is not null").select(*on, F.lit("ai_flag").alias("flag")).join(m.select(*on).distinct(), on, "left_anti")
    none = F.lit(None).cast("string")
    every = items.select(*on, "flag", none.alias("selected")).unionByName(m.withColumn("selected", none)).unionByName(f.withColumn("selected", none)).unionByName(witness.select(*on, F.lit("witness").alias("flag"), "selected"))
    j = every.join(word_pages, on, "left").join(decisions.select(*on, "chosen_text", F.lit(True).alias("_d")), on, "left")
    return j.select(*on, "flag", "page", "chosen_text", state(F.col("flag"), F.coalesce("_d", F.lit(False)), F.col("selected")).alias("state"))


def unit_flag(flags: DataFrame, ledger: DataFrame) -> DataFrame:
    """(unit_id, needs_revisit, note, n_history): units' current general flag; flags of words say nothing of a unit."""
    h = ledger.where((F.col("decision_type") == UNIT_FLAG) & F.col("word_index").isNull()).groupBy("unit_id").agg(F.count(F.lit(1)).alias("n_history"))
    return flags.where("word_index is null").select("unit_id", F.coalesce("needs_revisit", F.lit(False)).alias("needs_revisit"), "note").join(h, "unit_id", "left")


def witness_pages(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """(page, tier, total, decided) of a queue (page, unit_id, word_index, tier)."""
    d = decisions.where("decision_type = 'witness_choice'").select("unit_id", "word_index", F.lit(1).alias("_d")).distinct()
    return queue.join(d, ["unit_id", "word_index"], "left").groupBy("page", "tier").agg(F.count(F.lit(1)).alias("total"), F.count("_d").alias("decided"))


def witness_context(spots: DataFrame, tokens: DataFrame, real, window: int = 8) -> DataFrame:
    """(page, token_index, words, target_index): the ``window`` real tokens on both sides of a spot and its place among
    them; spots count real tokens only, and those beyond them have no words. tokens: (page, token_index, text)."""
    page = tokens.where(real).groupBy("page").agg(F.transform(F.sort_array(F.collect_list(F.struct("token_index", "text"))), lambda t: t["text"]).alias("_t"))
    low = F.greatest(F.col("token_index") - window, F.lit(0))
    inside = (F.col("token_index") >= 0) & (F.col("token_index") < F.size("_t"))
    j = spots.join(page, "page", "left")
    words = F.when(inside, F.slice("_t", low + 1, F.col("token_index") + window + 1 - low)).otherwise(F.array().cast("array<string>"))
    return j.select("page", "token_index", words.alias("words"), F.when(inside, F.col("token_index") - low).alias("target_index"))


def page_view(page, items: DataFrame, words: DataFrame) -> DataFrame:
    """A page's items with boxes, and the boxes of its other words."""
    here = items.where(F.col("page") == page)
    rest = words.where(F.col("page") == page).join(here, ["unit_id", "word_index"], "left_anti").withColumn("flag", F.lit(None).cast("string"))
    cols = ["page", "unit_id", "word_index", "flag", "x1", "y1", "x2", "y2"]
    return here.select(cols).unionByName(rest.select(cols))


def page_of(units: DataFrame, regions: DataFrame, alignment: DataFrame) -> DataFrame:
    """A unit's page: its region's, else its alignment's if trusted."""
    r = regions.select("unit_id", F.col("page").alias("_p")).dropDuplicates(["unit_id"])
    a = alignment.select("unit_id", F.when(F.col("trusted"), F.col("matched_page")).alias("_m"))
    return units.select("unit_id").join(r, "unit_id", "left").join(a, "unit_id", "left").select("unit_id", F.coalesce("_p", "_m").alias("page"))


def units_on_page(page, alignment: DataFrame, continuations: DataFrame) -> DataFrame:
    return alignment.where(F.col("trusted") & (F.col("matched_page") == page)).select("unit_id").union(continuations.where(F.col("page") == page).select("unit_id")).distinct()
