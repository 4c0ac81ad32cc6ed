"""An append-only ledger of decisions: (seq, ts, unit_id, word_index, decision_type, ...), current by greatest seq."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# A choice made for a disputed word counts as one for a candidate.
ALIASES = {"disputed_choice": "candidate_choice"}
# The decision type of a note on a unit or a word.
UNIT_FLAG = "klal_flag"
SURE = 0.7  # confidence from which a machine's verdict is taken


def kind(decision_type: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv]), decision_type), decision_type)


def current(ledger: DataFrame, *key: str, order: str = "seq") -> DataFrame:
    """The row of the greatest ``order`` of each key. An aggregate, so a frequent key is combined before the shuffle."""
    rest = [c for c in ledger.columns if c not in key]
    return ledger.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in rest])


def history(ledger: DataFrame, unit, index=None, order: str = "seq") -> DataFrame:
    """A key's rows, oldest first; without an index the whole unit's."""
    h = ledger.where(F.col("unit_id") == unit)
    return (h if index is None else h.where(F.col("word_index") == index)).orderBy(order)


def superseded(ledger: DataFrame, applied: DataFrame, *key: str, order: str = "seq", id: str = "id") -> DataFrame:
    """Applied rows with whether a later row of their key is applied too; null keys match each other.

    The latest applied row of a key supersedes all others: one aggregate and one join."""
    a = ledger.join(applied.select(F.col("applied_id").alias(id)).distinct(), id, "left_semi")
    last = a.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.max(order).alias("_last"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return a.join(last, on).select(*a.columns, (F.col("_last") > F.col(order)).alias("superseded"))


def unapplied(ledger: DataFrame, applied: DataFrame, id: str = "id") -> DataFrame:
    return ledger.join(applied.select(F.col("applied_id").alias(id)), id, "left_anti")


def dangling(applied: DataFrame, ledger: DataFrame, id: str = "id") -> DataFrame:
    """Apply events that name no decision."""
    return applied.join(ledger.select(F.col(id).alias("applied_id")), "applied_id", "left_anti")


def classify(opcode: Column, selected: Column, confidence: Column) -> Column:
    """The flag of a candidate; no confidence counts as none, and so does 0."""
    sure = F.coalesce((confidence != 0) & (confidence >= SURE), F.lit(False))
    return (
        F.when(opcode == "replace", F.when(selected == "A", F.when(sure, "current_text_may_be_wrong").otherwise("ambiguous")).when(selected == "B", F.when(sure, "current_text_confirmed").otherwise("ambiguous")).when(selected == "UNCERTAIN", "ambiguous").otherwise("error"))
        .when(opcode == "delete", F.when((selected == "A") & sure, "possible_omission").when(selected == "ERROR", "error").otherwise("ambiguous"))
        .when(opcode == "insert", "unverified_insertion")
        .otherwise("unverified")
    )


def drifted(ws: Column, opcode: Column, index: Column, expected: Column, split) -> Column:
    """Whether the text no longer holds what a candidate was made from. Null words: drifted."""
    span = F.when(F.coalesce(expected, F.lit("")) == "", F.lit(1)).otherwise(F.size(split(expected)))
    inside = (index >= 0) & (index + span <= F.size(ws))
    live = F.array_join(F.slice(ws, F.greatest(index, F.lit(0)) + 1, span), " ")
    return F.when(ws.isNull(), True).when(opcode.isin("replace", "insert"), ~inside | (live != F.coalesce(expected, F.lit("")))).when(opcode == "delete", (index < 0) | (index > F.size(ws))).otherwise(False)


def audit(decisions: DataFrame, units: DataFrame, split) -> DataFrame:
    """Outcome of applied decisions (id, unit_id, word_index, chosen_text, superseded) against the texts."""
    j = decisions.join(units.select("unit_id", F.col("text").alias("_t"), F.lit(True).alias("_u")), "unit_id", "left")
    ws, i = split(F.col("_t")), F.col("word_index")
    span = split(F.col("chosen_text"))
    live = F.slice(ws, F.greatest(i, F.lit(0)) + 1, F.greatest(F.size(span), F.lit(0)))
    outcome = F.when(F.col("_u").isNull(), "missing").when(F.col("superseded"), "superseded").when(F.coalesce(F.col("chosen_text"), F.lit("")) == "", "unverifiable").when((i >= 0) & (live == span), "ok").otherwise("mismatch")
    return j.withColumn("outcome", outcome).drop("_t", "_u")


def overlay(base: DataFrame, over: DataFrame, *key: str) -> DataFrame:
    """Rows of ``base``, those of ``over`` in place of the same keys."""
    return over.unionByName(base.join(over.select(*key).distinct(), list(key), "left_anti"))


def first_seen(df: DataFrame, key: tuple[str, ...], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in rest])


def missing_verdicts(items: DataFrame, cache: DataFrame) -> DataFrame:
    """Items that a keyed cache lacks; a null side is a value of its own, different from an empty one."""
    on = [items[k].eqNullSafe(cache[k]) for k in ("crop_hash", "word_a", "word_b", "context_hash", "prompt_hash")]
    return items.join(cache, on, "left_anti")


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of one table and not of the other: new and stale ones."""
    return after.exceptAll(before).withColumn("change", F.lit("new")).unionByName(before.exceptAll(after).withColumn("change", F.lit("stale")))


def live(decisions: DataFrame, candidates: DataFrame, same: tuple[str, ...] = ("opcode", "word_index", "ocr_reading", "stored_text")) -> DataFrame:
    """Decisions (unit_id, ..., and the candidate as it was seen) whose candidate is still there, unchanged in all of
    ``same``; null equals null. A candidate listed twice counts once."""
    c = candidates.select("unit_id", *same).distinct()
    on = [decisions["unit_id"] == c["unit_id"], *[decisions[k].eqNullSafe(c[k]) for k in same]]
    return decisions.join(c, on, "left_semi")


def flagged(ledger: DataFrame) -> DataFrame:
    """Units whose latest general flag asks for another look: flags of words say nothing of the unit."""
    general = ledger.where((F.col("decision_type") == UNIT_FLAG) & F.col("word_index").isNull())
    return current(general, "unit_id").where("needs_revisit").select("unit_id", "seq", "note")


def flag_of(candidates: DataFrame, units: DataFrame, split) -> DataFrame:
    """Candidates (unit_id, opcode, word_index, stored_text, selected, confidence) with their flag; one whose text is no
    longer what it was made from is ``stale_candidate``."""
    j = candidates.join(units.select("unit_id", split(F.col("text")).alias("_ws")), "unit_id", "left")
    stale = drifted(F.col("_ws"), F.col("opcode"), F.col("word_index"), F.col("stored_text"), split)
    return j.withColumn("flag", F.when(stale, "stale_candidate").otherwise(classify(F.col("opcode"), F.col("selected"), F.col("confidence")))).drop("_ws")


# The sides of a question that may be absent, and how an absent or empty one is kept.
ABSENT = "\x00NONE\x00"
KEY = ("crop_hash", "word_a", "word_b", "context_hash", "prompt_hash")


def cache_key(df: DataFrame) -> DataFrame:
    """With ``key``, the digest of everything that a cached answer is an answer to."""
    side = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(ABSENT)) if c in ("word_a", "word_b") else F.col(c)
    return df.withColumn("key", F.sha2(F.concat_ws("\x1f", *[side(c) for c in KEY]), 256))


def cache_get(items: DataFrame, cache: DataFrame) -> DataFrame:
    """Items with the cached ``answer``, null where there is none."""
    return cache_key(items).join(cache.select("key", "answer"), "key", "left")


def cache_put(cache: DataFrame, answers: DataFrame) -> DataFrame:
    """The cache (key, answer) with new answers in place of old ones; of several to one question the last by ``seq``."""
    new = cache_key(answers).groupBy("key").agg(F.max_by("answer", "seq").alias("answer"))
    return overlay(cache.select("key", "answer"), new, "key")


def cache_migrated(rows: DataFrame, prompt_hash: str) -> DataFrame:
    """Rows kept before prompts were part of the question, under the prompt that they answered."""
    return cache_key(rows.withColumn("prompt_hash", F.lit(prompt_hash))).select("key", "answer")


def remaining_work(items: DataFrame, done: DataFrame, id: str) -> DataFrame:
    """Items that a run has not yet finished, for one that goes on where another stopped."""
    return items.join(done.select(id).distinct(), id, "left_anti")
