"""Likely corruption by frequency evidence.

All detectors work on distinct forms: candidates come from joins of the forms with the reference's frequent
forms under a shared key (one letter blanked, one letter dropped), never from all edits of every form.
"Own" is the audited corpus' frequency (form, n); "reference" is independent evidence (form, n).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import Script


def rare(own: DataFrame, reference: DataFrame, most: int, least_letters: int = 1) -> DataFrame:
    """Own forms seen ``most`` times at most that the reference lacks."""
    return own.where((F.col("n") <= most) & (F.length("form") >= least_letters)).join(reference.select("form"), "form", "left_anti")


def blanked(form: Column) -> Column:
    """Every (place, letter, form with that letter blanked)."""
    return F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.struct(i.alias("at"), F.substring(form, i, F.lit(1)).alias("letter"), F.concat(F.substring(form, F.lit(1), i - 1), F.lit("\x00"), F.substring(form, i + 1, F.length(form))).alias("key")))


def dropped(form: Column) -> Column:
    """Every (place, letter, form without that letter)."""
    return F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.struct(i.alias("at"), F.substring(form, i, F.lit(1)).alias("letter"), F.concat(F.substring(form, F.lit(1), i - 1), F.substring(form, i + 1, F.length(form))).alias("key")))


def dominance(candidates: DataFrame, ratio: float) -> DataFrame:
    """(form, own_n, candidate, candidate_n, n_options, verdict): the best candidate of each form.

    ambiguous if a second one exists that the first does not exceed ``ratio`` times."""
    by = W.partitionBy("form").orderBy(F.desc("m"), "candidate")
    c = candidates.withColumn("_r", F.row_number().over(by)).withColumn("_second", F.lead("m").over(by)).withColumn("n_options", F.count(F.lit(1)).over(W.partitionBy("form")).cast("int"))
    verdict = F.when(F.col("_second").isNotNull() & (F.col("m") <= ratio * F.col("_second")), "ambiguous").otherwise("high_confidence")
    return c.where("_r = 1").select("form", F.col("n").alias("own_n"), "candidate", F.col("m").alias("candidate_n"), "n_options", verdict.alias("verdict"))


def substitutions(own: DataFrame, reference: DataFrame, script: Script, *, most: int = 3, over: int = 50, ratio: float = 5) -> DataFrame:
    """One confusable letter away from a form that the reference has more than ``over`` times."""
    pairs = F.create_map(*[F.lit(x) for p in {a + b for q in script.pairs for a, b in (q, q[::-1])} for x in (p, True)])
    a = rare(own, reference, most).select("form", "n", F.inline(blanked(F.col("form"))))
    b = reference.where(F.col("n") > over).select(F.col("form").alias("candidate"), F.col("n").alias("m"), F.inline(blanked(F.col("form")))).select("candidate", "m", F.col("letter").alias("other"), "key")
    near = a.join(b, "key").where(F.coalesce(F.try_element_at(pairs, F.concat("letter", "other")), F.lit(False)))
    return dominance(near.select("form", "n", "candidate", "m").distinct(), ratio)


def insertions_deletions(own: DataFrame, reference: DataFrame, script: Script, *, most: int = 2, least: int = 200, letters: int = 4, ratio: float = 5) -> DataFrame:
    """One letter of the alphabet more or one letter less than a form that the reference has ``least`` times or more.

    No prefix letter is added or dropped at the first place; candidates have two letters or more."""
    r = rare(own, reference, most, letters)
    strong = reference.where(F.col("n") >= least).select(F.col("form").alias("candidate"), F.col("n").alias("m"))
    not_prefix = ~((F.col("at") == 1) & F.col("letter").isin(*script.prefixes)) if script.prefixes else F.lit(True)
    in_alphabet = F.col("letter").isin(*script.alphabet)
    longer = r.join(strong.select("candidate", "m", F.inline(dropped(F.col("candidate")))).where(not_prefix & in_alphabet), F.col("form") == F.col("key"))
    shorter = r.select("form", "n", F.inline(dropped(F.col("form")))).where(not_prefix & (F.length("key") >= 2)).join(strong, F.col("key") == F.col("candidate"))
    some = ["form", "n", "candidate", "m"]
    return dominance(longer.select(some).unionByName(shorter.select(some)).distinct(), ratio)


def dropped_letter(own: DataFrame, keeper: str, lost: str, targets: DataFrame | None = None) -> DataFrame:
    """A letter lost behind the one of a ligature: exactly one filling is attested, and more often than the form.

    With ``targets`` (form) a hit whose filling is among them is high confidence, others ambiguous."""
    at = F.filter(F.sequence(F.lit(1), F.length("form")), lambda i: F.substring(F.col("form"), i, F.lit(1)) == keeper)
    filled = F.array_distinct(F.transform(at, lambda i: F.concat(F.substring(F.col("form"), F.lit(1), i), F.lit(lost), F.substring(F.col("form"), i + 1, F.length("form")))))
    c = own.where(F.instr("form", keeper) > 0).select("form", "n", F.explode(filled).alias("candidate")).join(own.select(F.col("form").alias("candidate"), F.col("n").alias("m")), "candidate")
    one = c.groupBy("form", "n").agg(F.count(F.lit(1)).alias("k"), F.min("candidate").alias("candidate"), F.min("m").alias("m")).where("k = 1 and m > n")
    if targets is None:
        return one.select("form", F.col("n").alias("own_n"), "candidate", F.col("m").alias("candidate_n"), F.lit("ambiguous").alias("verdict"))
    known = targets.select(F.col("form").alias("candidate"), F.lit(True).alias("_t")).distinct()
    return one.join(known, "candidate", "left").select("form", F.col("n").alias("own_n"), "candidate", F.col("m").alias("candidate_n"), F.when(F.col("_t"), "high_confidence").otherwise("ambiguous").alias("verdict"))


def fused_first_letter(own: DataFrame, letter: str) -> DataFrame:
    """Forms that begin with the letter twice and are attested, more often, with one less."""
    c = own.where(F.col("form").startswith(letter * 2) & (F.length("form") > 2)).select("form", F.col("n").alias("own_n"), F.substring("form", 2, 1 << 20).alias("candidate"))
    return c.join(own.select(F.col("form").alias("candidate"), F.col("n").alias("candidate_n")), "candidate").where("candidate_n > own_n").select("form", "own_n", "candidate", "candidate_n")


def merged(own: DataFrame, reference: DataFrame, *, most: int = 2, letters: int = 7, half: int = 3, least: int = 300) -> DataFrame:
    """Long rare forms that part in two frequent ones: the parting whose weaker half is strongest, the first of equals."""
    r = rare(own, reference, most, letters)
    cut = F.transform(F.sequence(F.lit(half), F.length("form") - half), lambda i: F.struct(i.alias("at"), F.substring(F.col("form"), F.lit(1), i).alias("left"), F.substring(F.col("form"), i + 1, F.length("form")).alias("right")))
    strong = reference.where(F.col("n") >= least)
    c = r.select("form", "n", F.inline(cut)).join(strong.select(F.col("form").alias("left"), F.col("n").alias("left_n")), "left").join(strong.select(F.col("form").alias("right"), F.col("n").alias("right_n")), "right")
    best = c.groupBy("form", "n").agg(F.max_by(F.struct("left", "left_n", "right", "right_n"), F.struct(F.least("left_n", "right_n"), -F.col("at"))).alias("b"))
    return best.select("form", F.col("n").alias("own_n"), "b.*")


def split(w: DataFrame, form: Column, own: DataFrame, reference: DataFrame, *, unit: str = "doc_id", letters: int = 3, often: int = 3, least: int = 500) -> DataFrame:
    """Two short neighbours, not both frequent, whose joining is frequent in the reference."""
    order = W.partitionBy(unit).orderBy("word_index")
    p = w.withColumn("left", form).withColumn("right", F.lead("left").over(order)).where(F.length("left").between(1, letters) & F.length("right").between(1, letters)).select(unit, "word_index", "left", "right", F.concat("left", "right").alias("form"))
    strong = reference.where(F.col("n") >= least).select("form", F.col("n").alias("joined_n"))
    hit = p.join(strong, "form")
    a, b = own.select(F.col("form").alias("left"), F.col("n").alias("left_n")), own.select(F.col("form").alias("right"), F.col("n").alias("right_n"))
    return hit.join(a, "left").join(b, "right").where(~((F.col("left_n") > often) & (F.col("right_n") > often))).select(unit, "word_index", "left", "right", "form", "joined_n")


def across_units(w: DataFrame, form: Column, reference: DataFrame, lexicon: DataFrame, *, unit: str = "doc_id", letters: int = 3, units: int = 3) -> DataFrame:
    """Forms in several units that the reference lacks; the lexicon only labels them."""
    per = w.select(unit, form.alias("form")).where(F.length("form") >= letters).groupBy("form", unit).agg(F.count(F.lit(1)).alias("k")).groupBy("form").agg(F.count(F.lit(1)).alias("n_units"), F.sum("k").alias("n")).where(F.col("n_units") >= units)
    return per.join(reference.select("form"), "form", "left_anti").join(lexicon.select("form", F.lit(True).alias("_l")).distinct(), "form", "left").select("form", "n_units", "n", F.coalesce("_l", F.lit(False)).alias("in_lexicon"))


def triage(gaps: DataFrame, lexicon: DataFrame, reference: DataFrame, script: Script, *, corrupt: tuple[str, ...] = (), strong: int = 25, root: int = 25, ligature: int = 50, neighbour: int = 20, part: int = 500) -> DataFrame:
    """Bucket and score of each form outside the lexicon: ``gaps`` has (form, occurrences, all_quoted).

    Signals, one left join each: independent attestation, a root behind one or two prefixes, a lost ligature
    letter, a neighbour one edit off (a confusable substitution first), and a parting in two frequent forms."""
    ref = reference.select("form", F.col("n").alias("attested"))
    g = gaps.join(ref, "form", "left").withColumn("attested", F.coalesce("attested", F.lit(0)))
    bare = g.where("attested = 0").select("form")

    a = bare.select("form", F.inline(blanked(F.col("form"))))
    sure = reference.where(F.col("n") >= neighbour).select(F.col("form").alias("candidate"), F.col("n").alias("m"))
    b = sure.select("candidate", "m", F.inline(blanked(F.col("candidate")))).select("candidate", "m", "key", F.col("letter").alias("other"))
    pairs = F.array(*[F.lit(x) for x in sorted({y for q in script.pairs for y in (q, q[::-1])})])
    sub = a.join(b, "key").where("letter <> other").select("form", "candidate", "m", F.array_contains(pairs, F.concat("letter", "other")).alias("confusable"))
    ins = bare.join(sure.select("candidate", "m", F.inline(dropped(F.col("candidate")))), F.col("form") == F.col("key")).where(F.col("letter").isin(*script.alphabet)).select("form", "candidate", "m", F.lit(False).alias("confusable"))
    gone = bare.select("form", F.inline(dropped(F.col("form")))).join(sure, F.col("key") == F.col("candidate")).select("form", "candidate", "m", F.lit(False).alias("confusable"))
    near = sub.unionByName(ins).unionByName(gone).groupBy("form").agg(F.max_by(F.struct("candidate", "m", "confusable"), F.struct(F.col("confusable").cast("int"), "m", "candidate")).alias("near"))

    heads = F.array(*[F.lit(x) for x in sorted(script.prefixes)]) if script.prefixes else F.array().cast("array<string>")
    cuts = F.filter(F.array(F.lit(1), F.lit(2)), lambda k: (F.length("form") - k >= 2) & F.forall(F.sequence(F.lit(1), k), lambda j: F.array_contains(heads, F.substring(F.col("form"), j, F.lit(1)))) & ((k == 1) | (F.substring(F.col("form"), F.lit(1), F.lit(1)) != F.substring(F.col("form"), F.lit(2), F.lit(1)))))
    rooted = g.select("form", F.explode(F.transform(cuts, lambda k: F.substring(F.col("form"), k + 1, F.length("form")))).alias("root"))
    known = lexicon.select(F.col("form").alias("root"), F.lit(1).alias("_l")).distinct()
    rooted = rooted.join(known, "root", "left").join(reference.select(F.col("form").alias("root"), F.col("n").alias("_n")), "root", "left").where((F.col("_l") == 1) | (F.col("_n") >= root))
    rooted = rooted.groupBy("form").agg(F.max_by("root", F.struct(F.coalesce("_l", F.lit(0)), F.coalesce("_n", F.lit(0)), F.length("root"))).alias("root"))

    keeper, lost = script.infix
    if keeper:
        at = F.filter(F.sequence(F.lit(1), F.length("form")), lambda i: F.substring(F.col("form"), i, F.lit(1)) == keeper)
        fill = g.select("form", F.explode(F.transform(at, lambda i: F.concat(F.substring(F.col("form"), F.lit(1), i), F.lit(lost), F.substring(F.col("form"), i + 1, F.length("form"))))).alias("target"))
        shape = fill.join(reference.where(F.col("n") >= ligature).select(F.col("form").alias("target"), F.col("n").alias("_n")), "target").groupBy("form").agg(F.max_by("target", F.struct("_n", "target")).alias("target"))
    else:
        shape = g.select("form", F.lit(None).cast("string").alias("target")).where("false")

    halves = F.transform(F.sequence(F.lit(2), F.length("form") - 2), lambda i: F.struct(F.substring(F.col("form"), F.lit(1), i).alias("l"), F.substring(F.col("form"), i + 1, F.length("form")).alias("r")))
    often = reference.where(F.col("n") >= part)
    parted = bare.where(F.length("form") >= 5).select("form", F.inline(halves)).join(often.select(F.col("form").alias("l")), "l").join(often.select(F.col("form").alias("r")), "r").select("form", F.lit(True).alias("parts")).distinct()

    g = g.join(near, "form", "left").join(rooted, "form", "left").join(shape, "form", "left").join(parted, "form", "left")
    is_corrupt = F.col("form").isin(*corrupt) if corrupt else F.lit(False)
    quoted, confusable = F.col("all_quoted"), F.coalesce(F.col("near.confusable"), F.lit(False))
    bucket = (
        F.when(confusable & (F.col("attested") == 0) & ~quoted, "ocr_shape_to_read")
        .when(quoted, "abbreviation_artifact")
        .when(is_corrupt, "known_corrupt_form")
        .when(F.col("attested") >= strong, "independently_attested")
        .when(F.col("root").isNotNull(), "prefix_resolved")
        .when(F.col("attested") > 0, "weakly_attested")
        .otherwise("unresolved")
    )
    points = lambda cond, k: F.when(cond, k).otherwise(0)
    score = points(is_corrupt, 10) + F.when(F.col("attested") == 0, 3).when(F.col("attested") < strong, 1).otherwise(0) + points(F.col("root").isNull(), 2) + points(F.col("occurrences") == 1, 1) + points(F.col("target").isNotNull(), 3) + F.when(F.col("near").isNull(), 0).when(confusable, 3).otherwise(2) + points(F.col("parts").isNotNull(), 1) + points(F.length("form") >= 9, 1) - points(quoted, 4)
    return g.select("form", "occurrences", "attested", F.col("near.candidate").alias("neighbour"), confusable.alias("confusable"), "root", "target", F.col("parts").isNotNull().alias("parts"), bucket.alias("bucket"), score.cast("int").alias("score"))


def resolve_abbreviations(forms: DataFrame, dictionary: DataFrame, reference: DataFrame, script: Script, *, over: int = 50, ratio: float = 5, endings: str = "") -> DataFrame:
    """Category of each abbreviated form (form, stem): dictionary (stem, expansion, category) by root, then by one or
    two prefixes and the longest root, then completion by one final letter, then a short numeral, else unresolved."""
    heads = F.array(*[F.lit(x) for x in sorted(script.prefixes)]) if script.prefixes else F.array().cast("array<string>")
    cut = F.filter(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: (F.length("stem") > k) & ((k == 0) | F.forall(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), lambda j: F.array_contains(heads, F.substring(F.col("stem"), j, F.lit(1))))) & ((k < 2) | (F.substring(F.col("stem"), F.lit(1), F.lit(1)) != F.substring(F.col("stem"), F.lit(2), F.lit(1)))))
    parts = forms.select("form", "stem", F.explode(cut).alias("k")).withColumn("root", F.expr("substring(stem, k + 1)"))
    found = parts.join(dictionary.select(F.col("stem").alias("root"), "expansion", "category"), "root").groupBy("form").agg(F.min_by(F.struct("k", "root", "expansion", "category"), F.struct("k", "expansion")).alias("d"))
    ends = F.array(*[F.lit(x) for x in sorted(set(endings or script.alphabet))])
    full = forms.select("form", F.explode(F.transform(ends, lambda e: F.concat(F.col("stem"), e))).alias("candidate"), F.lit(1).alias("n")).join(reference.where(F.col("n") > over).select(F.col("form").alias("candidate"), F.col("n").alias("m")), "candidate")
    one = dominance(full, ratio).where("verdict = 'high_confidence'").select("form", F.col("candidate").alias("completion"))
    j = forms.join(found, "form", "left").join(one, "form", "left")
    category = F.when(F.col("d.k") == 0, F.col("d.category")).when(F.col("d.k") > 0, F.concat(F.lit("prefix_"), F.col("d.category"))).when(F.col("completion").isNotNull(), "truncated").when(F.length("stem") <= 2, "numeral").otherwise("unresolved")
    return j.select("form", "stem", category.alias("category"), F.coalesce("d.expansion", "completion").alias("expansion"))


def tier(left: Column, right: Column, known_left: Column, known_right: Column) -> Column:
    """A, B, C or D of two readings by whether every word of either is known; D is the one not of high value."""
    return F.when(left.isNull() | right.isNull(), "C").when(known_right & ~known_left, "A").when(known_left & known_right, "B").when(~known_left & ~known_right, "C").otherwise("D")


def verdict(tokens: Column, a: Column, b: Column) -> Column:
    """Which of two readings a third witness' tokens contain."""
    has = lambda x: (F.size(x) > 0) & (F.size(F.array_except(x, tokens)) == 0)
    return F.when(F.size(tokens) == 0, "UNREADABLE").when(has(a) & has(b), "BOTH").when(has(a), "A").when(has(b), "B").otherwise("THIRD")
