"""Frequencies and what follows from them by joins with other frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def frequency(w: DataFrame, form: Column, name: str = "form") -> DataFrame:
    """(form, n), empty forms left out; summed before the shuffle."""
    return w.select(form.alias(name)).where(F.col(name) != "").groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def summary(freq: DataFrame) -> DataFrame:
    return freq.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"), F.count(F.lit(1)).alias("unique_forms"), F.count_if(F.col("n") == 1).alias("hapax_count"))


def by_book(w: DataFrame, form: Column, book: str) -> DataFrame:
    """Words and forms of every book, books without words too, with the grand total under null."""
    per = w.select(book, form.alias("form")).groupBy(book, "form").agg(F.count_if(F.col("form") != "").alias("n"))
    books = per.groupBy(book).agg(F.sum("n").alias("total_words"), F.count_if(F.col("n") > 0).alias("unique_forms"))
    forms = per.where("n > 0").groupBy("form").agg(F.sum("n").alias("n"))
    return books.unionByName(forms.agg(F.lit(None).cast("string").alias(book), F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"), F.count(F.lit(1)).alias("unique_forms")))


def spread(w: DataFrame, form: Column, unit: str, least: int, letters: int = 1) -> DataFrame:
    """Forms of ``letters`` letters in ``least`` units or more: (form, n_units, n, unit_ids in order)."""
    per = w.select(unit, form.alias("form")).where(F.length("form") >= letters).groupBy("form", unit).agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy("form").agg(F.count(F.lit(1)).alias("n_units"), F.sum("k").alias("n"), F.array_join(F.sort_array(F.collect_list(unit)), ",").alias("unit_ids")).where(F.col("n_units") >= least)


def unknown(w: DataFrame, form: Column, lexicon: DataFrame, unit: str) -> DataFrame:
    """Forms outside the lexicon: occurrences, units, different surfaces and the first place."""
    f = w.withColumn("form", form).where("form <> ''").groupBy("form", unit, "word").agg(F.count(F.lit(1)).alias("_k"), F.min("word_index").alias("_i"))
    f = f.join(lexicon.select("form").distinct(), "form", "left_anti")
    surfaces = f.groupBy("form", "word").agg(F.lit(1).alias("_s")).groupBy("form").agg(F.count(F.lit(1)).alias("n_surfaces"))
    per = f.groupBy("form", unit).agg(F.sum("_k").alias("_k"), F.min("_i").alias("_i"))
    per = per.groupBy("form").agg(F.sum("_k").alias("occurrences"), F.count(unit).alias("n_units"), F.min(F.struct(unit, "_i")).alias("_at"))
    return per.join(surfaces, "form").select("form", "occurrences", "n_units", "n_surfaces", F.col(f"_at.{unit}").alias("first_unit"), F.col("_at._i").alias("first_index"))


def attestation(lexicon: DataFrame, reference: DataFrame) -> DataFrame:
    """How much of a lexicon a reference attests."""
    j = lexicon.join(reference.select("form", F.col("n").alias("m")), "form", "left")
    return j.agg(F.count(F.lit(1)).alias("lexicon_forms"), F.count_if(F.col("m") > 0).alias("attested"), F.count_if(F.coalesce(F.col("m"), F.lit(0)) == 0).alias("unattested"))


def forms_by_unit(w: DataFrame, form: Column, unit: str) -> DataFrame:
    """(form, unit, n, first_index): a relation, so that a common form is no row that grows with the corpus."""
    return w.select(unit, "word_index", form.alias("form")).where("form <> ''").groupBy("form", unit).agg(F.count(F.lit(1)).alias("n"), F.min("word_index").alias("first_index"))
