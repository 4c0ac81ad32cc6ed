"""Positioned words and operators on neighbouring ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import alnum, words


def positioned(units: DataFrame, unit: str = "doc_id", text: str = "text", *carry: str) -> DataFrame:
    """(unit, word_index, word): the relation that most operators read; indices count from 0."""
    return units.select(unit, *carry, F.posexplode(words(F.col(text))).alias("word_index", "word"))


def repeated(w: DataFrame, form: Column, unit: str = "doc_id", allowed: tuple[str, ...] = (), least: int = 1) -> DataFrame:
    """Words whose form, not empty, is that of the next word."""
    here = F.col("_n")
    after = F.lead("_n").over(W.partitionBy(unit).orderBy("word_index"))
    hit = w.withColumn("_n", form).withColumn("_x", after).where((here == F.col("_x")) & (F.length(here) >= least))
    return (hit.where(~here.isin(*allowed)) if allowed else hit).drop("_n", "_x")


def context(w: DataFrame, spots: DataFrame, before: int, after: int, unit: str = "doc_id") -> DataFrame:
    """Spots (unit, word_index, ...) with the words around them, ``after`` exclusive; spots that are no word are left out."""
    around = W.partitionBy(unit).orderBy("word_index").rowsBetween(-before, after - 1)
    return spots.join(w.select(unit, "word_index", F.array_join(F.collect_list("word").over(around), " ").alias("context")), [unit, "word_index"])


def grams(units: DataFrame, n: int, unit: str = "doc_id", text: str = "text") -> DataFrame:
    """(unit, position, gram) of all runs of n words."""
    u = units.select(unit, words(F.col(text)).alias("ws")).where(F.size("ws") >= n)
    runs = F.transform(F.sequence(F.lit(1), F.size("ws") - (n - 1)), lambda i: F.array_join(F.slice("ws", i, n), " "))
    return u.select(unit, F.posexplode(runs).alias("position", "gram"))


def _hashed(ws: Column, n: int) -> Column:
    """The 64-bit hash of each run of n words, in order."""
    return F.when(F.size(ws) >= n, F.transform(F.sequence(F.lit(1), F.size(ws) - (n - 1)), lambda i: F.xxhash64(F.slice(ws, i, n)))).otherwise(F.array().cast("array<long>"))


def repeated_grams(units: DataFrame, n: int, unit: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of n words that come again without overlap: each compared with its first place in the unit.

    A unit is one row, so repeats are found in it, among sorted hashes; only the runs whose hash repeats become
    strings, which decide, and are shuffled."""
    places = F.sort_array(F.transform(_hashed(F.col("ws"), n), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.filter("_p", lambda x, k: (x["h"] == F.get("_p", k - 1)["h"]) | (x["h"] == F.get("_p", k + 1)["h"]))
    u = units.select(unit, words(F.col(text)).alias("ws")).withColumn("_p", places).withColumn("_p", twice)
    hits = u.select(unit, F.inline(F.transform("_p", lambda x: F.struct(x["i"].alias("position"), F.array_join(F.slice("ws", x["i"] + 1, n), " ").alias("gram")))))
    first = F.min("position").over(W.partitionBy(unit, "gram"))
    return hits.withColumn("first_position", first).where(F.col("position") - F.col("first_position") >= n).select(unit, "gram", "first_position", "position")


def shared_with_next(units: DataFrame, n: int, unit: str = "doc_id", text: str = "text") -> DataFrame:
    """Grams that a unit shares with the unit next in order, ids need not follow each other by one.

    The order is found on ids alone, by rank within ranges of ids, so no task orders them all. Units meet as arrays of
    hashes; only of the few that share one are the strings compared. Rows of one id are one unit."""
    chain = next_of(units.select(unit).distinct(), unit).where("next_id is not null")
    every = units.select(unit, words(F.col(text)).alias("ws"))
    h = every.select(unit, F.array_distinct(_hashed(F.col("ws"), n)).alias("_h"))
    met = chain.join(h, unit).join(h.select(F.col(unit).alias("next_id"), F.col("_h").alias("_g")), "next_id")
    # a generator, so that the condition is not computed twice
    met = met.select(unit, "next_id", F.explode(F.array(F.array_intersect("_h", "_g"))).alias("_both")).where(F.size("_both") > 0)

    def strings(of: str) -> DataFrame:
        side = met.join(every.withColumnRenamed(unit, of), of)
        at = F.filter(F.transform(_hashed(F.col("ws"), n), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: F.array_contains("_both", s["x"]))
        return side.select(unit, "next_id", F.explode(F.transform(at, lambda s: F.array_join(F.slice("ws", s["i"] + 1, n), " "))).alias("gram")).distinct()

    return strings(unit).join(strings("next_id"), [unit, "next_id", "gram"])


def next_of(ids: DataFrame, unit: str, width: int = 1 << 16) -> DataFrame:
    """(unit, next_id): the next larger id. Ids are ordered in stretches of ``width`` values; the ends of
    stretches, one row each, are linked apart."""
    b = ids.where(F.col(unit).isNotNull()).withColumn("_b", F.floor(F.col(unit) / width))
    inside = b.withColumn("next_id", F.lead(unit).over(W.partitionBy("_b").orderBy(unit)))
    ends = b.groupBy("_b").agg(F.min(unit).alias("_lo"))
    linked = ends.select(F.col("_b"), F.lead("_lo").over(W.orderBy("_b")).alias("_next"))
    return inside.join(linked, "_b").select(unit, F.coalesce("next_id", "_next").alias("next_id"))


def plain_repeats(units: DataFrame, unit: str = "doc_id", text: str = "text") -> DataFrame:
    return repeated(positioned(units, unit, text), alnum(F.col("word")), unit)
