"""Alignment of two word sequences by the longest matching block, in Arrow batches.

The matcher is the standard library's; ``autojunk`` is part of the semantics. All pairs are aligned, unless a
``limit`` is asked for: then pairs with more words on a side are returned with the tag ``guarded`` instead.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType

OPCODES = "tag string, i1 int, i2 int, j1 int, j2 int"


def opcodes(pairs: DataFrame, *key: str, autojunk: bool = False, limit: int | None = None, equal: bool = True) -> DataFrame:
    """(key..., tag, i1, i2, j1, j2) of each row's word arrays ``a`` and ``b``."""
    kinds = ", ".join(f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in key)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                a, b = list(r.a), list(r.b)
                if limit is not None and max(len(a), len(b)) > limit:
                    ops = [("guarded", 0, len(a), 0, len(b))]
                elif a == b and not autojunk:  # what the matcher finds, without its search
                    ops = [("equal", 0, len(a), 0, len(b))] if a else []
                else:
                    ops = difflib.SequenceMatcher(None, a, b, autojunk=autojunk).get_opcodes()
                rows += [(*r[: len(key)], *o) for o in ops if equal or o[0] != "equal"]
            yield pd.DataFrame(rows, columns=[*key, "tag", "i1", "i2", "j1", "j2"])

    return pairs.select(*key, "a", "b").mapInPandas(run, f"{kinds}, {OPCODES}")


def positions(ops: DataFrame, *key: str, replaced: bool = False) -> DataFrame:
    """(key..., i, j): where each word of a stands in b; with ``replaced`` also words of equally long replacements."""
    use = ops.where(F.col("tag") == "equal") if not replaced else ops.where((F.col("tag") == "equal") | ((F.col("tag") == "replace") & (F.col("i2") - F.col("i1") == F.col("j2") - F.col("j1"))))
    return use.select(*key, F.explode(F.sequence(F.lit(0), F.col("i2") - F.col("i1") - 1)).alias("_d"), "i1", "j1").select(*key, (F.col("i1") + F.col("_d")).alias("i"), (F.col("j1") + F.col("_d")).alias("j"))


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two strings by characters; null with null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def word_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two word arrays."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, list(x), list(y), autojunk=False).ratio() for x, y in zip(a, b)], dtype="float64")


def candidates(ops: DataFrame, a: DataFrame, b: DataFrame, *key: str, span: int = 4, least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Word-level disagreements and those left out with a reason.

    ops: opcodes of texts a (fresh reading) against b (stored); a, b: (key..., words). A side of over ``span`` words
    is left out; a replacement needs as many words on both sides and a character similarity of ``least``."""
    d = ops.where("tag <> 'equal'").join(a.select(*key, F.col("words").alias("_a")), list(key)).join(b.select(*key, F.col("words").alias("_b")), list(key))
    part = lambda w, lo, hi: F.when(F.col(hi) > F.col(lo), F.array_join(F.slice(w, F.col(lo) + 1, F.col(hi) - F.col(lo)), " "))
    d = d.withColumn("ocr_reading", part("_a", "i1", "i2")).withColumn("stored_text", part("_b", "j1", "j2"))
    long = (F.col("i2") - F.col("i1") > span) | (F.col("j2") - F.col("j1") > span)
    unequal = (F.col("tag") == "replace") & (F.col("i2") - F.col("i1") != F.col("j2") - F.col("j1"))
    d = d.withColumn("_sim", F.when((F.col("tag") == "replace") & ~long & ~unequal, ratio("ocr_reading", "stored_text")))
    reason = F.when(F.col("tag") == "guarded", "guarded").when(long, "long_span").when(unequal, "unequal_words").when(F.coalesce(F.col("_sim"), F.lit(1.0)) < least, "unlike")
    d = d.withColumn("reason", reason).select(*key, F.col("tag").alias("opcode"), F.col("j1").alias("word_index"), "ocr_reading", "stored_text", "reason")
    return d.where("reason is null").drop("reason"), d.where("reason is not null")


def owners(deletes: DataFrame, spans: DataFrame, page: str = "page") -> DataFrame:
    """The unit before each gap of a page's joined words, with the index at its end: spans (page, unit_id, start, size).

    A gap before the first word has no owner."""
    j = deletes.join(spans, page).where((F.col("j1") > F.col("start")) & (F.col("j1") <= F.col("start") + F.col("size")))
    found = j.select(*deletes.columns, "unit_id", (F.col("j1") - F.col("start")).alias("word_index"))
    return found.unionByName(deletes.where("j1 = 0"), allowMissingColumns=True)


def consensus(first: DataFrame, second: DataFrame, *key: str) -> DataFrame:
    """Where two witnesses agree with each other against the text: both (key..., i, reading), of replaced words."""
    return first.select(*key, "i", "reading").join(second.select(*key, "i", F.col("reading").alias("_r")), [*key, "i"]).where("reading = _r").drop("_r")


def readings(ops: DataFrame, a: DataFrame, *key: str) -> DataFrame:
    """(key..., i, reading) of single words replaced one by one: where a witness reads something else. ops: opcodes of the
    text against the witness, a: (key..., words) of the witness."""
    one = ops.where("tag = 'replace' and i2 - i1 = j2 - j1").join(a, list(key))
    return one.select(*key, "i1", "j1", "words", F.explode(F.sequence(F.lit(0), F.col("i2") - F.col("i1") - 1)).alias("_d")).select(*key, (F.col("i1") + F.col("_d")).alias("i"), F.get("words", F.col("j1") + F.col("_d")).alias("reading"))


def fresh(disputes: DataFrame, candidates: DataFrame, decisions: DataFrame, *key: str, types: tuple[str, ...] = ()) -> DataFrame:
    """Disputes (key..., i) that are neither a candidate yet nor decided on, by a decision of ``types`` (any, if none)."""
    d = decisions.where(F.col("decision_type").isin(*types)) if types else decisions
    known = candidates.select(*key, "i").unionByName(d.select(*key, "i")).distinct()
    return disputes.join(known, [*key, "i"], "left_anti")


def witness_verdict(candidates: DataFrame, read: DataFrame, *key: str) -> DataFrame:
    """What a witness (key..., i, reading) says of candidates (key..., i, ocr_reading, stored_text): which of the two it
    confirms, a third reading, or that it has none at that place."""
    j = candidates.join(read.select(*key, "i", F.col("reading").alias("_r")), [*key, "i"], "left")
    return j.withColumn("verdict", F.when(F.col("_r").isNull(), "unaligned").when(F.col("_r").eqNullSafe(F.col("ocr_reading")), "corrected").when(F.col("_r").eqNullSafe(F.col("stored_text")), "original").otherwise("third")).drop("_r")


def accuracy(ops: DataFrame, sizes: DataFrame, *key: str) -> DataFrame:
    """Matches over truth words of all pairs together: (matched, truth_words, rate).

    Pairs guarded by a limit have no matches but count in truth_words."""
    m = ops.where("tag = 'equal'").agg(F.coalesce(F.sum(F.col("i2") - F.col("i1")), F.lit(0)).alias("matched"))
    t = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("truth_words"))
    return m.join(t).withColumn("rate", F.col("matched") / F.greatest("truth_words", F.lit(1)))


def gaps(ops: DataFrame, *key: str, least: int = 8) -> DataFrame:
    """Deleted or replaced runs of ``least`` words or more."""
    return ops.where(F.col("tag").isin("delete", "replace") & (F.col("i2") - F.col("i1") >= least))
