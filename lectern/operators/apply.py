"""Accepted decisions put into the texts: array expressions for one edit, a fold per unit for many."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def put(ws: Column, index: Column, old: Column, new: Column) -> Column:
    """Words with ``old`` at ``index`` replaced by ``new``; null if ``old`` is not there, or the index is out of range.

    An empty ``old`` inserts, unless ``new`` stands there already; an empty ``new`` removes."""
    n, at = F.size(old), F.greatest(index, F.lit(0))
    there = (index >= 0) & (index + n <= F.size(ws)) & (F.slice(ws, at + 1, n) == old)
    again = (n == 0) & ((F.size(new) == 0) | (F.slice(ws, at + 1, F.size(new)) == new))
    edited = F.concat(F.slice(ws, F.lit(1), at), new, F.slice(ws, at + n + 1, F.size(ws)))
    return F.when(there & ~again, edited)


def edit(words: list[str], op: str, index: int, old: str | None, new: str | None) -> list[str] | None:
    """One edit of a list, None if the text is no longer what the decision saw.

    replace: ``old`` by ``new``; insert: ``old`` goes; delete: ``new`` comes, but not twice; manual: one word by one
    word, or by nothing, or ``new`` before it if ``old`` is null."""
    before, after = (old or "").split(), (new or "").split()
    if index is None or index < 0:
        return None
    if op == "delete" or op == "manual" and old is None:
        if index > len(words) or not after or words[index : index + len(after)] == after:
            return None
        return words[:index] + after + words[index:]
    if not before or words[index : index + len(before)] != before:
        return None
    if op == "insert":
        after = []
    return words[:index] + after + words[index + len(before) :]


RESULT = "unit_id long, text string, id string, outcome string"


def apply_decisions(units: DataFrame, decisions: DataFrame) -> DataFrame:
    """(unit_id, text, id, outcome): every decision's outcome and, beside it, its unit's text after all of them.

    decisions: (id, unit_id, word_index, op, old, new), current and not yet applied. Machine edits go first, then
    manual ones, by index and id; one edit that changes the number of words is done in a unit and run, later ones
    wait (``deferred``), so that indices stay true. Units without decisions are left out: join to find them."""

    def fold(key, u: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(d):
            return pd.DataFrame(columns=["unit_id", "text", "id", "outcome"])
        d = d.assign(_m=d["op"].eq("manual")).sort_values(["_m", "word_index", "id"])
        if not len(u):
            return pd.DataFrame({"unit_id": key[0], "text": None, "id": d["id"], "outcome": "missing"})
        text, moved, out = u["text"].iloc[0] or "", False, []
        words = text.split()
        for r in d.itertuples():
            old = None if pd.isna(r.old) else r.old
            new = None if pd.isna(r.new) else r.new
            if pd.isna(r.word_index):
                out.append("drift")
                continue
            if moved and (r.op in ("insert", "delete") or len((old or "").split()) != len((new or "").split())):
                out.append("deferred")  # its index may be off by now
                continue
            got = edit(words, r.op, int(r.word_index), old, new)
            if got is None:
                out.append("drift")
            else:
                out.append("confirmed" if got == words else "applied")
                moved = moved or len(got) != len(words)
                words = got
        return pd.DataFrame({"unit_id": key[0], "text": " ".join(words), "id": d["id"], "outcome": out})

    u = units.select(F.col("unit_id").cast("long"), "text")
    d = decisions.select("id", F.col("unit_id").cast("long"), F.col("word_index").cast("double"), "op", "old", "new")
    return u.groupBy("unit_id").cogroup(d.groupBy("unit_id")).applyInPandas(fold, RESULT)


def apply_punctuation(units: DataFrame, accepted: DataFrame) -> DataFrame:
    """Like ``apply_decisions`` for marks put behind words: (id, unit_id, before_word_index, word_before, word_after, mark).

    Descending by index; the neighbours, as they were before this run, must be those that the proposal saw."""

    def fold(key, u: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        if not len(u) or not len(d):
            return pd.DataFrame({"unit_id": key[0], "text": None, "id": d["id"], "outcome": "missing"}) if len(d) else pd.DataFrame(columns=["unit_id", "text", "id", "outcome"])
        words, out = (u["text"].iloc[0] or "").split(), []
        seen = list(words)
        d = d.sort_values(["before_word_index", "id"], ascending=[False, True])
        for r in d.itertuples():
            i = int(r.before_word_index)
            if 0 < i < len(seen) and seen[i - 1] == r.word_before and seen[i] == r.word_after:
                words[i - 1] += r.mark
                out.append("applied")
            else:
                out.append("drift")
        return pd.DataFrame({"unit_id": key[0], "text": " ".join(words), "id": d["id"], "outcome": out})

    return units.select(F.col("unit_id").cast("long"), "text").groupBy("unit_id").cogroup(accepted.withColumn("unit_id", F.col("unit_id").cast("long")).groupBy("unit_id")).applyInPandas(fold, RESULT)
