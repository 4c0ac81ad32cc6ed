"""Sequential decisions: a monotone cursor over pages, and the order of titles. One fold per part by nature."""

from __future__ import annotations

import difflib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Rules:
    """The thresholds of the marker search."""

    clear: float = 0.5
    floor: float = 0.15
    anchor: float = 0.75
    margin: float = 0.125
    words: int = 8
    comparable: int = 4
    letters: int = 4
    pages: int = 2


def _agree(got: list[str], forms: list[list[str]]) -> float:
    return max((difflib.SequenceMatcher(None, got, f, autojunk=False).ratio() for f in forms), default=0.0) if got else 0.0


def trace_part(units: list[dict], tokens: list[dict], rules: Rules = Rules(), confirm=None) -> list[dict]:
    """Marker of each unit in id order, never before the last one found.

    units: unit_id, exact (spellings), near (spellings one confusion off), forms (openings as word lists).
    tokens in reading order: page, rank, index, word, in_band. confirm(unit, token) -> True, False or None."""
    at, out, misses = -1, [], 0
    spot = [{**t, "seq": k} for k, t in enumerate(tokens)]
    words = [(k, t["word"]) for k, t in enumerate(spot) if t["word"]]
    place = {k: i for i, (k, _) in enumerate(words)}

    def following(k):
        page, got = spot[k]["page"], []
        for q in range(k + 1, len(spot)):
            if spot[q]["page"] != page or len(got) == rules.words:
                break
            if spot[q]["word"]:
                got.append(spot[q]["word"])
        return got

    for u in sorted(units, key=lambda u: u["unit_id"]):
        forms = [f[: rules.words] for f in u["forms"] if f]
        here = spot[at]["page"] if at >= 0 else (spot[0]["page"] if spot else 0)
        limit = here + rules.pages + misses
        tiers = {0: [], 1: []}
        for k in range(at + 1, len(spot)):
            t = spot[k]
            tier = 0 if t["word"] in u["exact"] else 1 if t["word"] in u["near"] else None
            if tier is not None and t["in_band"]:
                tiers[tier].append((k, _agree(following(k), forms)))
        near_by = {n: [c for c in tiers[n] if spot[c[0]]["page"] <= limit] for n in tiers}

        def earliest(cands):
            return next((c for c in cands if c[1] >= rules.clear), None)

        chosen, how, share = None, None, None
        if not any(len(f) >= rules.comparable for f in forms):
            if near_by[0]:
                chosen, how = near_by[0][0][0], "positional"
            elif confirm:
                chosen = next((k for k, _ in near_by[1] if confirm(u, spot[k]) is True), None)
                how = "positional"
            status = "marker_found_content_mismatch"
        else:
            status = "ok"
            c = earliest(tiers[0])
            if c:
                chosen, share, how = *c, "exact"
                rivals = [r for r in tiers[0] if r[1] >= rules.clear and r != c and abs(r[1] - c[1]) <= rules.margin]
                if rivals and confirm:
                    for r in [c, *rivals]:
                        if confirm(u, spot[r[0]]) is True:
                            chosen, share, how = *r, "confirmed"
                            break
            elif c := earliest(tiers[1]):
                chosen, share, how = *c, "near"
            elif forms:
                want = forms[0]
                for k, w in words[place.get(at, -1) + 1 :] if at >= 0 else words:
                    if k <= at + 1 or w != want[0] or spot[k]["page"] > limit or spot[k]["page"] != spot[k - 1]["page"]:
                        continue
                    seg = [w, *following(k)][: rules.words]
                    m = spot[k - 1]
                    if len(seg) == rules.words and (r := _agree(seg, [want])) >= rules.anchor and m["in_band"] and 0 < len(m["word"]) <= rules.letters:
                        chosen, share, how = k - 1, r, "anchored"
                        break
            if chosen is None:
                weak = max(near_by[0], key=lambda c: (c[1], -c[0]), default=None)
                verdict = confirm(u, spot[weak[0]]) if weak and confirm and weak[1] >= rules.floor else None
                if weak and verdict is not False:
                    chosen, share, how = *weak, "confirmed" if verdict else "weak"
                    status = "ok" if verdict else "marker_found_content_mismatch"
                elif confirm:
                    c = max(near_by[1], key=lambda c: (c[1], -c[0]), default=None)
                    if c and c[1] >= rules.floor and confirm(u, spot[c[0]]) is True:
                        chosen, share, how = *c, "confirmed"
        if chosen is None:
            misses += 1
            out.append({"unit_id": u["unit_id"], "page": here, "marker_position": None, "ratio": None, "status": "marker_not_found_in_window", "how": None})
        else:
            at, misses = chosen, 0
            out.append({"unit_id": u["unit_id"], "page": spot[chosen]["page"], "marker_position": spot[chosen]["index"], "ratio": None if share is None else round(share, 3), "status": status, "how": how})
    return out


def trace(units: DataFrame, tokens: DataFrame, rules: Rules = Rules(), confirm=None) -> DataFrame:
    """``trace_part`` for each part: units (part, unit_id, exact, near, forms), tokens (part, page, rank, index, word, in_band)."""

    def fold(key, u: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        us = [{"unit_id": int(r.unit_id), "exact": set(r.exact), "near": set(r.near), "forms": [list(f) for f in r.forms]} for r in u.itertuples()]
        ts = t.sort_values(["page", "rank"])[["page", "rank", "index", "word", "in_band"]].to_dict("records")
        rows = trace_part(us, ts, rules, confirm)
        return pd.DataFrame(rows, columns=["unit_id", "page", "marker_position", "ratio", "status", "how"]).assign(part=key[0]).astype({"marker_position": "Int64"})

    return units.groupBy("part").cogroup(tokens.groupBy("part")).applyInPandas(fold, "part long, unit_id long, page long, marker_position long, ratio double, status string, how string")


def isotonic(ranks: list[int], size: int) -> list[int]:
    """The non-decreasing labels that keep most of the ranks; of equals, the smallest last label and back."""
    best, back = [0] * size, []
    for r in ranks:
        choice, top, new = [], 0, []
        for k in range(size):
            if best[k] > best[top]:
                top = k
            choice.append(top)
            new.append(best[top] + (k == r))
        best = new
        back.append(choice)
    k, out = max(range(size), key=lambda q: best[q]) if ranks else 0, []
    for choice in reversed(back):
        out.append(k)
        k = choice[k]
    return out[::-1]


def title_order(titles: DataFrame, alphabet: str) -> DataFrame:
    """Titles out of alphabetical order within their part, and those whose first character has no rank.

    titles: (part, unit_id, title); blank titles are passed over. A part is one sequence, so one task."""

    def fold(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("unit_id")
        f = f[f["title"].fillna("").str.strip() != ""]
        first = f["title"].str.strip().str[0]
        known = first.isin(list(alphabet))
        kept = isotonic([alphabet.index(c) for c in first[known]], len(alphabet))
        a = pd.DataFrame({"part": f["part"][known], "unit_id": f["unit_id"][known], "letter": first[known], "expected": [alphabet[k] for k in kept]})
        b = pd.DataFrame({"part": f["part"][~known], "unit_id": f["unit_id"][~known], "letter": first[~known], "expected": None})
        return pd.concat([a[a["letter"] != a["expected"]], b])

    return titles.select(F.col("part").cast("string"), F.col("unit_id").cast("long"), "title").groupBy("part").applyInPandas(fold, "part string, unit_id long, letter string, expected string")
