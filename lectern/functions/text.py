"""Column functions on text: normal forms, numerals, phrases and lenient parsing."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# White space as the tokeniser sees it, besides what (?U)\s matches.
SPACE = r"(?U)[\s\x1c-\x1f]+"
# Marks of abbreviations.
ABBREVIATION = "[\"'׳״]"
# Numeral letters and their worth.
NUMERALS = {
    "א": 1, "ב": 2, "ג": 3, "ד": 4, "ה": 5, "ו": 6, "ז": 7, "ח": 8, "ט": 9,
    "י": 10, "כ": 20, "ל": 30, "מ": 40, "נ": 50, "ס": 60, "ע": 70, "פ": 80,
    "צ": 90, "ק": 100, "ר": 200, "ש": 300, "ת": 400,
}
# Letters that take a final form at the end of a numeral of several letters.
FINALS = {"נ": "ן", "פ": "ף", "צ": "ץ"}


@dataclass(frozen=True)
class Script:
    """What a detector needs to know of a writing system."""

    letters: str  # a character class without brackets
    alphabet: str
    pairs: tuple[str, ...]  # confusable letters
    prefixes: str = ""
    infix: tuple[str, str] = ("", "")  # a letter that a ligature drops, behind the one that keeps


# The letters that scans of this script confuse, its proclitics, and its ligature.
HEBREW = Script(
    "א-ת",
    "אבגדהוזחטיכךלמםנןסעפףצץקרשת",
    ("בכ", "דר", "הר", "הד", "הח", "טמ", "ספ", "גנ", "סם", "וי", "רת", "הת", "וז", "כן", "נן"),
    "והבכלמשד",
    ("א", "ל"),
)
LATIN = Script("a-zäöüßéèêëàâçñáíóúïîôû", "abcdefghijklmnopqrstuvwxyz", ("ao", "ae", "oe", "nh", "nr", "rt", "lt", "il", "dn", "st", "ei", "hd"), "", ("t", "h"))


def words(text: Column) -> Column:
    """Words between runs of white space, Unicode's and the four separators included; none for null."""
    return F.coalesce(F.filter(F.split(text, SPACE), lambda x: x != ""), F.array().cast("array<string>"))


def alnum(word: Column) -> Column:
    """Letters and digits of any script."""
    return F.regexp_replace(word, r"[^\p{L}\p{N}]", "")


def letters(word: Column, script: Script) -> Column:
    return F.regexp_replace(word, f"[^{script.letters}]", "")


def is_abbreviation(word: Column) -> Column:
    return word.rlike(ABBREVIATION)


def numeral(n: Column) -> Column:
    """The numeral of a positive integer; 15 and 16 are nine and six, nine and seven."""
    rest = n % 100
    tens = F.when(rest.isin(15, 16), "ט").otherwise(F.substring(F.lit(" יכלמנסעפצ"), (rest / 10).cast("int") + 1, F.lit(1)))
    ones = F.when(rest == 15, "ו").when(rest == 16, "ז").otherwise(F.substring(F.lit(" אבגדהוזחט"), (n % 10).cast("int") + 1, F.lit(1)))
    hundreds = (n % 400 / 100).cast("int")
    whole = F.regexp_replace(F.concat(F.repeat(F.lit("ת"), (n / 400).cast("int")), F.substring(F.lit(" קרש"), hundreds + 1, F.lit(1)), tens, ones), " ", "")
    last = F.translate(F.right(whole, F.lit(1)), "".join(FINALS), "".join(FINALS.values()))
    return F.when(F.length(whole) > 1, F.concat(F.left(whole, F.length(whole) - 1), last)).otherwise(whole)


def numeral_value(text: Column) -> Column:
    """The sum of its letters; other characters, final forms too, count nothing."""
    worth = F.create_map(*[F.lit(x) for kv in NUMERALS.items() for x in kv])
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: a + F.coalesce(F.try_element_at(worth, c), F.lit(0)))


def without_markup(text: Column) -> Column:
    """Tags to spaces, vowel and accent marks away."""
    return F.regexp_replace(F.regexp_replace(text, "<[^>]*>", " "), "[֑-ֽֿ-ׇ]", "")


# Characters that count as one in comparisons.
FOLD = {"״": '"', "“": '"', "”": '"', "„": '"', "׳": "'", "‘": "'", "’": "'", "‚": "'", "–": "-", "—": "-", "־": "-", "•": ".", "׃": ":", ";": ":"}


@F.pandas_udf(StringType())
def folded(text: pd.Series) -> pd.Series:
    """NFKC, one form of quotes, dashes and stops, and no outer punctuation of words."""
    table = str.maketrans(FOLD)
    strip = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())

    def one(t):
        if t is None:
            return None
        return " ".join(w for w in (x.strip(strip) for x in unicodedata.normalize("NFKC", t).translate(table).split()) if w)

    return text.map(one, na_action="ignore")


def is_placeholder(text: Column, id: Column, mark: str) -> Column:
    """Three parts between single spaces, the second the mark and the third the id."""
    p = F.split(text, " ")
    return (F.size(p) == 3) & (F.get(p, F.lit(1)) == mark) & (F.get(p, F.lit(2)) == id.cast("string"))


def opening(text: Column, stops: tuple[str, ...], head: str = "") -> Column:
    """The text up to its earliest stop, a leading numeral (the pattern ``head``) taken off."""
    t = F.regexp_replace(text, f"^{head}", "") if head else text
    cut = F.least(*[F.coalesce(F.nullif(F.instr(t, s), F.lit(0)), F.length(t) + 1) for s in stops], F.length(t) + 1)
    return F.trim(F.substring(t, F.lit(1), cut - 1))


def trailing_marker(text: Column, letters: str) -> Column:
    """A numeral of one to four letters behind the last colon; null for none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(text, r"\s+$", ""), rf":\s*([{letters}]{{1,4}})$", 1), F.lit(""))


def lenient_json(text: Column, fields: dict[str, str]) -> Column:
    """A struct: strict JSON, else without stray backslashes, else each field by pattern."""
    schema = ", ".join(f"{k} {v}" for k, v in fields.items())
    first = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    second = F.from_json(F.regexp_replace(text, r'\\(?!["\\/bfnrtu])', ""), schema)
    any_of = lambda s: F.coalesce(*[s[k].isNotNull() for k in fields]) if len(fields) == 1 else F.array_contains(F.array(*[s[k].isNotNull() for k in fields]), True)
    third = F.struct(*[F.coalesce(F.nullif(F.regexp_extract(text, rf'"{k}"\s*:\s*"((?:[^"\\]|\\.)*)"', 1), F.lit("")), F.nullif(F.regexp_extract(text, rf'"{k}"\s*:\s*([-+0-9.eE]+|true|false)', 1), F.lit(""))).cast(v).alias(k) for k, v in fields.items()])
    return F.when(any_of(first), first).when(any_of(second), second).otherwise(third)


def suggestion(note: Column, patterns: tuple[str, ...]) -> Column:
    """What the first pattern that matches captures."""
    return F.coalesce(*[F.nullif(F.regexp_extract(note, p, 1), F.lit("")) for p in patterns])


def notes(note: Column, pattern: str) -> Column:
    """Every (unit, place, original, candidate) that a pattern of four groups finds in free text."""
    all_of = lambda g: F.regexp_extract_all(note, F.lit(pattern), F.lit(g))
    return F.transform(F.arrays_zip(all_of(1).alias("a"), all_of(2).alias("b"), all_of(3).alias("c"), all_of(4).alias("d")), lambda x: F.struct(x["a"].cast("int").alias("unit_id"), x["b"].cast("int").alias("word_index"), x["c"].alias("original"), x["d"].alias("candidate")))


def repaired(text: Column, medial: str, final: str) -> Column:
    """Final letters inside a word in their medial form: position by position ``final`` becomes ``medial``."""
    out = text
    for f, m in zip(final, medial):
        out = F.regexp_replace(out, f"{f}(?=\\p{{L}})", m)
    return out


def replaced(text: Column, wrong: dict[str, str]) -> Column:
    """Whole words by a dictionary, all other text as it is."""
    out = text
    for w, r in wrong.items():
        out = F.regexp_replace(out, rf"(?<!\p{{L}})\Q{w}\E(?!\p{{L}})", r.replace("\\", r"\\").replace("$", r"\$"))
    return out


def is_running_header(texts: Column, header: str) -> Column:
    """Whether one of a page's tokens is exactly the header."""
    return F.exists(texts, lambda t: t == header)
