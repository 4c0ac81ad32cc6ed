"""Language identification by interpolated Kneser-Ney character models, one a language.

A model is five sorted arrays of n-gram hashes with log-probabilities and back-off weights. It sees words
between end marks, so a word costs the same wherever it stands and is scored once for a batch, in lower case and
without what is no letter. The language of the lowest cross-entropy per character wins; on a part of the sample
that trained no counts, the confidence is calibrated, and so is the cross-entropy above which no language is accepted.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import U64, batch as rows_of, learnable, mix, share, slices, tokens, tidy

ORDER = 5
SIGNS = re.compile(r"[\W\d_]+")
SAMPLE = 800  # rows of a language from which its model is learnt, a fifth of them for calibration
SAMPLE_BYTES = 16 << 20  # of text of a language from which its model is learnt
CALIBRATED = 20  # learnable rows from which a fifth of a language's sample is held for calibration
REJECTED = 0.0005  # share of texts in a learnt language that calibration lets be rejected
UNDETERMINED = "und"


def letters(token: str) -> str:
    """A token in lower case without what is no letter."""
    token = token.lower()
    if not token.isalpha():
        token = SIGNS.sub("", token)
        if not token.isalpha():  # numerals that are no digits
            return "".join([c for c in token if c.isalpha()])
    return token


def _hashes(words: list[str], order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of all words between marks, end to end: for n = 1.. the hash of the n-gram that ends at each character
    and whether the word reaches that far back; then each word's length with its marks."""
    text = "".join(["\x02" + w + "\x03" for w in words])
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    place = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    grams, real = [mix(code)], [place >= 0]
    with np.errstate(over="ignore"):
        for n in range(2, order + 1):
            h = np.zeros(len(code), U64)
            h[1:] = mix(grams[-1][:-1] * U64(0x9E3779B97F4A7C15) + code[1:])
            grams.append(h)
            real.append(place >= n - 1)
    return grams, real, size


class KneserNey:
    """One language's model; ``key[n]`` is sorted, ``logp[n]`` and ``backoff[n]`` lie beside it, and so do the hashes of
    each n-gram without its last and without its first character."""

    def __init__(self, words: list[str], counts: np.ndarray, order: int = ORDER):
        grams, real, size = _hashes(words, order)
        weight = np.repeat(counts.astype(np.float64), size)
        self.key, self.logp, self.backoff, self.context, self.rest = [], [], [], [], []
        tables = []
        for n in range(order):
            at = np.flatnonzero(real[n])
            key, first, inverse = np.unique(grams[n][at], return_index=True, return_inverse=True)
            where = at[first]
            count = np.bincount(inverse, weight[at], len(key))
            # the n-gram without its last and without its first character
            context = grams[n - 1][where - 1] if n else np.zeros(len(key), U64)
            rest = grams[n - 1][where] if n else np.zeros(len(key), U64)
            starts = real[n + 1][where] if n + 1 < order else np.ones(len(key), bool)
            tables.append([key, count, context, rest, ~starts])
        for n in range(order - 1, 0, -1):  # lower orders count the different characters before them
            key, count, _, _, at_start = tables[n - 1]
            kinds = np.bincount(np.searchsorted(key, tables[n][3]), minlength=len(key)).astype(np.float64)
            tables[n - 1][1] = np.where(at_start & (kinds == 0), count, kinds)
        lower = None
        for n, (key, count, context, rest, _) in enumerate(tables):
            one, two = (count == 1).sum(), (count == 2).sum()
            discount = min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5
            group, inverse = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(inverse, count), np.bincount(inverse)
            gamma = discount * kinds / total
            base = np.full(len(key), 1 / (len(key) + 1)) if n == 0 else lower[np.searchsorted(tables[n - 1][0], rest)]
            p = np.maximum(count - discount, 0) / total[inverse] + gamma[inverse] * base
            if n == 0:
                self.unknown = float(np.log(gamma[0] / (len(key) + 1))) if len(key) else -12.0
            else:
                b = np.zeros(len(tables[n - 1][0]), np.float32)
                b[np.searchsorted(tables[n - 1][0], group)] = np.log(gamma)
                self.backoff.append(b)
            lower = p
            self.key.append(key), self.logp.append(np.log(p).astype(np.float32)), self.context.append(context), self.rest.append(rest)
        self.backoff.append(np.zeros(len(tables[-1][0]), np.float32))


class Lookup:
    """Places of 64-bit hashes in a sorted array. They are uniform, so their leading bits lead next to the place."""

    def __init__(self, key: np.ndarray):
        bits = max(1, int(2 * len(key)).bit_length())
        self.shift = U64(64 - bits)
        self.start = np.searchsorted(key, np.arange(1 << bits, dtype=U64) << self.shift).astype(np.int32)
        self.key = np.concatenate([key, [U64(2**64 - 1)]])

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.start[h >> self.shift]
        behind = np.flatnonzero(self.key[at] < h)
        while len(behind):
            at[behind] += 1
            behind = behind[self.key[at[behind]] < h[behind]]
        return at, (self.key[at] == h) & (at < len(self.key) - 1)


class Scorer:
    """All languages' models in one: each order's n-grams of any language in one sorted array of hashes, beside it a
    row of log-probabilities and one of back-off weights, a column a language. Where a language has not seen an
    n-gram that another has, its column holds what backing off gives, so one look-up serves all."""

    def __init__(self, models: list[KneserNey]):
        self.unknown = np.array([m.unknown for m in models], np.float32)
        self.logp, self.backoff, self.look = [], [], []
        for n in range(len(models[0].key)):
            key, first = np.unique(np.concatenate([m.key[n] for m in models]), return_index=True)
            context, rest = (np.concatenate([getattr(m, side)[n] for m in models])[first] for side in ("context", "rest"))
            if n == 0:
                logp = np.repeat(self.unknown[None, :], len(key), 0)
            else:
                logp = self.logp[-1][self.look[-1].find(rest)[0]] + self.backoff[-1][self.look[-1].find(context)[0]]
            backoff = np.zeros((len(key), len(models)), np.float32)
            for k, m in enumerate(models):
                at = np.searchsorted(key, m.key[n])
                logp[at, k], backoff[at, k] = m.logp[n], m.backoff[n]
            self.logp.append(logp), self.backoff.append(backoff), self.look.append(Lookup(key))

    def word_costs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each word, none empty, the negative log-probability of its letters and end mark by language, and their number."""
        grams, real, size = _hashes(words, len(self.look))
        at, found = self.look[0].find(grams[0])
        lp = np.where(found[:, None], self.logp[0][np.where(found, at, 0)], self.unknown)
        for n in range(1, len(self.look)):
            context = np.flatnonzero(real[n][1:] & found[:-1]) + 1
            known = found[context]  # an n-gram is only known if what it holds is
            place, hit = self.look[n].find(grams[n][context[known]])
            known[known] = hit
            to, less = context[known], context[~known]
            lp[less] += self.backoff[n - 1][at[less - 1]]
            at, found = np.zeros(len(lp), np.int32), np.zeros(len(lp), bool)
            at[to], found[to] = place[hit], True
            lp[to] = self.logp[n][place[hit]]
        start = np.cumsum(size) - size
        lp[start] = 0  # the first mark is given
        return -np.add.reduceat(lp, start, 0, np.float64), size - 1

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text per character by language, and the characters. Each word of the column is scored once."""
        codes, at, names = tokens(column)
        n, width = len(at) - 1, len(self.unknown)
        if not len(codes):
            return np.zeros((n, width)), np.zeros(n)
        place: dict[str, int] = {}
        word = np.array([place.setdefault(letters(t), len(place)) for t in names], np.int64)
        cost, size = np.zeros((len(place), width)), np.zeros(len(place), np.int64)
        some = [(w, i) for w, i in place.items() if w]
        for a in range(0, len(some), 50_000):
            here = some[a : a + 50_000]
            cost[[i for _, i in here]], size[[i for _, i in here]] = self.word_costs([w for w, _ in here])
        rows, doc = word[codes], np.repeat(np.arange(n), np.diff(at))
        total = np.bincount(doc, size[rows], n)
        whole = np.stack([np.bincount(doc, cost[rows, k], n) for k in range(width)], 1)
        return whole / np.maximum(total, 1)[:, None], total


class Model:
    """Languages in order, their models, and what calibration set."""

    def __init__(self, languages: list[str], models: list[KneserNey]):
        self.languages, self.scorer = languages, Scorer(models)
        self.sharpness, self.limit, self.room = 8.0, np.full(len(languages), np.inf), 0.0

    def decide(self, entropy: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its confidence, and whether the text is rejected: no letters, or accepted by no language."""
        best = entropy.argmin(1)
        low = entropy[np.arange(len(best)), best]
        z = -(entropy - low[:, None]) * (self.sharpness * size / (size + 20))[:, None]
        p = 1 / np.exp(z).sum(1)
        return best, p, (size == 0) | (entropy > self.limit + (self.room / np.sqrt(np.maximum(size, 1)))[:, None]).all(1)

    def calibrate(self, entropy: np.ndarray, size: np.ndarray, true: np.ndarray) -> None:
        """The sharpness that makes the confidences likeliest, and what is rejected.

        A language's limit lies half the way from its own texts to those of other languages; above it lies room that
        falls with the square root of a text's length. The room accepts all calibration rows, and is as large as the
        exponential tail of their uppermost tenth asks for, so that of further rows like them a share of ``REJECTED``
        is expected to be rejected."""
        ok = size > 0
        entropy, size, true = entropy[ok], size[ok], true[ok]
        if not len(true):
            return

        def loss(s):
            z = -entropy * (s * size / (size + 20))[:, None]
            z -= z.max(1)[:, None]
            return -(z[np.arange(len(true)), true] - np.log(np.exp(z).sum(1))).mean()

        self.sharpness = float(min((1, 2, 4, 6, 8, 12, 16, 24, 32), key=loss))
        for k in range(len(self.languages)):
            own, other = entropy[true == k, k], entropy[true != k, k]
            if len(own):
                self.limit[k] = (float(np.median(own)) + float(np.median(other))) / 2 if len(other) else 2 * float(np.median(own))
        over = (entropy - self.limit).min(1) * np.sqrt(size)
        over = over[np.isfinite(over)]
        if len(over):
            high = float(np.quantile(over, 0.9))
            tail = over[over >= high]
            self.room = max(0.0, float(over.max()), high + float((tail - high).mean()) * float(np.log(0.1 / REJECTED)))


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of the rows' words, summed within batches before they are shuffled."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                codes, at, names = tokens(b.column("text"))
                words = [letters(t) for t in names]
                doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
                lang, which = np.unique(np.array(b.column("lang").to_pylist(), object), return_inverse=True)
                pair = which[doc] * max(1, len(names)) + codes
                key, n = np.unique(pair, return_counts=True)
                yield rows_of(schema, [lang[k // len(names)] for k in key], [words[k % len(names)] for k in key], n)

    return docs.mapInArrow(tidy(run), "lang string, word string, n long").where("word <> ''").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _entropies(docs: DataFrame, model, columns: str) -> DataFrame:
    def run(batches):
        scorer = model.value.scorer
        for b in batches:
            for s in slices(b, "text"):
                entropy, size = scorer.texts(s.column("text"))
                yield pa.RecordBatch.from_arrays([s.column("lang"), pa.array(list(entropy), pa.list_(pa.float64())), pa.array(size.astype(np.float64))], names=["lang", "entropy", "size"])

    return docs.select("lang", "text").mapInArrow(tidy(run), columns)


def train(docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, order: int = ORDER):
    """A broadcast model from at most about ``sample`` rows and ``sample_bytes`` of each language (all, if less), or None
    without any.

    Rows with null text, language or id, and held-out rows, are not learnt from. Of a language with few rows all
    train its counts; then calibration goes without it and nothing is rejected as unlike it."""
    d = learnable(docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")), "id")
    d = d.where("_learn and lang is not null and text is not null")
    count = {r[0]: (r[1], r[2]) for r in d.groupBy("lang").agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).collect()}  # a row a language
    if not count:
        return None
    of = lambda f: F.create_map(*[F.lit(x) for k, v in count.items() for x in (k, f(*v))])[F.col("lang")]
    held = of(lambda n, _: 0.2 if n >= CALIBRATED else 0.0)
    d = d.where(share("id", seed="language sample") < of(lambda n, size: min(sample / n, sample_bytes / max(size, 1)))).withColumn("held", share("id", seed="language calibration") < held)
    learnt = _word_counts(d.where("not held").select("lang", "text"))
    words = learnt.toPandas()
    languages = sorted(words["lang"].unique())
    if not languages:
        return None
    models = [KneserNey(list(g["word"]), g["n"].to_numpy(), order) for _, g in words.groupby("lang")]
    model = Model(languages, models)
    sc = docs.sparkSession.sparkContext
    first = sc.broadcast(model)
    held = _entropies(d.where("held"), first, "lang string, entropy array<double>, size double").toPandas()
    held = held[held["lang"].isin(languages)]
    if len(held):
        model.calibrate(np.stack(held["entropy"].to_numpy()), held["size"].to_numpy(), np.array([languages.index(x) for x in held["lang"]]))
    first.destroy()
    return sc.broadcast(model)


def identify(docs: DataFrame, model, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and (lang_pred, lang_score, lang_entropy, lang_rejected), whole texts read.

    lang_pred is a learnt language, or ``und`` for a null text, one without letters, or without a model; those
    score 0 and are rejected. Other rows are rejected if unlike every language. Ties go to the language that sorts first."""
    names = [f.name for f in docs.schema if f.name not in ("lang_pred", "lang_score", "lang_entropy", "lang_rejected")]
    d = docs.select(*[F.col(f"`{n}`") for n in names])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)

    def run(batches):
        m = model.value if model is not None else None
        for b in batches:
            for s in slices(b, text, 8 << 20):
                if m is None:
                    n = s.num_rows
                    pred, p, low, out = [UNDETERMINED] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
                else:
                    entropy, size = m.scorer.texts(s.column(text))
                    best, p, out = m.decide(entropy, size)
                    some = size > 0
                    pred = [m.languages[k] if o else UNDETERMINED for k, o in zip(best, some)]
                    p, low = np.where(some, p, 0.0), np.where(some, entropy.min(1), np.nan)
                yield pa.RecordBatch.from_arrays([*s.columns, pa.array(pred), pa.array(p), pa.array(low, mask=np.isnan(low)), pa.array(out)], names=[*s.schema.names, "lang_pred", "lang_score", "lang_entropy", "lang_rejected"])

    return d.mapInArrow(tidy(run), f"{kinds}, lang_pred string, lang_score double, lang_entropy double, lang_rejected boolean")
