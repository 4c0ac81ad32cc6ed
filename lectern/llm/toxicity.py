"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their character 4-grams whose frequency differs between the labels (by a likelihood
ratio), and one term for all other words of a text, which keeps a text with one odd term apart from a text
of nothing else. Equal example vectors are one entry that counts its labels. The entries are sorted so that
like ones share a block; the index holds each block's largest weight of each term, so blocks are visited by
descending bound, and the search stops once no bound can reach the k-th similarity. Distance-weighted votes
of the neighbours, calibrated on examples that are not in the index, give the score; the neighbours are the
evidence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch as rows_of, learnable, share, slices, tokens, tidy
from .langid import letters

SAMPLE = 4000  # labelled rows of each label from which terms, index and calibration are learnt
NEIGHBOURS, BLOCK, GRAM = 15, 64, 4
CACHED = 200_000


def features(token: str) -> set[str]:
    """A token's word and, marked, its character 4-grams."""
    word = letters(token)
    return {word, *["~" + word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]} if word else set()


class Vocabulary:
    """Terms by number, with inverse document frequencies; the last number is that of all other words."""

    def __init__(self, terms: list[str], idf: np.ndarray):
        self.terms, self.idf = {t: i for i, t in enumerate(terms)}, idf
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, token: str) -> tuple[int, ...]:
        got = self.known.get(token)
        if got is None:
            if len(self.known) > CACHED:
                self.known.clear()
            got = self.known[token] = tuple(sorted(self.terms[f] for f in features(token) if f in self.terms))
        return got

    def vectors(self, column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Term numbers and unit-length weights of each text: (1 + log count) * idf. No words: no terms."""
        codes, at, names = tokens(column)
        marks = [self.of(t) for t in names]
        hit = np.array([bool(m) for m in marks] or [False])
        rest, out = len(self.terms), []
        marked = hit[codes] if len(codes) else np.zeros(0, bool)
        before = np.concatenate([[0], np.cumsum(marked)])
        for a, b in zip(at[:-1], at[1:]):
            if a == b:
                out.append((np.zeros(0, np.int64), np.zeros(0)))
                continue
            count = {}
            if before[b] > before[a]:
                for c in codes[a:b][marked[a:b]].tolist():
                    for f in marks[c]:
                        count[f] = count.get(f, 0) + 1
            others = (b - a) - (before[b] - before[a])
            if others:
                count[rest] = int(others)
            term = np.array(sorted(count), np.int64)
            w = (1 + np.log(np.array([count[t] for t in term.tolist()], float))) * self.idf[term]
            out.append((term, w / np.sqrt((w * w).sum())))
        return out


class Index:
    """Block-max inverted index of labelled unit vectors."""

    def __init__(self, vectors, weight: np.ndarray, toxic: np.ndarray, who: np.ndarray, width: int, block: int = BLOCK):
        same: dict[tuple, int] = {}
        rows, self.good, self.bad, self.who = [], [], [], []
        order = sorted(range(len(vectors)), key=lambda i: (tuple(vectors[i][0].tolist()), int(who[i])))
        for i in order:
            term, w = vectors[i]
            key = (term.tobytes(), np.round(w, 12).tobytes())
            k = same.get(key)
            if k is None:
                k = same[key] = len(rows)
                rows.append((term, w))
                self.good.append(0.0), self.bad.append(0.0), self.who.append(int(who[i]))
            if toxic[i]:
                self.bad[k] += weight[i]
            else:
                self.good[k] += weight[i]
        self.good, self.bad, self.who, self.block = np.array(self.good), np.array(self.bad), np.array(self.who, np.int64), block
        self.at = np.concatenate([[0], np.cumsum([len(term) for term, _ in rows], dtype=np.int64)])
        self.term = np.concatenate([np.zeros(0, np.int64), *[term for term, _ in rows]]).astype(np.int32)
        self.w = np.concatenate([np.zeros(0), *[w for _, w in rows]]).astype(np.float32)
        self.most = np.zeros((width, -(-len(rows) // block)), np.float32)  # by term, each block's largest weight
        np.maximum.at(self.most, (self.term, np.repeat(np.arange(len(rows)) // block, np.diff(self.at))), self.w)
        self.asked = np.zeros(width, np.float32)

    def __len__(self) -> int:
        return len(self.at) - 1

    @property
    def dense(self) -> np.ndarray:
        """The entries as full rows, to look at; the search has no use for them."""
        out = np.zeros((len(self), len(self.most)), np.float32)
        out[np.repeat(np.arange(len(self)), np.diff(self.at)), self.term] = self.w
        return out

    def nearest(self, term: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the k highest cosines and these; ties go to the earlier entry."""
        w32 = w.astype(np.float32)
        bound = w32 @ self.most[term]
        order = np.argsort(-bound, kind="stable")
        self.asked[term] = w32
        found, score, at, step = np.zeros(0, np.int64), np.zeros(0, np.float32), 0, 2
        while at < len(order) and (len(found) < k or bound[order[at]] >= score[-1] - 1e-6):
            blocks = order[at : at + step]
            rows = (blocks[:, None] * self.block + np.arange(self.block)).ravel()
            rows = rows[rows < len(self)]
            size = self.at[rows + 1] - self.at[rows]
            held = np.repeat(self.at[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
            s = np.bincount(np.repeat(np.arange(len(rows)), size), self.w[held] * self.asked[self.term[held]], len(rows)).astype(np.float32)
            found, score = np.concatenate([found, rows]), np.concatenate([score, s])
            best = np.lexsort((found, -score))[:k]
            found, score = found[best], score[best]
            at, step = at + step, step * 2
        self.asked[term] = 0
        return found, score


class Model:
    """Vocabulary, index and calibration: score = sigmoid(slope * logit(vote) + shift)."""

    def __init__(self, vocabulary: Vocabulary, index: Index, prior: float, k: int = NEIGHBOURS):
        self.vocabulary, self.index, self.prior, self.k = vocabulary, index, prior, k
        self.slope, self.shift = 1.0, 0.0
        self.seen: dict[bytes, tuple] = {}

    def vote(self, term: np.ndarray, w: np.ndarray) -> tuple[float, list[tuple[int, float]]]:
        """The share of toxic among the neighbours, weighted by nearness; the prior has the weight of a far one."""
        if not len(term) or not len(self.index):
            return self.prior, []
        key = term.tobytes() + w.tobytes()
        got = self.seen.get(key)
        if got is None:
            if len(self.seen) > 20_000:
                self.seen.clear()
            found, cosine = self.index.nearest(term, w, self.k)
            near = np.maximum(cosine, 0).astype(float) / (1.02 - np.minimum(cosine, 1))
            bad, good = (near * self.index.bad[found]).sum(), (near * self.index.good[found]).sum()
            got = self.seen[key] = ((bad + 0.1 * self.prior) / (bad + good + 0.1), [(int(self.index.who[i]), float(c)) for i, c in zip(found[:3], cosine[:3])])
        return got

    def score(self, vote: np.ndarray) -> np.ndarray:
        v = np.clip(vote, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(v / (1 - v)) + self.shift)))

    def calibrate(self, vote: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
        """Logistic regression of the labels on the votes' log-odds, by Newton steps with a light pull to (1, 0)."""
        if len(vote) < 20 or toxic.min() == toxic.max():
            return
        v = np.clip(vote, 1e-6, 1 - 1e-6)
        x = np.stack([np.log(v / (1 - v)), np.ones(len(v))], 1)
        b, pull = np.array([1.0, 0.0]), 1.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            g = x.T @ (weight * (toxic - p)) - pull * (b - [1.0, 0.0])
            h = (x * (weight * p * (1 - p))[:, None]).T @ x + pull * np.eye(2)
            step = np.linalg.solve(h, g)
            b = b + np.clip(step, -2, 2)
        self.slope, self.shift = float(max(0.05, b[0])), float(b[1])


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, n) documents with each term, summed within batches before they are shuffled."""
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())])

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                codes, at, names = tokens(b.column("text"))
                of = [features(t) for t in names]
                count: dict[tuple[str, int], int] = {}
                for a, z, y in zip(at[:-1], at[1:], b.column("toxic").to_pylist()):
                    for f in set().union(*[of[c] for c in np.unique(codes[a:z]).tolist()]):
                        count[f, y] = count.get((f, y), 0) + 1
                yield rows_of(schema, [k[0] for k in count], [k[1] for k in count], list(count.values()))

    return rows.mapInArrow(tidy(run), "term string, toxic int, n long")


def train(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, terms: int | None = None, k: int = NEIGHBOURS):
    """A broadcast model, or None without learnable labelled rows of both kinds.

    Learns from at most about ``sample`` rows of each label (all, if fewer), and indexes every term that tells the
    labels apart in these, unless only ``terms`` of them are asked for. Rows with a null id or label, and
    held-out rows, are not learnt from; null texts count as empty. An id labelled twice takes the larger label."""
    sc = docs.sparkSession.sparkContext
    y = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("toxic")).where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    y = learnable(y, "id").where("_learn").select("id", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"))
    total = {r[0]: r[1] for r in y.groupBy("toxic").count().collect()}
    if set(total) != {0, 1}:
        return None
    rate = F.when(F.col("toxic") == 1, sample / total[1]).otherwise(sample / total[0])
    y = y.where(share("id", seed="toxicity sample") < rate)
    size = y.agg(F.count(F.lit(1))).first()[0]  # at most about 2 * sample rows, so the ids go to every executor
    d = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    d = d.join(F.broadcast(y) if size <= 4 * sample else y, "id")
    d = d.withColumn("held", share("id", seed="toxicity calibration") < 0.25).persist()
    try:
        n = {r[0]: r[1] for r in d.where("not held").groupBy("toxic").count().collect()}
        n0, n1 = n.get(0, 0), n.get(1, 0)
        if not n0 or not n1:
            return None
        c = _term_counts(d.where("not held").select("text", "toxic")).groupBy("term").agg(F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).alias("b"), F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0)).alias("a"))
        part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
        a, b, whole = F.col("a"), F.col("b"), float(n0 + n1)
        ratio = 2 * (part(a, (a + b) * (n0 / whole)) + part(b, (a + b) * (n1 / whole)) + part(n0 - a, (n0 + n1 - a - b) * (n0 / whole)) + part(n1 - b, (n0 + n1 - a - b) * (n1 / whole)))
        # only terms that toxic texts have at least three times as often
        chosen = c.where((b >= 3) & (b * n0 >= 3 * a * n1)).withColumn("g", ratio).where("g >= 8").orderBy(F.desc("g"), "term")
        chosen = (chosen if terms is None else chosen.limit(terms)).collect()
        idf = np.array([*[np.log((1 + whole) / (1 + r["a"] + r["b"])) + 1 for r in chosen], 1.0])
        vocabulary = Vocabulary([r["term"] for r in chosen], idf)
        shared = sc.broadcast((list(vocabulary.terms), idf))

        def run(batches):
            v = Vocabulary(*shared.value)
            for whole_batch in batches:
                for s in slices(whole_batch, "text"):
                    vectors = v.vectors(s.column("text"))
                    yield pa.RecordBatch.from_arrays([s.column("id"), s.column("toxic"), s.column("held"), pa.array([t.tolist() for t, _ in vectors], pa.list_(pa.int64())), pa.array([w.tolist() for _, w in vectors], pa.list_(pa.float64()))], names=["id", "toxic", "held", "term", "w"])

        # the bounded sample's vectors: no texts
        got = d.withColumn("id", F.col("id").cast("long")).mapInArrow(tidy(run), "id long, toxic int, held boolean, term array<long>, w array<double>").toPandas().sort_values("id")
    finally:
        d.unpersist()
    toxic, held = got["toxic"].to_numpy(), got["held"].to_numpy().astype(bool)
    weight = np.where(toxic == 1, total[1] / max(1, (toxic == 1).sum()), total[0] / max(1, (toxic == 0).sum()))
    vectors = [(np.asarray(t, np.int64), np.asarray(w, float)) for t, w in zip(got["term"], got["w"])]
    index = Index([v for v, h in zip(vectors, held) if not h and len(v[0])], weight[~held & got["term"].map(len).gt(0).to_numpy()], toxic[~held & got["term"].map(len).gt(0).to_numpy()], got["id"].to_numpy()[~held & got["term"].map(len).gt(0).to_numpy()], len(idf))
    model = Model(vocabulary, index, total[1] / (total[0] + total[1]), k)
    ask = np.flatnonzero(held)
    model.calibrate(np.array([model.vote(*vectors[i])[0] for i in ask]), toxic[ask], weight[ask] / weight[ask].mean() if len(ask) else weight[ask])
    model.seen, vocabulary.known = {}, {}
    shared.unpersist()
    return sc.broadcast(model)


def toxicity(docs: DataFrame, model, *, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and (toxic_score, toxic_evidence), whole texts read.

    The score is from 0 to 1; texts without words get the calibrated prior, and so does every row without a
    model (0 then). The evidence names up to three nearest examples as ``id:cosine``. Nothing else of a row than
    its text decides, so equal texts score equally."""
    names = [f.name for f in docs.schema if f.name not in ("toxic_score", "toxic_evidence")]
    d = docs.select(*[F.col(f"`{n}`") for n in names])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)

    def run(batches):
        m = model.value if model is not None else None
        for b in batches:
            for s in slices(b, text):
                if m is None:
                    score, evidence = np.zeros(s.num_rows), [""] * s.num_rows
                else:
                    votes = [m.vote(*v) for v in m.vocabulary.vectors(s.column(text))]
                    score = m.score(np.array([v for v, _ in votes]))
                    evidence = [",".join(f"{i}:{c:.3f}" for i, c in e) for _, e in votes]
                yield pa.RecordBatch.from_arrays([*s.columns, pa.array(score), pa.array(evidence, pa.string())], names=[*s.schema.names, "toxic_score", "toxic_evidence"])

    return d.mapInArrow(tidy(run), f"{kinds}, toxic_score double, toxic_evidence string")
