"""The most alike of two sets of texts, without a row for each pair that shares a word.

Texts are dealt in blocks by a hash, and every block of the one side meets every block of the other in one
task, so all pairs are compared. A task codes its words as numbers of its own and counts the words that two texts share
as a matrix: the commonest words by a product of dense columns, all others by their postings. What leaves a task
is one row for each text of its block.
"""

from __future__ import annotations

import difflib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEFT, RIGHT, WORDS = 8_192, 32_768, 2_000_000  # texts of a block of either side, and words
CELLS, DENSE, PAIRS = 1 << 20, 512, 1 << 16  # cells of a matrix, dense columns, pairs of texts at once
WIDEST = 64  # words of a text that a machine word can mark; longer texts do with the bound by bags

OUT = pa.schema([("unit_id", pa.int64()), ("owner", pa.int64()), ("score", pa.float64())])


class Side:
    """A block's texts in the order of their ids: ids, sizes, and (row, code) of each word, in the order of rows."""

    def __init__(self, ids: np.ndarray, lists: pa.ListArray):
        order = np.argsort(ids, kind="stable")
        lists = lists.take(pa.array(order))
        self.ids, self.words = ids[order], lists.flatten()
        self.sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        self.rows = np.repeat(np.arange(len(ids)), self.sizes)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])


def side(table: pa.Table) -> Side:
    return Side(table.column("unit_id").to_numpy(), pa.concat_arrays(table.column("ws").chunks))


def code(a: Side, b: Side) -> int:
    """Gives the words of both sides ``codes``, equal for equal words; how many there are."""
    coded = pa.chunked_array([a.words.cast(pa.large_string()), b.words.cast(pa.large_string())]).combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    a.codes, b.codes = codes[: len(a.rows)], codes[len(a.rows) :]
    return len(coded.dictionary)


def occurrences(a: Side, b: Side, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes of (word, how many times it stood in its text before): shared ones count what two bags of words share."""
    times = []
    for s in (a, b):
        order = np.lexsort((s.codes, s.rows))
        r, c = s.rows[order], s.codes[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
        at = np.arange(len(r))
        t = np.empty(len(r), np.int64)
        t[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        times.append(t)
    both, back = np.unique(np.concatenate([a.codes + n * times[0], b.codes + n * times[1]]), return_inverse=True)
    return back[: len(a.rows)], back[len(a.rows) :], len(both)


def shared(a: Side, b: Side, ca: np.ndarray, cb: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row, matrix): how many codes each of these rows of a shares with every row of b; a code stands
    at most once in a text."""
    na, nb = len(a.ids), len(b.ids)
    fa, fb = np.bincount(ca, minlength=n), np.bincount(cb, minlength=n)
    cost = fa * fb
    common = np.flatnonzero(cost * 40 > na * nb)
    common = common[np.argsort(-cost[common], kind="stable")[:DENSE]]
    column = np.full(n, -1)
    column[common] = np.arange(len(common))

    def dense(rows, codes, size):
        m = np.zeros((size, len(common)), np.float32)
        hit = column[codes] >= 0
        m[rows[hit], column[codes[hit]]] = 1
        return m

    da, db = dense(a.rows, ca, na), dense(b.rows, cb, nb).T
    fb[(column >= 0) | (fa == 0)] = 0  # without postings from here on
    kept = np.flatnonzero(fb[cb])
    members = b.rows[kept[np.argsort(cb[kept], kind="stable")]]
    first = np.concatenate([[0], np.cumsum(fb)])
    rest = np.flatnonzero(fb[ca])
    rows, codes = a.rows[rest], ca[rest]
    step = max(1, CELLS // max(1, nb))
    for lo in range(0, na, step):
        hi = min(na, lo + step)
        k = da[lo:hi] @ db
        i, end = np.searchsorted(rows, [lo, hi])
        done = np.concatenate([[0], np.cumsum(fb[codes[i:end]])])
        x = 0
        while x < end - i:  # no more postings at once than cells
            y = max(x + 1, int(np.searchsorted(done, done[x] + CELLS, "right")) - 1)
            r, c = rows[i + x : i + y], codes[i + x : i + y]
            at = np.repeat(first[c] - done[x:y] + done[x], fb[c]) + np.arange(done[y] - done[x])
            cells = np.bincount(np.repeat((r - lo) * nb, fb[c]) + members[at], minlength=k.size)
            np.add(k, cells.reshape(k.shape), out=k, casting="unsafe")
            x = y
        yield lo, hi, k


def forget_own(a: Side, b: Side, lo: int, hi: int, k: np.ndarray) -> None:
    """No text is compared with one of its own id."""
    left, right = np.searchsorted(b.ids, a.ids[lo:hi], "left"), np.searchsorted(b.ids, a.ids[lo:hi], "right")
    for i in np.flatnonzero(right > left):
        k[i, left[i] : right[i]] = 0


def by_sets(a: Side, b: Side, least: int) -> Iterator[tuple]:
    """(row, owner, Jaccard) of texts that are sets of words."""
    n = code(a, b)
    for lo, hi, k in shared(a, b, a.codes, b.codes, n):
        forget_own(a, b, lo, hi, k)
        if least > 1:
            k[k < least] = 0
        # k of both sizes together grows as Jaccard does: single precision finds those near the highest, double the best
        rough = k / (a.sizes[lo:hi, None].astype(np.float32) + b.sizes[None, :].astype(np.float32))
        row, col = np.nonzero(rough >= np.maximum(rough.max(1), np.float32(1e-30))[:, None] * np.float32(1 - 1e-5))
        both = k[row, col].astype(np.float64)
        score = both / (a.sizes[lo + row] + b.sizes[col] - both)
        order = np.lexsort((col, -score, row))  # the first of equals has the smallest id
        for x in order[np.unique(row[order], return_index=True)[1]]:
            yield lo + row[x], b.ids[col[x]], score[x]


def subsequences(a: Side, b: Side, lo: int, hi: int, n: int, wide: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs (row of lo..hi, row of b), bit-parallel; texts of a of
    at most WIDEST words. wide: codes of b by word and row, n where a text has ended."""
    part = slice(a.starts[lo], a.starts[hi])
    known, place = np.unique(a.codes[part], return_inverse=True)
    narrow = np.full(n + 1, len(known))
    narrow[known] = np.arange(len(known))
    marks = np.zeros((hi - lo, len(known) + 1), np.uint64)
    bit = np.uint64(1) << (np.arange(part.start, part.stop) - a.starts[a.rows[part]]).astype(np.uint64)
    np.bitwise_or.at(marks, (a.rows[part] - lo, place), bit)
    out = np.empty(len(left), np.int64)
    for at in range(0, len(left), PAIRS):
        l, r = left[at : at + PAIRS], right[at : at + PAIRS]
        v = np.full(len(l), ~np.uint64(0))
        base = l * marks.shape[1]
        for codes in wide:
            u = v & marks.ravel()[base + narrow[codes[r]]]
            v = (v + u) | (v - u)
        out[at : at + PAIRS] = np.bitwise_count(~v)
    return out


def by_matcher(a: Side, b: Side) -> Iterator[tuple]:
    """(row, owner, ratio of the matcher over word sequences).

    The words that two texts share, as bags, bound their ratio; so does their longest common subsequence, more closely.
    The matcher looks at candidates by descending bound and ends where none can be better."""
    n = code(a, b)
    ca, cb, size = occurrences(a, b, n)
    wide = np.full((int(b.sizes.max(initial=0)), len(b.ids)), n)
    wide[np.arange(len(b.rows)) - b.starts[b.rows], b.rows] = b.codes
    texts = lambda s: [s.codes[i:j].tolist() for i, j in zip(s.starts[:-1], s.starts[1:])]
    ta, tb = texts(a), texts(b)
    same: dict = {}
    ia, ib = ([same.setdefault(tuple(t), len(same)) for t in s] for s in (ta, tb))
    seen: dict = {}

    def ratio(i, j):
        if (pair := (ia[i], ib[j])) not in seen:
            seen[pair] = difflib.SequenceMatcher(None, ta[i], tb[j], autojunk=False).ratio()
        return seen[pair]

    for lo, hi, k in shared(a, b, ca, cb, size):
        forget_own(a, b, lo, hi, k)
        total = a.sizes[lo:hi, None] + b.sizes[None, :]
        bound = 2.0 * k / np.maximum(total, 1)
        top = bound.max(1, initial=0)
        best, whose = np.zeros(hi - lo), np.zeros(hi - lo, np.int64)
        # first the candidates near the highest bound, then all others whose bound reaches the best ratio of those
        for again in (False, True):
            look = (bound >= np.where(best > 0, best, np.inf)[:, None]) & (bound < 0.8 * top[:, None]) if again else (bound >= 0.8 * top[:, None]) & (bound > 0)
            left, right = np.nonzero(look)
            close = bound[left, right]
            if a.sizes[lo:hi].max() <= WIDEST:
                close = 2.0 * subsequences(a, b, lo, hi, n, wide, left, right) / total[left, right]
            order = np.lexsort((right, -close, left))
            left, right, close = left[order], right[order], close[order]
            begins = np.searchsorted(left, np.arange(hi - lo + 1))
            for i in range(hi - lo):
                for x in range(begins[i], begins[i + 1]):
                    if close[x] < best[i] or (close[x] == best[i] and b.ids[right[x]] >= whose[i]):
                        break  # behind it are lower bounds, and larger ids of equals
                    r, o = ratio(lo + i, right[x]), b.ids[right[x]]
                    if r > best[i] or (r == best[i] and o < whose[i]):
                        best[i], whose[i] = r, o
        for i in np.flatnonzero(best > 0):
            yield lo + i, whose[i], best[i]


def most_alike(left: DataFrame, right: DataFrame, search: Callable[[Side, Side], Iterator[tuple]], *, sets: bool = False) -> DataFrame:
    """(unit_id, owner, score): of each text of left (unit_id, ws) the best of right (unit_id, ws) that has another id,
    the smaller one of equals; ids are whole numbers, texts without words or id take no part.

    search: (row of the left block, owner, score) of the best in a pair of blocks. sets: all rows of an id are one text,
    the set of their words; else each row is a text, and an id has the best of its rows."""
    tasks = left.sparkSession.sparkContext.defaultParallelism
    sized = lambda d: d.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ws")), F.lit(0))).first()
    kinds = left.schema["unit_id"].dataType, right.schema["unit_id"].dataType
    left, right = (d.where("unit_id is not null and size(ws) > 0").select(F.col("unit_id").cast("long"), "ws") for d in (left, right))
    (n, words), (m, others) = sized(left), sized(right)
    if sets:
        left, right = (d.groupBy("unit_id").agg(F.array_distinct(F.flatten(F.collect_list(F.array_distinct("ws")))).alias("ws")) for d in (left, right))
    q = max(1, -(-m // RIGHT), -(-others // WORDS))
    p = max(1, -(-n // LEFT), -(-words // WORDS), -(-2 * tasks // q))
    # a text's block must not change when a task runs again, and collected words have no fixed order
    deal = lambda k: F.pmod(F.xxhash64("unit_id", *([] if sets else ["ws"])), F.lit(k)).cast("int")
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    a = left.select(deal(p).alias("_p"), each(q).alias("_q"), "unit_id", "ws")
    b = right.select(each(p).alias("_p"), deal(q).alias("_q"), "unit_id", "ws")

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return OUT.empty_table()
        s, t = side(x.select(["unit_id", "ws"])), side(y.select(["unit_id", "ws"]))
        row, owner, score = zip(*found) if (found := list(search(s, t))) else ((), (), ())
        return pa.table([s.ids[np.array(row, np.int64)], np.array(owner, np.int64), np.array(score, np.float64)], schema=OUT)

    met = a.groupBy("_p", "_q").cogroup(b.groupBy("_p", "_q")).applyInArrow(run, "unit_id long, owner long, score double")
    # by the complement: a smaller id is better, and the least one has no negative
    best = met.groupBy("unit_id").agg(F.max_by(F.struct("owner", "score"), F.struct("score", F.bitwise_not("owner"))).alias("b"))
    return best.select(F.col("unit_id").cast(kinds[0]), F.col("b.owner").cast(kinds[1]).alias("owner"), "b.score")
