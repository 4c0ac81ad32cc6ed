"""Suffix order with common-prefix lengths by external induced sorting.

Queues, one for each first symbol, carry (position, common prefix with the one before) tuples: within a
symbol they arrive in the order in which they leave, so a queue is a file that is written at its end and
read from its front, and spills to disk beyond a bound. S* suffixes, sorted by the same induction over
their substrings' names, induce the L suffixes by ascending symbols, these the S suffixes by descending
symbols. An induced common prefix is one more than the least between its two sources, which batches find
with sparse tables and carry over by symbol.
"""

from __future__ import annotations

import tempfile

import numpy as np

BATCH = 1 << 18
SPILL = 16 << 20  # bytes that a queue keeps in memory


class Queue:
    """First in, first out, of (position, common prefix) batches; a file that deletes itself beyond SPILL bytes."""

    def __init__(self, spill: int = SPILL):
        self.held, self.size, self.file, self.at, self.spill = [], 0, None, 0, spill

    def put(self, p: np.ndarray, e: np.ndarray) -> None:
        self.held.append((p, e))
        self.size += p.nbytes + e.nbytes
        if self.size > self.spill:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for p, e in self.held:
                self.file.write(np.array([len(p)], np.int64).tobytes() + p.tobytes() + e.tobytes())
            self.held, self.size = [], 0

    def _batches(self):
        while True:
            if self.file is not None:
                self.file.seek(self.at)
                head = self.file.read(8)
                if head:
                    n = int(np.frombuffer(head, np.int64)[0])
                    p, e = np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(n), np.uint8)
                    self.at = self.file.tell()
                    yield p, e
                    continue
            if not self.held:
                return
            held, self.held, self.size = self.held, [], 0
            if len(held) == 1:
                yield held[0]
            else:
                yield np.concatenate([p for p, _ in held]), np.concatenate([e for _, e in held])

    def __iter__(self):
        """Everything put so far and whatever is put while it is read, in batches."""
        for p, e in self._batches():
            for a in range(0, len(p), BATCH):
                yield p[a : a + BATCH], e[a : a + BATCH]

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.held, self.file = [], None


class Carry:
    """Sorts a batch's induced suffixes by symbol and finds their common prefixes."""

    def __init__(self, symbols: int, cap: int):
        self.least, self.cap = np.full(symbols, cap, np.uint8), cap

    def spread(self, target: np.ndarray, at: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sources ``at`` of a batch with prefixes e: their order by target symbol, and prefixes in that order.

        With a cap of 0 there are none to find."""
        order = np.argsort(target, kind="stable")
        if not self.cap:
            return order, np.zeros(len(order), np.uint8)
        table = [e]
        while 2 << (len(table) - 1) <= len(e):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][: len(table[-1]) - half], table[-1][half:]))

        def least(lo, hi):  # of e[lo:hi], hi > lo
            level = np.frexp((hi - lo).astype(np.float64))[1] - 1
            out = np.empty(len(lo), np.uint8)
            for k in np.unique(level).tolist():
                m = level == k
                out[m] = np.minimum(table[k][lo[m]], table[k][hi[m] - (1 << k)])
            return out

        c, k = target[order], at[order]
        if not len(k):
            np.minimum(self.least, e.min(initial=self.cap), out=self.least)
            return order, np.zeros(0, np.uint8)
        first = np.ones(len(c), bool)
        first[1:] = c[1:] != c[:-1]
        lo = np.zeros(len(c), np.int64)
        lo[1:] = np.where(first[1:], 0, k[:-1] + 1)
        low = least(lo, k + 1)
        low[first] = np.minimum(low[first], self.least[c[first]])
        np.minimum(self.least, e.min(), out=self.least)
        last = np.ones(len(c), bool)
        last[:-1] = first[1:]
        end = k[last] + 1
        rest = np.full(len(end), self.cap, np.uint8)
        some = end < len(e)
        if some.any():
            rest[some] = least(end[some], np.full(some.sum(), len(e)))
        self.least[c[last]] = rest
        return order, np.minimum(low.astype(np.int64) + 1, self.cap).astype(np.uint8)


def types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S); the end is smaller than all."""
    n = len(t)
    d = np.full(n, -1, np.int8)
    d[:-1] = np.sign(t[1:].astype(np.int64) - t[:-1].astype(np.int64))
    known = np.where(d != 0, np.arange(n), n)
    return d[np.minimum.accumulate(known[::-1])[::-1]] > 0


def common(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, up to cap."""
    out, live, k, n = np.zeros(len(a), np.int64), np.arange(len(a)), 0, len(t)
    while len(live) and k < cap:
        x, y = a[live] + k, b[live] + k
        ok = (x < n) & (y < n)
        ok[ok] = t[x[ok]] == t[y[ok]]
        live = live[ok]
        k += 1
        out[live] = k
    return out


def induce(t: np.ndarray, s: np.ndarray, stars: np.ndarray, prefixes: np.ndarray, symbols: int, cap: int, spill: int = SPILL):
    """Yields (positions, common prefixes) of all suffixes in order, from the S* suffixes in order."""
    n = len(t)
    low, high = {}, {}
    carry = Carry(symbols, cap)

    def push(queues, p, e, smaller):
        ok = np.flatnonzero(p > 0)
        ok = ok[~s[p[ok] - 1] if smaller else s[p[ok] - 1]]
        before = p[ok] - 1
        target = t[before]
        order, found = carry.spread(target, ok, e)
        before, target = before[order], target[order]
        cut = np.concatenate([[0], np.flatnonzero(target[1:] != target[:-1]) + 1, [len(target)]]) if len(target) else [0]
        for a, b in zip(cut[:-1], cut[1:]):
            c = int(target[a])
            q = queues.get(c)
            if q is None:
                q = queues[c] = Queue(spill)
                found[a] = 0  # the first of its symbol
            q.put(before[a:b], found[a:b])

    first = t[stars] if len(stars) else np.zeros(0, t.dtype)
    present = np.unique(t).tolist()
    done: dict[int, tuple[Queue, int, int]] = {}
    push(low, np.array([n]), np.zeros(1, np.uint8), True)
    for c in present:
        out, last = Queue(spill), -1
        if c in low:
            for p, e in low[c]:
                out.put(p, e)
                last = int(p[-1])
                push(low, p, e, True)
            low.pop(c).close()
        a, b = np.searchsorted(first, c, "left"), np.searchsorted(first, c, "right")
        if a < b:
            e = np.minimum(prefixes[a:b], cap).astype(np.uint8)
            e[0] = common(t, stars[a : a + 1], np.array([last]), cap)[0] if last >= 0 else 0
            push(low, stars[a:b], e, True)
        done[c] = out, last, 0
    carry = Carry(symbols, cap)
    ends: dict[int, list] = {}
    for c in reversed(present):
        got, tail = [], -1
        if c in high:
            for p, e in high[c]:
                got.append((p, e))
                tail = int(p[-1])
                push(high, p, e, False)
            high.pop(c).close()
        out, last, _ = done[c]
        batches = list(out)  # ascending; read back descending
        if batches:
            p, e = np.concatenate([x for x, _ in batches]), np.concatenate([x for _, x in batches])
            back = np.empty(len(e), np.uint8)
            back[0] = common(t, np.array([tail]), np.array([last]), cap)[0] if tail >= 0 else 0
            back[1:] = e[:0:-1]
            for a in range(0, len(p), BATCH):
                push(high, p[::-1][a : a + BATCH], back[a : a + BATCH], False)
            between = int(back[0])
        else:
            p, e, between = np.zeros(0, np.int64), np.zeros(0, np.uint8), 0
        ends[c] = [p, e, got, between]
        out.close()
    for c in present:
        p, e, got, between = ends.pop(c)
        if len(p):
            yield p, e
        if got:
            q, f = np.concatenate([x for x, _ in got])[::-1], np.concatenate([x for _, x in got])
            up = np.empty(len(f), np.uint8)
            up[0] = between
            up[1:] = f[:0:-1]
            yield q, up


def _doubling(t: np.ndarray) -> np.ndarray:
    """Suffix order of a string of nearly unique symbols, by doubling ranks."""
    n, rank, h = len(t), np.unique(t, return_inverse=True)[1].astype(np.int64) + 1, 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - h] = rank[h:]
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[1], (key[order][1:] != key[order][:-1]).astype(np.int64)])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n or h >= n:
            return order
        h *= 2


def suffixes(t: np.ndarray, cap: int = 255, spill: int = SPILL):
    """Yields (positions, common prefixes with the suffix before, up to cap <= 255) of all suffixes in order.

    t holds non-negative symbols; the end of t is smaller than all. Empty t: nothing."""
    if not len(t):
        return
    t = t.astype(np.int64) if t.dtype.kind != "i" else t
    s = types(t)
    stars = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    symbols = int(t.max()) + 1
    if len(stars) > 1:
        # the order of the S* substrings: one induction from S* suffixes ordered by their first symbol only
        rough = stars[np.argsort(t[stars], kind="stable")]
        at = np.concatenate([p for p, _ in induce(t, s, rough, np.zeros(len(rough), np.int64), symbols, 0, spill)])
        is_star = np.zeros(len(t), bool)
        is_star[stars] = True
        at = at[is_star[at]]
        ends = np.full(len(t), len(t), np.int64)
        ends[stars[:-1]] = stars[1:]
        size = ends[at] - at + (ends[at] < len(t))
        same = np.zeros(len(at), bool)
        pair = np.flatnonzero(size[1:] == size[:-1]) + 1
        if len(pair):
            most = size[pair]
            k, live = 0, pair
            equal = np.ones(len(pair), bool)
            index = np.arange(len(pair))
            while len(live):
                ok = t[at[live] + k] == t[at[live - 1] + k]
                equal[index[~ok]] = False
                k += 1
                go = ok & (most[index] > k)
                live, index = live[go], index[go]
            equal &= ends[at[pair]] < len(t)  # the last substring is like no other
            equal &= ends[at[pair - 1]] < len(t)
            same[pair[equal]] = True
        name = np.cumsum(~same)
        names = np.zeros(len(t), np.int64)
        names[at] = name
        reduced = names[stars]
        if name[-1] == len(stars):
            order = at
        elif name[-1] > 256:
            order = stars[_doubling(reduced)]
        else:
            order = stars[np.concatenate([p for p, _ in suffixes(reduced, 0, spill)])]
    else:
        order = stars
    prefix = np.zeros(len(order), np.int64)
    if len(order) > 1:
        prefix[1:] = common(t, order[1:], order[:-1], cap) if cap else 0
    yield from induce(t, s, order, prefix, symbols, cap, spill)
