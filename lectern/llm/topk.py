"""Exact top-k by inner product over impact-ordered segments, score at a time.

Vectors are of integers. A dimension counts for a query in one direction, so a shard keeps two posting lists
a dimension, of ``x - min`` and of ``max - x``: impacts that are never negative, up to a constant of
the query. An impact is quantised to a level; a list's level is a segment of members, ordered by
descending impact. A query takes segments by descending (weight x level), adds the level's lower end to its
members' accumulators, and knows of every vector how much the unread segments can still add. It stops once
no vector outside the possible members can reach the k-th best lower bound - that is the proof - and rescores
the possible members exactly.
"""

from __future__ import annotations

import numpy as np

from pyspark.sql import DataFrame

from .blocks import search
from .common import pack, unpack

LEVELS = 32
TESTS = (0.3, 0.15, 0.06, 0.0)  # shares of the unread impact at which the proof is tried


def build(ids: np.ndarray, matrix: np.ndarray, scale: int = 256) -> bytes:
    x = np.floor(scale * matrix).astype(np.int64)
    n, dim = x.shape
    lo, hi = x.min(0), x.max(0)
    width = np.maximum(1, -(-(hi - lo + 1) // LEVELS))  # of a level, by dimension
    members, starts = [], np.zeros((2 * dim, LEVELS + 1), np.int64)
    at = 0
    for side in range(2):
        u = (x - lo) if side == 0 else (hi - x)
        level = u // width
        for j in range(dim):
            order = np.argsort(-level[:, j], kind="stable").astype(np.int32)
            count = np.bincount(level[:, j], minlength=LEVELS)[::-1]
            starts[side * dim + j] = at + np.concatenate([[0], np.cumsum(count)])
            members.append(order)
            at += n
    return pack(ids.astype(np.int64), x.ravel(), lo, hi, width, np.concatenate(members), starts.ravel())


def query(index: bytes, ids: np.ndarray, matrix: np.ndarray, k: int, scale: int = 256):
    """(query position, ids, scores) of the k + 1 best of a shard: one more, as a query may meet itself."""
    who, x, lo, hi, width, members, starts = unpack(index, np.int64, np.int64, np.int64, np.int64, np.int64, np.int32, np.int64)
    n, dim = len(who), len(lo)
    x, starts = x.reshape(n, dim), starts.reshape(2 * dim, LEVELS + 1)
    asked, keep = np.floor(scale * matrix).astype(np.int64), k + 1
    out_q, out_id, out_s = [], [], []
    top_level, down = (hi - lo) // width, np.arange(LEVELS - 1, 0, -1)
    for qi, q in enumerate(asked):
        weight = np.abs(q)
        step = weight * width  # impact of one level of a dimension
        dims, slots = np.nonzero((down[None, :] <= top_level[:, None]) & (weight[:, None] > 0))
        impact = step[dims] * down[slots]
        order = np.argsort(-impact, kind="stable")
        dims, slots, impact = dims[order], slots[order], impact[order]
        row = (q[dims] < 0) * dim + dims
        first, last = starts[row, slots], starts[row, slots + 1]
        # of a dimension a vector still adds less than one step if its segment is read, else less than the next level's end
        least = (weight * (width - 1)).sum()
        unread = least + (step * top_level).sum() - np.concatenate([[0], np.cumsum(step[dims])])
        acc, at, possible = np.zeros(n), 0, np.arange(n)
        for part in TESTS if n > keep else ():
            to = int(np.searchsorted(-unread, -(least + part * (unread[0] - least)), "left"))
            if to <= at:
                continue
            size = last[at:to] - first[at:to]
            hit = np.concatenate([members[s:e] for s, e in zip(first[at:to], last[at:to])])
            acc += np.bincount(hit, np.repeat(impact[at:to].astype(float), size), n)
            at = to
            possible = np.flatnonzero(acc + unread[to] >= np.partition(acc, n - keep)[n - keep])  # the proof: no other can reach the floor
            if len(possible) <= 8 * keep + n // 100:
                break
        s = x[possible] @ q
        best = np.lexsort((who[possible], -s))[:keep]
        out_q.append(np.full(len(best), qi)), out_id.append(who[possible][best]), out_s.append(s[best])
    cat = lambda z: np.concatenate(z) if z else np.zeros(0, np.int64)
    return cat(out_q), cat(out_id), cat(out_s)


def top_k(table: DataFrame, *, every: int = 50, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int = 256, shard: int = 16_384) -> DataFrame:
    """(query_id, rank, id, score): exact best k of floor(scale * vector) by inner product.

    Queries are the rows whose id is divisible by ``every``; a query is not its own candidate; ties go to the
    smaller id. Vectors null or with a null or non-finite component, and null ids, take no part; all-zero
    vectors do. Fewer than k candidates: all of them. Empty table: no rows."""
    return search(table, every, lambda ix, ids, m: query(ix, ids, m, k, scale), k, id=id, vector=vector, nonzero=False, build=lambda ids, m: build(ids, m, scale), score="long", shard=shard)
