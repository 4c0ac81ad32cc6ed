"""Approximate nearest neighbours by inner product in vantage-point trees, one a shard.

With one more component, sqrt(M^2 - |x|^2) for vectors and 0 for queries (M the shard's largest norm), the
Euclidean distance falls as the inner product grows, so a metric tree serves. A node splits its vectors by the
median distance from a vantage point. With tau the distance of the k-th best so far, the triangle inequality
lets a query skip a side, with all below it, when its distance from the vantage point is over tau away from that
side's range; the factor scales tau there: 1 searches exactly, less skips more. Equal vectors are one point of the
tree with several ids.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .blocks import search
from .common import pack, unpack

LEAF = 128
FACTOR = 0.6
SPARE = 4  # points kept beyond those asked for, as the last bits of a product depend on how it is summed


def build(ids: np.ndarray, matrix: np.ndarray, leaf: int = LEAF, seed: int = 7) -> bytes:
    """Nodes in preorder: (vantage row or -1, far child, first row, last row) and the ranges of both sides; of each
    distinct vector its ids in order."""
    by = np.lexsort((ids, *matrix.T[::-1]))
    ids, matrix = ids[by], matrix[by]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(ids)), bool), (matrix[1:] != matrix[:-1]).any(1)]))
    ends, matrix = np.append(first[1:], len(ids)), matrix[first]
    norm = (matrix * matrix).sum(1)
    x = np.concatenate([matrix, np.sqrt(np.maximum(0, norm.max(initial=0) - norm))[:, None]], 1)
    order, nodes, ranges = np.arange(len(x)), [], []
    r = np.random.default_rng(seed)

    def grow(a: int, b: int) -> None:
        me = len(nodes)
        nodes.append([-1, -1, a, b])
        ranges.append([0.0, 0.0, 0.0, 0.0])
        if b - a <= leaf:
            return
        rows = order[a:b]
        # of a few, the vantage point whose distances spread most
        some = r.choice(len(rows), min(8, len(rows)), replace=False)
        near = x[rows[r.choice(len(rows), min(64, len(rows)), replace=False)]]
        v = rows[some[np.argmax([np.linalg.norm(near - x[rows[s]], axis=1).std() for s in some])]]
        d = np.linalg.norm(x[rows] - x[v], axis=1)
        by = np.argsort(d, kind="stable")
        order[a:b], d = rows[by], d[by]
        mid = (b - a) // 2
        nodes[me][0] = int(v)
        ranges[me] = [d[0], d[mid - 1], d[mid], d[-1]]
        grow(a, a + mid)
        nodes[me][1] = len(nodes)
        grow(a + mid, b)

    if len(x):
        grow(0, len(x))
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    nodes = np.array(nodes, np.int64).reshape(-1, 4)
    inner = nodes[:, 0] >= 0
    nodes[inner, 0] = place[nodes[inner, 0]]
    return pack(ids.astype(np.int64), np.stack([first, ends], 1)[order].astype(np.int64).ravel(), np.ascontiguousarray(matrix[order]).ravel(), x[order, -1], nodes.ravel(), np.array(ranges, np.float64).ravel())


def query(index: bytes, ids: np.ndarray, matrix: np.ndarray, k: int, factor: float = FACTOR):
    """(query position, ids, scores) of the k + 1 best found for each query of a block, as it may meet itself."""
    who, places, flat, extra, nodes, ranges = unpack(index, np.int64, np.int64, np.float64, np.float64, np.int64, np.float64)
    n, m, keep = len(extra), len(ids), k + 1 + SPARE
    if not n or not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    x, nodes, ranges, places = flat.reshape(n, -1), nodes.reshape(-1, 4), ranges.reshape(-1, 4), places.reshape(-1, 2)
    square = (x * x).sum(1) + extra * extra  # the same for all, up to rounding
    own = (matrix * matrix).sum(1)
    best_s, best_i = np.full((m, keep), -np.inf), np.full((m, keep), -1, np.int64)
    tau, slack = np.full(m, np.inf), 1e-7 * np.sqrt(square.max() + own.max())

    def gaps(node: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far the ranges of a node's two sides are from each query."""
        v = nodes[node, 0]
        d = np.sqrt(np.maximum(0, own[rows] + square[v] - 2 * (matrix[rows] @ x[v])))
        lo, mid, up, hi = ranges[node]
        return np.maximum(lo - d, d - mid), np.maximum(up - d, d - hi)

    def read(a: int, b: int, rows: np.ndarray) -> None:
        s = matrix[rows] @ x[a:b].T
        better = s.max(1) > best_s[rows].min(1)
        rows, s = rows[better], s[better]
        if not len(rows):
            return
        every = np.concatenate([best_s[rows], s], 1)
        name = np.concatenate([best_i[rows], np.broadcast_to(np.arange(a, b), s.shape)], 1)
        top = np.argpartition(-every, keep - 1, 1)[:, :keep]
        best_s[rows], best_i[rows] = every, name = np.take_along_axis(every, top, 1), np.take_along_axis(name, top, 1)
        low = every.min(1)
        full = np.isfinite(low)
        tau[rows[full]] = np.sqrt(np.maximum(0, own[rows[full]] + square[0] - 2 * low[full]))

    # the leaf that a query falls in sets tau
    home, todo = np.full(m, -1), [(0, np.arange(m))]
    while todo:
        node, rows = todo.pop()
        v, far, a, b = nodes[node].tolist()
        if v < 0:
            read(a, b, rows)
            home[rows] = node
            continue
        near, away = gaps(node, rows)
        todo += [(child, some) for child, some in ((node + 1, rows[near <= away]), (far, rows[near > away])) if len(some)]
    # then all subtrees that the bounds allow, each once with the queries that still need it
    todo = [(0, np.arange(m), np.zeros(m))]
    while todo:
        node, rows, bound = todo.pop()
        asks = bound <= factor * tau[rows] + slack
        rows, bound = rows[asks], bound[asks]
        if not len(rows):
            continue
        v, far, a, b = nodes[node].tolist()
        if v < 0:
            rows = rows[home[rows] != node]
            if len(rows):
                read(a, b, rows)
            continue
        near, away = gaps(node, rows)
        todo += sorted([(node + 1, rows, np.maximum(bound, near)), (far, rows, np.maximum(bound, away))], key=lambda t: -t[2].sum())

    q, slot = np.nonzero(best_i >= 0)
    found = best_i[q, slot]
    score = np.einsum("ij,ij->i", matrix[q], x[found])
    count = np.minimum(places[found, 1] - places[found, 0], k + 1)  # of equal vectors the smallest ids
    at = np.repeat(places[found, 0] - np.cumsum(count) + count, count) + np.arange(count.sum())
    q, score = np.repeat(q, count), np.repeat(score, count)
    order = np.lexsort((who[at], -score, q))
    q, score, name = q[order], score[order], who[at][order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank <= k], name[rank <= k], score[rank <= k]


def nearest(table: DataFrame, *, every: int = 20, k: int = 20, id: str = "vec_id", vector: str = "embedding", factor: float = FACTOR, shard: int = 16_384) -> DataFrame:
    """(query_id, rank, id, score): of each row whose id is divisible by ``every``, the k nearest found, nearest first.

    score is the inner product of the original vectors in double precision; ties go to the smaller id; a query is
    not its own candidate. Every vector is in a tree. Vectors null, all zero or with a null or non-finite component,
    and null ids, take no part. With ``factor`` 1 the answer is exact. Empty table: no rows."""
    return search(table, every, lambda ix, ids, m: query(ix, ids, m, k, factor), k, id=id, vector=vector, nonzero=True, build=build, shard=shard)
