import random

import numpy as np
import pytest

from lectern.llm.induced import suffixes


def brute(t, cap):
    order = sorted(range(len(t)), key=lambda i: t[i:])
    lcp = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and a + k < len(t) and b + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        lcp.append(k)
    return order, lcp


@pytest.mark.parametrize("spill", [1 << 24, 64])
def test_equals_sorting(spill):
    r = random.Random(5)
    cases = [[1], [1, 1], [2, 1], [1, 2], [1] * 40, [3, 2, 1] * 9, [1, 2] * 30 + [0] + [1, 2] * 30]
    for _ in range(300):
        n, k = r.randint(1, 120), r.choice([2, 3, 5, 250])
        word = [r.randint(0, k) for _ in range(r.randint(1, 12))]
        cases.append([x for _ in range(r.randint(1, 6)) for x in (word if r.random() < 0.6 else [r.randint(0, k) for _ in range(n // 4)])])
    for t in cases:
        if not t:
            continue
        for cap in (50, 3):
            got = list(suffixes(np.array(t, np.int64), cap, spill))
            p, e = np.concatenate([x for x, _ in got]).tolist(), np.concatenate([x for _, x in got]).tolist()
            order, lcp = brute(t, cap)
            assert p == order, t
            assert e == lcp, (t, cap)


def test_empty():
    assert list(suffixes(np.zeros(0, np.int64))) == []
