import hashlib
import random

import numpy as np

from lectern.llm.dedup import _together, anchors, remove_repeats


def brute(rows, width=50):
    owner = {}
    for i, t in rows:
        if i is None:
            continue
        b = (t or "").encode()
        for a in range(len(b) - width + 1):
            w = b[a : a + width]
            owner[w] = min(i, owner.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        if i is not None:
            for a in range(len(b) - width + 1):
                if owner[b[a : a + width]] < i:
                    gone[a : a + width] = True
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone[:-1].sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    pool = [prose(r.randint(5, 60)) for _ in range(12)]
    rows = [(None, pool[0]), (5, None), (6, ""), (7, "x" * 400), (8, "x" * 49), (9, "x" * 50), (10, "ab" * 300), (10, "ab" * 100), (11, "ab" * 120), (11, "ab" * 120)]
    for i in range(12, 80):
        t = " ".join(r.choice([prose(r.randint(0, 40)), r.choice(pool), r.choice(pool)[r.randint(0, 20) :]]) for _ in range(r.randint(1, 6)))
        if r.random() < 0.4 and len(rows) > 20:
            t = r.choice(rows[20:])[1]
            at = r.randint(0, len(t))
            t = t[:at] + r.choice(["", "Z", prose(2)]) + t[at + r.randint(0, 3) :]
        rows.append((i, t))
    r.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = texts(seed)
        got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), block_bytes=4000).collect()
        key = lambda x: tuple((v is None, v) for v in x)
        assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_segments_hold_each_window_once():
    r = random.Random(4)
    data = [bytes(r.choice(b"abc") for _ in range(r.randint(0, 300))) for _ in range(60)]
    size = np.array([len(d) for d in data])
    end = np.cumsum(size)
    gram, segment, first, count, _, _, doc = _together(np.frombuffer(b"".join(data), np.uint8), end - size, end, 50, 16)
    for d, text in enumerate(data):
        own = np.flatnonzero(doc == d)
        windows = [w for f, c in zip(first[own], count[own]) for w in range(f, f + c)]
        assert windows == list(range(max(0, len(text) - 49)))
        alone = anchors(np.frombuffer(text, np.uint8))
        assert {(int(g), int(f)) for g, f in zip(gram[own], first[own])} >= {(int(g), int(f)) for g, f in zip(alone[0], alone[2])}


def test_one_anchor_over_the_bound_is_split():
    """An anchor's segments of several megabytes: equal to a dictionary, without eight-byte arrays of every suffix."""
    import random
    import tracemalloc

    import numpy as np

    from lectern.llm.dedup import WHOLE, repeated

    r = random.Random(3)
    some = [bytes(r.choice(b"ab ") for _ in range(34)) for _ in range(4000)]
    segments = [r.choice(some) + b"an anchor of all" + r.choice(some) for _ in range(WHOLE // 84 + 5000)]
    who = np.array([r.randint(1, 9000) for _ in segments], np.int64)
    least: dict[bytes, int] = {}
    for w, x in zip(who.tolist(), segments):
        for i in range(len(x) - 49):
            least[x[i : i + 50]] = min(w, least.get(x[i : i + 50], w))
    want = {(j, i) for j, x in enumerate(segments) for i in range(len(x) - 49) if least[x[i : i + 50]] < who[j]}
    del least
    tracemalloc.start()
    got = repeated(who, segments, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(j, i) for j, a, b in got for i in range(a, b + 1)} == want and want
    assert peak < 40 * sum(map(len, segments)), peak
