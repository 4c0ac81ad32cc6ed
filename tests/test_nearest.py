"""Best matches among all pairs of texts, against brute force and DuckDB."""

import difflib
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from lectern.operators import nearest, validate
from lectern.plans import registry


def texts(seed, n, ids, vocabulary, longest):
    r = random.Random(seed)
    return [(r.randrange(ids), [f"w{r.randrange(vocabulary)}" for _ in range(r.randrange(longest))]) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([*rows, (None, ["w1"])], "unit_id int, ws array<string>")


@pytest.fixture(params=[False, True])
def small_blocks(request, monkeypatch):
    """Also with blocks so small that each text meets the others in several."""
    if request.param:
        monkeypatch.setattr(nearest, "LEFT", 9)
        monkeypatch.setattr(nearest, "RIGHT", 7)


@pytest.mark.parametrize("cells, columns", [(1, 0), (20, 2), (1 << 21, 512)])
def test_shared(monkeypatch, cells, columns):
    monkeypatch.setattr(nearest, "CELLS", cells)
    monkeypatch.setattr(nearest, "DENSE", columns)
    x, y = ([(i, sorted(set(ws))) for i, ws in texts(s, 20, 30, 25, 12)] for s in (5, 6))
    a, b = (nearest.Side(np.array([i for i, _ in t]), pa.array([ws for _, ws in t])) for t in (x, y))
    n = nearest.code(a, b)
    got = np.concatenate([k for _, _, k in nearest.shared(a, b, a.codes, b.codes, n)])
    by_id = lambda t: sorted(t, key=lambda r: r[0])
    assert got.tolist() == [[len(set(u) & set(v)) for _, v in by_id(y)] for _, u in by_id(x)]


def joins(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]


def found(df):
    return {r["unit_id"]: (r["owner"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("least", [1, 3])
def test_most_shared_words(spark, small_blocks, least):
    a, b = texts(1, 40, 30, 25, 12), texts(2, 40, 30, 25, 12)
    sets = lambda rows: {i: {w for k, ws in rows if k == i for w in ws} for i, _ in rows}
    want = {}
    for i, x in sets(a).items():
        best = max(((len(x & y) / len(x | y), -o) for o, y in sets(b).items() if o != i and len(x & y) >= least), default=None)
        if best:
            want[i] = (-best[1], best[0])
    got = validate.most_shared_words(frame(spark, a), frame(spark, b), least)
    assert found(got) == want
    assert got.dtypes == [("unit_id", "int"), ("owner", "int"), ("score", "double")]
    assert not joins(got)  # no row for a pair that shares a word
    assert validate.most_shared_words(frame(spark, a), frame(spark, [])).where("owner is not null").count() == 0


def test_best_owner_rows_of_one_conversation_and_turn_are_one_text(spark, tmp_path):
    rows = [(i, t, "user", " ".join(ws) or None) for t in (0, 1, 2) for i, ws in texts(t, 60, 25, 30, 9)] + [(None, 0, "user", "w1 w2"), (None, 1, "user", "w1 w2")]
    pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(tmp_path / "conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet'")
    want = sorted(db.execute(registry.ORACLE["j15_best_owner"]).fetchall())
    assert want and sorted(map(tuple, registry.QUERIES["j15_best_owner"](spark, str(tmp_path)).collect())) == want

@pytest.mark.parametrize("words, longest", [(50, 12), (50, 70), (80, 90)])
def test_best_owner(spark, small_blocks, words, longest):
    a, b = texts(3, 30, 25, 20, longest), texts(4, 30, 25, 20, longest)
    b += [(i + 30, ws) for i, ws in a[:5]]  # copies
    want = {}
    for i, x in a:
        pairs = ((difflib.SequenceMatcher(None, x[:words], y[:words], autojunk=False).ratio(), -o) for o, y in b if o != i)
        best = max([*pairs, (-want[i][0], want[i][1])[::-1]] if i in want else pairs, default=(0, 0))
        if best[0] > 0:
            want[i] = (-best[1], best[0])
    got = validate.best_owner(frame(spark, a), frame(spark, b), words)
    assert found(got) == want
    assert not joins(got)  # no row for a pair that shares a word
