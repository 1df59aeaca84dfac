import math
import random

from cropmill.llm import leximin as lx

SCHEMA = "id string, signals struct<regression:double,disagreement:double,candidate_gap:double,priority:double>, rank int"


def data(n, seed):
    rng = random.Random(seed)
    v = lambda: rng.choice([None, math.nan, 0.0, -0.0, 0.5, rng.random(), rng.random() * 1e9, math.inf])
    return [(f"i{k:04}", (v(), v(), v(), v()), k) for k in range(n)]


def brute(rows):
    out = {}
    cols = [[r[1][j] for r in rows if r[1][j] is not None and not math.isnan(r[1][j])] for j in range(4)]
    for i, s, _ in rows:
        out[i] = sorted(sum(y < x for y in cols[j]) / len(cols[j]) for j, x in enumerate(s) if x is not None and not math.isnan(x))
    return out


def test_equals_brute_force(spark):
    rows = data(700, 3)
    items = lx.measured_scores(spark.createDataFrame(rows + rows[:90], SCHEMA))
    want = brute(rows)
    got = {}
    for r in lx.percentiles(items, rows_per_task=60).collect():
        got.setdefault(r.id, []).append(r.less / r.n)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    order = [r.id for r in lx.leximin_order(items).orderBy("rank").collect()]
    ids = sorted(want)
    assert order == sorted(ids, key=lambda i: want[i], reverse=True) or [want[i] for i in order] == sorted(want.values(), reverse=True)
    for a, b in zip(order, order[1:]):
        assert want[a] > want[b] or want[a] == want[b] and a < b
    assert {r.id for r in lx.high_in_all(items, share=0.5).collect()} == {i for i, v in want.items() if len(v) >= 3 and v[0] >= 0.5}


def test_all_tied_and_empty(spark):
    df = spark.createDataFrame([(f"i{k}", (1.0, None, None, None), 0) for k in range(50)], SCHEMA)
    items = lx.measured_scores(df)
    assert {r.less for r in lx.percentiles(items, rows_per_task=7).collect()} == {0}
    assert [r.id for r in lx.leximin_order(items).orderBy("rank").collect()] == sorted(f"i{k}" for k in range(50))
    assert lx.leximin_order(items.limit(0)).count() == 0 and lx.high_in_all(items.limit(0)).count() == 0
