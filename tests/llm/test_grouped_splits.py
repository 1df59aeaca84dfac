import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cropmill.llm import grouped_splits as g


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a and b and a != b:
            parent[find(a)] = find(b)
    out = {}
    for x in list(parent):
        out.setdefault(find(x), set()).add(x)
    return {frozenset(v) for v in out.values()}


def found(df):
    return {frozenset(r.n) for r in df.groupBy("root").agg(F.collect_set("node").alias("n")).collect()}


@pytest.mark.parametrize("seed,per_task", [(1, 1000), (2, 20), (3, 7)])
def test_components(spark, seed, per_task):
    rng = random.Random(seed)
    links = [(rng.choice([None, *[f"n{i}" for i in range(80)]]), f"n{rng.randrange(80)}") for _ in range(60)] + [("hub", f"leaf{i}") for i in range(40)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("c060", "c000"), ("x", "x")]
    assert found(g.components(spark.createDataFrame(links, "a string, b string"), per_task)) == brute(links)


def test_components_of_nothing(spark):
    assert g.components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_spread_equals_the_loop(seed):
    rng = random.Random(seed)
    d, size, count = [rng.randint(-50, 200) for _ in range(3)], rng.randint(1, 9), rng.randint(0, 60)
    left, want = list(d), [0, 0, 0]
    for _ in range(count):
        i = max(range(3), key=lambda k: (left[k], -k))
        left[i] -= size
        want[i] += 1
    assert g.spread(d, size, count) == want


def test_plan_is_near_target():
    sizes = {3000: 1, 40: 5, 3: 1000, 1: 4000}
    total = sum(k * n for k, n in sizes.items())
    by, ranks = Counter(), Counter()
    for size, split, a, b in g.plan(sizes, [("train", Fraction("0.8")), ("test", Fraction("0.1")), ("val", Fraction("0.1"))]):
        by[split] += size * (b - a)
        ranks[size] += b - a
    assert ranks == sizes and all(abs(by[s] - total * x) <= 1 for s, x in (("train", 0.8), ("test", 0.1), ("val", 0.1)))


SAMPLES = "id string, document_id string, split string, root int"
DOCS = "document_id string, parent_document_id string"


def test_splits_and_broken(spark):
    samples = [("a", "D1", "train", 1), ("b", "d_2", None, 1), ("c", "d-3", "Validation", 1), ("d", "unknown", "test", 1), ("e", "n/a", "train", 1), ("f", None, "eval", 1), ("g", "d9", "train", 1), ("h", "D9 ", "train", 1), ("a", "D1", "train", 2)]
    docs = [("d1", "x"), ("d-2", "D2"), ("x", " D-3"), ("d-3", "d1"), ("d9", ""), ("d8", None)]
    s, d = spark.createDataFrame(samples, SAMPLES), spark.createDataFrame(docs, DOCS)
    assert sorted(r.id for r in g.broken_groups(s, d).collect()) == ["a", "c"]
    t = spark.createDataFrame([("train", 0.5), ("val", 0.25), ("test", 0.25)], "split string, target_share double")
    out = {r.id: r for r in g.split_groups(s, d, t).collect()}
    assert set(out) == set("abcdefgh") and out["a"].new_split == out["c"].new_split and out["g"].new_split == out["h"].new_split
    assert {i for i, r in out.items() if r.broken} == {"a", "c"} and len({r["group"] for r in out.values()}) == 6
    assert g.split_groups(s.limit(0), d, t).count() == 0 and g.broken_groups(s, d.limit(0)).count() == 0
