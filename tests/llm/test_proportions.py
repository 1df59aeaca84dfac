import random
from collections import Counter
from fractions import Fraction
from math import ceil, floor
from types import SimpleNamespace

import pytest

from cropmill.llm import proportions

SAMPLES = "id string, task string, domain string, mining_bucket string, note string"
TARGETS = "task string, domain string, mining_bucket string, target_share double, min_rows int"


@pytest.mark.parametrize("seed", range(30))
def test_controlled_rounding_keeps_margins(seed):
    rng = random.Random(seed)
    q = {(r, c): Fraction(rng.randint(0, 400), 37) for r in range(rng.randint(1, 6)) for c in range(rng.randint(1, 5))}
    got = proportions.controlled_rounding(q)
    near = lambda n, x: n in (floor(x), ceil(x))
    assert set(got) == set(q) and all(near(got[k], x) for k, x in q.items())
    for axis in (0, 1):
        for k in {key[axis] for key in q}:
            assert near(sum(v for key, v in got.items() if key[axis] == k), sum(x for key, x in q.items() if key[axis] == k))
    assert near(sum(got.values()), sum(q.values()))


def test_rounding_of_many_cells():
    rng = random.Random(3)
    q = {(r, c): Fraction(rng.randint(0, 10**6), 997) for r in range(200) for c in range(50)}
    got = proportions.controlled_rounding(q)
    for axis in (0, 1):
        exact, whole = Counter(), Counter()
        for k, x in q.items():
            exact[k[axis]] += x
            whole[k[axis]] += got[k]
        assert all(whole[k] in (floor(x), ceil(x)) for k, x in exact.items())


def target(*a):
    return dict(zip(("task", "domain", "mining_bucket", "target_share", "min_rows"), a))


@pytest.mark.parametrize(
    "has, targets, want",
    [
        ({"a": 500, "b": 500, "c": 500}, {"a": (0.9, 0), "b": (0.05, 30), "c": (0.05, 30)}, None),
        ({"a": 160, "b": 30, "c": 10}, {"a": (0.9, 0), "b": (0.05, 30), "c": (0.05, 30)}, {"a": 60, "b": 30, "c": 10}),
        ({"a": 3, "b": 100, "c": 97}, {"a": (0.5, 0), "b": (0.25, 0), "c": (0.25, 0)}, {"a": 3}),
        ({"a": 100, "b": 100, "c": 0}, {"a": (0.5, 90), "b": (0.25, 90), "c": (0.25, 0)}, {"a": 90, "b": 90, "c": 0}),
    ],
)
def test_least_and_available_rows_are_bounds(has, targets, want):
    """The size is met within the bounds of all cells; least rows alone may exceed it."""
    have = {("t", "d", k): n for k, n in has.items()}
    rows = [SimpleNamespace(**target("t", "d", k, *v)) for k, v in targets.items()]
    got = {c["mining_bucket"]: c for c in proportions.plan(have, rows, Fraction(1, 2))}
    least = sum(min(has[k], v[1]) for k, v in targets.items())
    assert sum(c["selected"] for c in got.values()) == max(least, min(sum(has.values()) // 2, sum(has.values())))
    assert all(min(has[k], targets[k][1]) <= c["selected"] <= has[k] for k, c in got.items())
    assert all(got[k]["selected"] == n for k, n in (want or {}).items())


def test_sample_matches_quotas(spark):
    rng = random.Random(1)
    rows = [(f"s{i}", rng.choice(["text", " Text\n", "TABLE"]), rng.choice(["private", "General", None]), rng.choice(["learnable", "Coverage ", None]), "x") for i in range(600)]
    rows += rows[:50]  # delivered again
    targets = [("text", "private", "learnable", 0.3, 2), ("text", "general", "learnable", 0.2, 2), ("table", "private", "coverage", 0.3, 400), ("formula", "private", "coverage", 0.2, 3)]
    sel, rep = proportions.sample_to_proportions(spark.createDataFrame(rows, SAMPLES), spark.createDataFrame(targets, TARGETS))
    got, cells = sel.collect(), {(r.task, r.domain, r.mining_bucket): r for r in rep.collect()}
    ids = {r.id for r in got}
    n = len({r[0] for r in rows if r[3]})
    assert len(ids) == len(got)
    counts = Counter((r.task, r.domain, r.mining_bucket) for r in got)
    for k, c in cells.items():
        assert c.selected == counts[k] and min(c.available, c.min_rows) <= c.selected <= c.available and c.short == (c.available < max(ceil(Fraction(str(c.target_share)) * n / 2), c.min_rows))
    assert cells["formula", "private", "coverage"].short and cells["table", "private", "coverage"].short
    again, _ = proportions.sample_to_proportions(spark.createDataFrame(rows[::-1], SAMPLES), spark.createDataFrame(targets, TARGETS))
    assert {r.id for r in again.collect()} == ids


def test_empty(spark):
    sel, rep = proportions.sample_to_proportions(spark.createDataFrame([], SAMPLES), spark.createDataFrame([("a", "b", "c", 1.0, 1)], TARGETS))
    assert sel.count() == 0 and rep.first().short
