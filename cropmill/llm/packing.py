"""Filling containers of fixed capacity with items.

The driver plans on the histogram of lengths, which has at most `capacity` entries at any number of items. The
configuration linear program (fewest containers so that the chosen fillings hold all items) is solved by multiplicative
weights: a knapsack dynamic program over the capacity prices the fillings under the present prices of the lengths, the
best ones are used a step, and the prices of the lengths they served fall. Prices also give a lower bound on the
containers of any packing. The fractional solution is scaled and rounded, what rounding left is filled along the same
priced table. Items then take the slots of their length by an exact rank.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropmill.llm.tokens import VOCABULARY, with_tokens
from cropmill.operators.ranking import random_key, rank_by_key
from cropmill.sources.tables import materialize

CAPACITY = 4096
#: Units the capacity is divided into for planning; lengths are rounded up to units, so fillings always fit.
UNITS = 1024
#: Rounds of pricing, the part by which a filling may be worth less than the best to be used in a round, and the rate at
#: which prices fall. The time of planning depends on these and on the number of lengths only.
ROUNDS, SLACK, RATE = 100, 0.02, 0.03
#: Lengths that may run out before the table is priced again while the rest is filled.
STALE = 32


class Plan(NamedTuple):
    """Fillings (sizes, copies of each, containers); the least containers by the prices, in whole items; items that the rounded program placed."""

    fillings: list[tuple[np.ndarray, np.ndarray, int]]
    bound: int
    programmed: int

    def containers(self) -> int:
        return sum(n for *_, n in self.fillings)


def _priced(sizes: np.ndarray, value: np.ndarray, room: int) -> np.ndarray:
    """The highest value of a filling within 0, 1, ... room units: the knapsack program, all sizes of a step at once."""
    best, fits = np.zeros(room + 1), np.searchsorted(sizes, np.arange(room + 1), "right")
    for w in range(1, room + 1):
        k = fits[w]
        best[w] = max(best[w - 1], (best[w - sizes[:k]] + value[:k]).max()) if k else 0.0
    return best


def _filling(sizes: np.ndarray, value: np.ndarray, best: np.ndarray, room: int, free: np.ndarray) -> dict[int, int]:
    """{index of a size: copies}: the filling the table leads to, of at most `free` copies each."""
    out: dict[int, int] = {}
    free = free.copy()
    while (k := int(np.searchsorted(sizes, room, "right"))) and free[:k].any():
        j = int(np.where(free[:k] > 0, best[room - sizes[:k]] + value[:k], -1.0).argmax())
        out[j] = out.get(j, 0) + 1
        free[j] -= 1
        room -= int(sizes[j])
    return out


def fractional(sizes: np.ndarray, need: np.ndarray, room: int, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float, np.ndarray, np.ndarray]:
    """(use of each filling, lower bound, prices, how often each size was served): the program by multiplicative weights.

    In a round the fillings within SLACK of the best one that share no size are used until one of their sizes is served
    once more. Prices divided by the worth of the best filling solve the dual program, whose value is the bound.
    """
    value, bound = sizes / sizes.max(), 0.0
    used: dict[tuple, float] = {}
    served = np.zeros(len(sizes))
    for _ in range(rounds):
        best = _priced(sizes, value, room)
        bound = max(bound, float(value @ need) / best[room])
        free, now = np.full(len(sizes), room), np.zeros(len(sizes))
        while f := _filling(sizes, value, best, room, free):
            which, copies = np.array(list(f)), np.array(list(f.values()))
            if value[which] @ copies < (1 - SLACK) * best[room]:
                break
            step = float((need[which] / copies).min())
            now[which] += copies * step
            key = tuple(sorted(f.items()))
            used[key] = used.get(key, 0.0) + step
            free[which] = 0
        served += now
        value = value * np.exp(-RATE * now / need)
        value /= value.max()
    return used, bound, value, served


def _rest(sizes: np.ndarray, value: np.ndarray, left: np.ndarray, room: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Fillings for all that is left: the largest size opens a container, which is filled along the priced table."""
    left, out, best, stale = left.copy(), [], None, 0
    while left.any():
        has = np.flatnonzero(left)
        if best is None or stale >= STALE:
            best, stale = _priced(sizes[has], value[has], room), 0
        first = int(has[-1])
        free = left.copy()
        free[first] -= 1
        f = _filling(sizes, value, best, room - int(sizes[first]), free)
        f[first] = f.get(first, 0) + 1
        which, copies = np.array(list(f)), np.array(list(f.values()))
        n = int((left[which] // copies).min())
        out.append((sizes[which], copies, n))
        left[which] -= copies * n
        stale += int((left[which] == 0).sum())
    return out


def plan(histogram: dict[int, int], room: int = UNITS, rounds: int = ROUNDS) -> Plan:
    """Fillings that hold exactly the items of {size: number}; sizes in units, at most `room`.

    Where filling without the program needs fewer containers than the program once it is rounded, which happens when
    few items of a length have to share many fillings, that plan is taken, with `programmed` 0.
    """
    sizes = np.array(sorted(histogram), np.int64)
    if not len(sizes):
        return Plan([], 0, 0)
    need = np.array([histogram[int(s)] for s in sizes], np.int64)
    plain = _rest(sizes, sizes / room, need, room)
    if not rounds:
        return Plan(plain, -(-int(sizes @ need) // room), 0)
    used, bound, value, served = fractional(sizes, need, room, rounds)
    scale, left, out, placed = float(np.median(served / need)), need.copy(), [], 0
    for key, x in sorted(used.items(), key=lambda kv: -kv[1]) if scale else ():
        which, copies = (np.array(a, np.int64) for a in zip(*key))
        n = min(int(x / scale + 0.5), int((left[which] // copies).min()))
        if n > 0:
            out.append((sizes[which], copies, n))
            left[which] -= copies * n
            placed += int(copies.sum()) * n
    both = Plan(out + _rest(sizes, value, left, room), int(np.ceil(bound - 1e-6)), placed)
    return both if both.containers() <= sum(n for *_, n in plain) else both._replace(fillings=plain, programmed=0)


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, column: str = "text") -> DataFrame:
    """(doc_id, piece, start, length): items of at most `capacity` tokens. Only a longer text is split: into full pieces and a rest."""
    sized = with_tokens(docs.select("doc_id", column), column, "tokens", vocabulary).filter("tokens > 0")
    each = sized.select("doc_id", "tokens", F.posexplode(F.sequence(F.lit(0), F.col("tokens") - 1, F.lit(capacity))).alias("piece", "start"))
    return each.select("doc_id", "piece", F.col("start").cast("bigint").alias("start"), F.least(F.lit(capacity), F.col("tokens") - F.col("start")).alias("length"))


def pack(items: DataFrame, capacity: int = CAPACITY, seed: int = 42) -> tuple[DataFrame, Plan]:
    """(doc_id, piece, start, length, container) for items of (doc_id, piece, start, length), and the plan; containers count from 0.

    Every item lies in one container, whose lengths sum to at most `capacity`. Empty tables give an empty result; null
    and empty texts have no item. Items of one length are interchangeable and ranked exactly, however many they are;
    rows that repeat a doc_id are items of their own.
    """
    spark = items.sparkSession
    unit = -(-capacity // UNITS)
    rows = materialize(items.withColumn("units", F.ceil(F.col("length") / unit).cast("int")).withColumn("__key", random_key("doc_id", "piece", seed=seed)))
    histogram = {r["units"]: r["count"] for r in rows.groupBy("units").count().collect()}  # at most UNITS rows
    made = plan(histogram, capacity // unit)
    slots, start, at = [], 0, {}
    for sizes, copies, n in made.fillings:
        for s, c in zip(map(int, sizes), map(int, copies)):
            first = at.get(s, 0)
            slots.append((s, first, first + c * n, c, start))
            at[s] = first + c * n
        start += n
    side = spark.createDataFrame(slots, "__units int, __from bigint, __to bigint, __copies bigint, __first bigint")  # at most UNITS a filling
    ranked = rank_by_key(rows, ["units"], "__key", "doc_id", "__rank")
    on = (F.col("units") == F.col("__units")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to"))
    container = F.col("__first") + F.expr("(__rank - __from) div __copies")
    return ranked.join(F.broadcast(side), on).select("doc_id", "piece", "start", "length", container.alias("container")), made


def report(packed: DataFrame, made: Plan, capacity: int = CAPACITY) -> DataFrame:
    """One row: items, tokens, containers used, the fewest that could hold the tokens, the fewest by the program's prices for lengths in units, the part of the items that the rounded program placed, the fullest container, and the share filled."""
    each = packed.groupBy("container").agg(F.sum("length").alias("n"), F.count("*").alias("items"))
    return each.agg(
        F.sum("items").alias("items"), F.sum("n").alias("tokens"), F.count("*").alias("containers"), F.ceil(F.sum("n") / capacity).alias("least_containers"), F.lit(made.bound).cast("bigint").alias("least_by_prices"),
        F.round(F.lit(float(made.programmed)) / F.sum("items"), 6).alias("programmed_share"), F.max("n").alias("fullest"), F.round(F.sum("n") / (F.count("*") * capacity), 6).alias("filled"),
    )


def oversized_of(packed: DataFrame) -> DataFrame:
    """(doc_id): documents that exceed a container, which are those that were packed in more than one piece."""
    return packed.filter("piece = 1").select("doc_id")
