"""Train, val and test splits that keep related records together.

Documents and their parent links form a graph. Its groups come from a distributed union-find: each partition of links
builds a local forest, the roots that a node got in different partitions become the links of the next, smaller level,
and the levels are merged until no link is left. Groups are then assigned largest first, each to the split furthest
below its target; groups of one size are interchangeable, so the driver plans with one row a size.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropmill.functions import notation
from cropmill.operators import skew
from cropmill.operators.ranking import random_key, rank_by_key
from cropmill.sources.tables import materialize

#: Links that one task merges.
LINKS_PER_TASK = 500_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b, ka, kb) of a partition -> (node, root, kroot): every node of it with the root of its tree; k is a node's key."""
    parent: dict[str, str] = {}
    keys: dict[str, int] = {}

    def find(x: str) -> str:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b, ka, kb in zip(batch["a"], batch["b"], batch["ka"], batch["kb"]):
            if a not in parent:
                parent[a], keys[a] = a, ka
            if b not in parent:
                parent[b], keys[b] = b, kb
            a, b = find(a), find(b)
            if a != b:
                low, high = sorted((a, b), key=lambda x: (keys[x], x))
                parent[high] = low
    nodes = list(parent)
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        roots = [find(x) for x in part]
        yield pd.DataFrame({"node": part, "root": roots, "kroot": [keys[r] for r in roots]})


def components(links: DataFrame, links_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """(node, root) for each node of links (a, b); nodes of one component share the root, and only they.

    Links with a null end, of a node to itself, repeated or closing a circle change nothing; nodes without a link don't
    come out. The key of a node changes with the level, so that chains shrink by a constant part each level in any
    order of names; links are spread by both ends, so a hub is never gathered by one task. An empty table
    gives an empty table.
    """
    spark = links.sparkSession
    links = links.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")).filter(F.col("a") != F.col("b"))
    levels: list[DataFrame] = []
    left = None
    while left is None or left > 0:
        level = len(levels)
        keyed = links.select("a", "b", random_key("a", seed=level).alias("ka"), random_key("b", seed=level).alias("kb"))
        if left is None:
            left = links.count()
        parts = max(1, -(-left // links_per_task))
        forest = materialize(keyed.repartition(parts, F.xxhash64(F.lit(level), "a", "b")).mapInPandas(_forest, "node string, root string, kroot bigint"))
        best = forest.groupBy("node").agg(F.min(F.struct("kroot", "root"))["root"].alias("up"))
        best = materialize(best)
        if parts == 1:
            levels.append(best)
            break
        links = materialize(forest.select("node", "root").join(best, "node").filter(F.col("root") != F.col("up")).select(F.col("root").alias("a"), F.col("up").alias("b")).distinct())
        levels.append(best)
        left = links.count()
    if not levels:
        return spark.createDataFrame([], "node string, root string")
    # From the top: the root of a node is the root of what it was merged into one level up.
    roots = levels[-1].select("node", F.col("up").alias("root"))
    for best in reversed(levels[:-1]):
        upper = roots.select(F.col("node").alias("up"), F.col("root").alias("top"))
        roots = best.join(upper, "up", "left").select("node", F.coalesce("top", "up").alias("root"))
    return roots


def spread(deficits: list[int], size: int, count: int) -> list[int]:
    """How many of `count` groups of one size go to each split, each in turn to the split with the largest deficit, ties to the first.

    Equal to the loop over all groups: the largest `count` of the falling series deficit, deficit - size, ... of all
    splits; the level they reach down to is found by bisection, so the cost doesn't depend on count.
    """
    taken = lambda level: [max(0, (d - level) // size + 1) if d >= level else 0 for d in deficits]  # noqa: E731 - terms at or above level
    low, high = min(deficits) - size * (count + 1), max(deficits) + 1
    while high - low > 1:  # sum(taken(low)) >= count > sum(taken(high))
        mid = (low + high) // 2
        low, high = (mid, high) if sum(taken(mid)) >= count else (low, mid)
    out = taken(high)
    for i, (more, now) in enumerate(zip(taken(low), out)):
        give = min(more - now, count - sum(out))
        out[i] += give
    return out


def plan(sizes: dict[int, int], shares: list[tuple[str, Fraction]]) -> list[tuple[int, str, int, int]]:
    """(size, split, first rank, end rank) for groups of each size, largest first; sizes: number of groups by size."""
    total = sum(s * n for s, n in sizes.items())
    scale = lcm(*[x.denominator for _, x in shares])
    deficits = [int(x * scale) * total for _, x in shares]
    out = []
    for size in sorted(sizes, reverse=True):
        at = 0
        for i, n in enumerate(spread(deficits, size * scale, sizes[size])):
            if n:
                out.append((size, shares[i][0], at, at + n))
                at += n
                deficits[i] -= n * size * scale
    return out


def grouped(samples: DataFrame, source_docs: DataFrame) -> DataFrame:
    """(id, split, group): one row a different sample; samples whose documents are the same or tied share the group.

    A sample without a document is a group of its own. Deliveries of a sample in several rows give one row; were their
    documents to differ, the least would hold.
    """
    rows = samples.select(notation.record_id(F.col("id")).alias("id"), notation.document_id(F.col("document_id")).alias("doc"), notation.split(F.col("split")).alias("split"))
    rows = rows.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("doc").alias("doc"), F.min("split").alias("split"))
    rows = materialize(rows)
    links = source_docs.select(notation.document_id(F.col("document_id")).alias("a"), notation.document_id(F.col("parent_document_id")).alias("b"))
    roots = components(links)
    docs = rows.filter(F.col("doc").isNotNull()).groupBy("doc").agg(F.count("*").alias("n"))
    side = materialize(docs.join(roots, F.col("doc") == F.col("node"), "left").select("doc", "n", F.coalesce("root", "doc").alias("root")))
    named = skew.lookup(rows.filter(F.col("doc").isNotNull()), side.select("doc", "root"), "doc", skew.hot_keys(side))
    # Prefixes keep documents and samples of one name apart.
    named = named.select("id", "split", F.concat(F.lit("d:"), "root").alias("group"))
    alone = rows.filter(F.col("doc").isNull()).select("id", "split", F.concat(F.lit("s:"), "id").alias("group"))
    return named.unionByName(alone)


def split_groups(samples: DataFrame, source_docs: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """(id, group, split, new_split, broken) for each different sample.

    new_split keeps every group on one side and comes near the target shares; broken: the present splits of the group
    are more than one. Among groups of one size a random key of the group decides, so the result depends on the
    content and the seed only. A group larger than any target goes to the split furthest below target, whole. Null and
    placeholder documents tie nothing. Empty samples give an empty result; the targets must not be empty.
    """
    spark = samples.sparkSession
    rows = materialize(grouped(samples, source_docs))
    groups = materialize(rows.groupBy("group").agg(F.count("*").alias("n"), (F.min("split") != F.max("split")).alias("broken")).withColumn("__key", random_key("group", seed=seed)))
    sizes = {r["n"]: r["count"] for r in groups.groupBy("n").count().collect()}  # at most sqrt(2 x samples) sizes
    shares = [(r["split"], Fraction(str(r["target_share"]))) for r in targets.collect()]
    shares.sort(key=lambda x: (-x[1], x[0]))
    cuts = spark.createDataFrame(plan(sizes, shares), "__n bigint, new_split string, __from bigint, __to bigint")
    ranked = rank_by_key(groups, ["n"], "__key", "group", "__rank")
    at = (F.col("n") == F.col("__n")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to"))
    side = materialize(ranked.join(F.broadcast(cuts), at).select("group", "n", "broken", "new_split"))
    named = skew.lookup(rows, side.select("group", "broken", "new_split"), "group", skew.hot_keys(side))
    return named.select("id", "group", "split", "new_split", "broken")


def broken_groups(samples: DataFrame, source_docs: DataFrame) -> DataFrame:
    """(id): all samples of groups whose samples now lie in more than one split."""
    rows = materialize(grouped(samples, source_docs))
    groups = rows.groupBy("group").agg(F.count("*").alias("n"), (F.min("split") != F.max("split")).alias("broken")).filter("broken")
    groups = materialize(groups)
    return skew.lookup(rows, groups.select("group"), "group", skew.hot_keys(groups)).select("id")
