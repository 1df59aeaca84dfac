"""A sample that matches target proportions of its categories.

Quotas are the shares of the size wanted, held between the least rows of a cell and the rows it has; what one cell can't
give, or must give beyond its share, the others make up in proportion. They are fractional and made integer by controlled
rounding: a maximum flow through the two-way table (rows: task and domain, columns: bucket) finds integers that are each
the floor or the ceiling of their quota, as are all row sums, column sums and the total. In each cell the rows with the
smallest random keys are then taken, exactly as many as the quota says.
"""

from __future__ import annotations

from collections import defaultdict, deque
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropmill.functions import notation
from cropmill.operators.ranking import random_key, rank_by_key
from cropmill.sources.tables import materialize

CELL = ["task", "domain", "mining_bucket"]
#: Cells that the driver plans; more is an error, never a cut.
MOST_CELLS = 100_000


def bounded_quotas(shares: dict[tuple, Fraction], least: dict[tuple, int], most: dict[tuple, int], size: Fraction) -> dict[tuple, Fraction]:
    """Quotas in proportion to the shares, held between `least` and `most`, that sum to `size`.

    Where the least rows alone are more than `size` they hold, and where all that there is is less, that is taken. The
    common factor lies between two of the points where a cell meets a bound, and is exact there.
    """
    at = lambda factor: {k: min(max(factor * s, least[k]), most[k]) for k, s in shares.items()}
    moving = {k: s for k, s in shares.items() if s > 0 and least[k] < most[k]}
    points = sorted({Fraction(x) / s for k, s in moving.items() for x in (least[k], most[k])} | {Fraction(0)})
    low, high = 0, len(points) - 1
    while low < high:  # the last point whose quotas don't exceed the size
        mid = (low + high + 1) // 2
        low, high = (mid, high) if sum(at(points[mid]).values()) <= size else (low, mid - 1)
    out = at(points[low])
    open_ = size - sum(out.values())
    free = {k: s for k, s in moving.items() if least[k] <= points[low] * s < most[k]}
    if open_ > 0 and free:
        out |= {k: out[k] + open_ * s / sum(free.values()) for k, s in free.items()}
    return out


def _saturated(arcs: list[tuple], supply: dict, demand: dict) -> list[int] | None:
    """Flows of arcs (from, to, capacity) that bring all supply to the demand, by shortest augmenting paths in levels; None if there are none."""
    head, room, out = [], [], defaultdict(list)

    def add(a, b, capacity: int) -> None:
        for end, other, c in ((a, b, capacity), (b, a, 0)):
            out[end].append(len(head))
            head.append(other)
            room.append(c)

    for a, b, capacity in arcs:
        add(a, b, capacity)
    for node, n in supply.items():
        add("from", node, n)
    for node, n in demand.items():
        add(node, "to", n)
    brought = 0
    while True:
        level, queue = {"from": 0}, deque(["from"])
        while queue:
            a = queue.popleft()
            for k in out[a]:
                if room[k] and head[k] not in level:
                    level[head[k]] = level[a] + 1
                    queue.append(head[k])
        if "to" not in level:
            break
        next_ = dict.fromkeys(out, 0)
        path: list[int] = []
        while True:
            a = head[path[-1]] if path else "from"
            if a == "to":
                push = min(room[k] for k in path)
                for k in path:
                    room[k] -= push
                    room[k ^ 1] += push
                brought += push
                path = path[: next(i for i, k in enumerate(path) if not room[k])]
                continue
            ways = out[a]
            while next_[a] < len(ways) and not (room[ways[next_[a]]] and level.get(head[ways[next_[a]]]) == level[a] + 1):
                next_[a] += 1
            if next_[a] < len(ways):
                path.append(ways[next_[a]])
            elif path:
                level[a] = -1
                path.pop()
            else:
                break
    return [room[2 * i + 1] for i in range(len(arcs))] if brought == sum(supply.values()) else None


def controlled_rounding(quotas: dict[tuple, Fraction]) -> dict[tuple, int]:
    """Integers for a two-way table {(row, column): quota}; each cell, margin and the total moves by less than 1.

    The whole parts stay; a flow decides which fractional cells get one more. Margins are arcs with a lower bound, which
    becomes supply and demand of a plain flow; the quotas themselves prove that one exists.
    """
    whole = {k: floor(q) for k, q in quotas.items()}
    cells = [k for k, q in quotas.items() if q != whole[k]]
    sums: dict = defaultdict(Fraction)
    for (r, c), q in quotas.items():
        for node in (("r", r), ("c", c), "all"):
            sums[node] += q - whole[r, c]
    arcs: list[tuple] = [(("r", r), ("c", c), 1) for r, c in cells]
    supply, demand = defaultdict(int), defaultdict(int)
    for node, s in sums.items():
        a, b = ("sink", "source") if node == "all" else ("source", node) if node[0] == "r" else (node, "sink")
        arcs.append((a, b, ceil(s) - floor(s)))
        supply[b] += floor(s)
        demand[a] += floor(s)
    flows = _saturated(arcs, supply, demand)
    if flows is None:
        raise RuntimeError("no rounding keeps the margins")
    return whole | {k: whole[k] + n for k, n in zip(cells, flows)}


def labelled(samples: DataFrame) -> DataFrame:
    """One row for each different sample that has a bucket, labels in one notation; deliveries of a sample count once."""
    cells = samples.select(notation.record_id(F.col("id")).alias("id"), *[notation.label(F.col(c)).alias(c) for c in CELL])
    return cells.filter(F.col("mining_bucket").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.max(F.struct(*CELL)).alias("cell")).select("id", "cell.*")


def plan(available: dict[tuple, int], targets: list, share: Fraction) -> list[dict]:
    """One row a target cell: what it needs, what it has, how many are selected, and whether it falls short of its need.

    The size is the targets' part of `share` of all rows. A cell without a target gives nothing; of a cell named twice
    the last target holds.
    """
    base = share * sum(available.values())
    wanted = {(t.task, t.domain, t.mining_bucket): t for t in targets}
    shares = {k: Fraction(str(t.target_share)) for k, t in wanted.items()}
    has = {k: available.get(k, 0) for k in wanted}
    quotas = bounded_quotas(shares, {k: min(has[k], t.min_rows) for k, t in wanted.items()}, has, floor(base * sum(shares.values())))
    selected = controlled_rounding({(k[:2], k[2]): q for k, q in quotas.items()})
    out = []
    for k, t in wanted.items():
        needed = max(ceil(shares[k] * base), t.min_rows)
        out.append(dict(zip(CELL, k)) | {"target_share": t.target_share, "min_rows": t.min_rows, "needed": needed, "available": has[k], "selected": selected[k[:2], k[2]], "short": has[k] < needed})
    return out


def sample_to_proportions(samples: DataFrame, targets: DataFrame, share: Fraction = Fraction(1, 2), seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(selected samples, report of the target cells).

    share: size of the sample as a part of all different samples with a bucket. A cell gives at least its min_rows and at
    most what it has; what it can't give the others make up, so the size is met wherever the rows suffice. Samples with a null label count in the size but lie in no cell, and cells without a target give nothing. Empty
    tables give an empty selection, with every cell that needs a row reported short. Repeated rows of a sample count
    once; other columns are ignored. The counts are aggregated before the shuffle; the driver sees one row a cell.
    """
    spark = samples.sparkSession
    named = materialize(labelled(samples))
    counted = named.groupBy(*CELL).count().limit(MOST_CELLS + 1).collect()
    wanted = targets.select(*[notation.label(F.col(c)).alias(c) for c in CELL], "target_share", "min_rows").limit(MOST_CELLS + 1).collect()
    if max(len(counted), len(wanted)) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells")
    cells = plan({tuple(r[c] for c in CELL): r["count"] for r in counted}, wanted, share)
    kinds = "task string, domain string, mining_bucket string, target_share double, min_rows int, needed bigint, available bigint, selected bigint, short boolean"
    names = [x.split()[0] for x in kinds.split(", ")]
    report = spark.createDataFrame([tuple(c[k] for k in names) for c in cells], kinds)
    total = sum(c["selected"] for c in cells)
    report = report.withColumn("selected_share", F.round(F.col("selected") / F.lit(float(max(1, total))), 6))
    quota = F.broadcast(report.select(*CELL, F.col("selected").alias("__quota")))
    keyed = named.join(quota, CELL).withColumn("__key", random_key("id", seed=seed))
    ranked = rank_by_key(keyed, CELL, "__key", "id", "__rank")
    return ranked.filter(F.col("__rank") < F.col("__quota")).select("id", *CELL), report
