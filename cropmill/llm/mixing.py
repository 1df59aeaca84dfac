"""Mixing sources to target weights.

Each source gives its share of the total size in tokens, by whole texts that are used a capped number of times. Texts
are counted by source and exact length. Where a source has more than its budget, all its texts are used equally often
and the remaining budget is met by a subset of texts: each length gives its part, and a bounded knapsack program over
the counts by length fits what then remains to the token. Of each length the texts with the smallest seeded keys are
taken. Lengths above LONG are counted in classes, by their upper end, so the plan has a bounded number of rows a source;
what the chosen texts of a class have less than that is measured and fitted again.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmill.functions import notation
from cropmill.llm.tokens import VOCABULARY, with_tokens
from cropmill.operators.ranking import random_key, rank_by_key
from cropmill.sources.tables import materialize

#: Tokens that the knapsack program fits exactly; larger budgets are brought below it first, length by length.
FIT = 1 << 16
#: Lengths up to this are planned exactly; above it there are 64 classes a doubling.
LONG = 4096
#: Times the plan is fitted to what the chosen texts really hold; each leaves less than a 64th of what was open.
FITS = 3
#: Rows of the plan, one a source and length or class, that are broadcast; a larger plan is joined by a shuffle.
MOST_BROADCAST = 200_000


def fit(budget: int, counts: dict[int, int]) -> dict[int, int]:
    """How many texts of each length to take so that their sum comes as near to the budget as possible without exceeding it.

    While more than FIT is open each length gives a proportional part, then the largest texts are taken; the last FIT
    tokens are fitted by the program. Reachable sums are bits of one integer a length, so a step is a shift.
    """
    total = sum(n * c for n, c in counts.items())
    if total <= budget:
        return dict(counts)
    take = {}
    for n, c in counts.items():
        take[n] = c * max(0, budget - FIT // 2) // total
    left = budget - sum(n * k for n, k in take.items())
    for n in sorted(counts, reverse=True):
        if left <= FIT:
            break
        more = min(counts[n] - take[n], max(0, (left - FIT // 2) // n))
        take[n] += more
        left -= more * n
    mask, sums, steps = (1 << (left + 1)) - 1, 1, []
    for n in sorted(counts, reverse=True):
        open_, lot = min(counts[n] - take[n], left // n if n else 0), 1
        while open_ > 0:
            lot = min(lot, open_)
            steps.append((n, lot, sums))
            sums |= (sums << n * lot) & mask
            open_ -= lot
            lot *= 2
    at = sums.bit_length() - 1
    for n, lot, before in reversed(steps):
        if not before >> at & 1:
            take[n] += lot
            at -= n * lot
    return take


def length_class(tokens: Column) -> Column:
    """The length itself up to LONG, else the upper end of its class."""
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.floor(F.log2(F.greatest(tokens, F.lit(1)))) - 6).cast("int"))
    return F.when(tokens <= LONG, tokens).otherwise(F.ceil(tokens / step).cast("bigint") * step)


def measured(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, text_key, tokens), sources in the notation of the targets."""
    sized = with_tokens(docs.select("doc_id", "text", notation.label(F.col("source")).alias("source"), F.unhex(F.md5("text")).alias("text_key")), vocabulary=vocabulary)
    return sized.select("doc_id", "source", "text_key", "tokens")


def mix_sources(docs: DataFrame, weights: DataFrame, vocabulary: str = VOCABULARY, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, tokens, copies) of the texts used, and one report row a source.

    The mix is meant to be as large as all documents together, T tokens. Equal texts are one text, which stands for
    its source under the least doc_id and is used at most max_repeats times in all. Null, empty and unlisted-source
    documents count in T but are not used. A source is short when the tokens of its documents times max_repeats are
    fewer than its weight of T; it then gives all it may. Empty documents give an empty mix.
    """
    spark = docs.sparkSession
    rows = materialize(measured(docs, vocabulary))
    by = {r["source"]: r for r in rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents")).collect()}
    total = sum(r["tokens"] for r in by.values())
    texts = rows.filter("tokens > 0 AND source IS NOT NULL").groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "tokens")).alias("t")).select("t.*")
    texts = materialize(texts.withColumn("size", length_class(F.col("tokens"))).withColumn("__key", random_key("doc_id", seed=seed)))
    counts: dict[str, dict[int, int]] = {}
    held: dict[str, int] = {}
    for r in texts.groupBy("source", "size").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).toLocalIterator():  # bounded a source
        counts.setdefault(r["source"], {})[r["size"]] = r["n"]
        held[r["source"]] = held.get(r["source"], 0) + r["tokens"]
    ranked = materialize(rank_by_key(texts, ["source", "size"], "__key", "doc_id", "__rank"))
    wanted = weights.select(notation.label(F.col("source")).alias("source"), "target_weight", "max_repeats").orderBy("source").collect()
    passes, more, open_ = {}, {}, {}
    for w in wanted:
        source, once = w["source"], held.get(w["source"], 0)
        budget = int(Fraction(str(w["target_weight"])) * total)
        passes[source] = min(w["max_repeats"], budget // once) if once else 0
        more[source] = {}
        open_[source] = budget - passes[source] * once if once and passes[source] < w["max_repeats"] else 0

    def plan_table() -> DataFrame:
        rows_ = [(s, n, passes[s], more[s].get(n, 0)) for s in passes for n in counts.get(s, {})]
        side = spark.createDataFrame(rows_, "source string, size bigint, __passes int, __more bigint")
        return F.broadcast(side) if len(rows_) <= MOST_BROADCAST else side

    for _ in range(FITS):
        added = 0
        for source, budget in open_.items():
            own = counts.get(source, {})
            for n, k in fit(budget, {n: c - more[source].get(n, 0) for n, c in own.items() if c > more[source].get(n, 0)}).items() if budget > 0 else ():
                more[source][n] = more[source].get(n, 0) + k
                open_[source] -= n * k
                added += k if n > LONG else 0
        if not added:
            break
        # What the long texts chosen so far hold less than planned is open again.
        long_ = ranked.filter(F.col("size") > LONG).join(plan_table(), ["source", "size"]).filter(F.col("__rank") < F.col("__more"))
        taken = {r["source"]: r["n"] for r in long_.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
        for w in wanted:
            source = w["source"]
            if taken.get(source):
                short = sum(n * k for n, k in more[source].items() if n <= LONG)
                open_[source] = int(Fraction(str(w["target_weight"])) * total) - passes[source] * held[source] - short - taken[source]
    lines = []
    for w in wanted:
        source, own = w["source"], by[w["source"]] if w["source"] in by else {"documents": 0, "tokens": 0}
        share = Fraction(str(w["target_weight"])) * total
        partly = int(share) - passes[source] * held.get(source, 0) - open_[source] if more[source] else 0
        lines.append((source, w["target_weight"], w["max_repeats"], own["documents"], own["tokens"], int(share), passes[source] * held.get(source, 0) + partly, own["tokens"] * w["max_repeats"] < share))
    mixed = sum(x[6] for x in lines)
    report = spark.createDataFrame(lines, "source string, target_weight double, max_repeats int, documents bigint, tokens bigint, budget bigint, used_tokens bigint, short boolean")
    report = report.withColumn("used_share", F.round(F.col("used_tokens") / F.lit(float(max(1, mixed))), 6))
    copies = (F.col("__passes") + F.when(F.col("__rank") < F.col("__more"), 1).otherwise(0)).cast("int")
    chosen = ranked.join(plan_table(), ["source", "size"])
    return chosen.select("doc_id", "source", "tokens", copies.alias("copies")).filter("copies > 0"), report
