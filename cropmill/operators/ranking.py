"""Exact ranks over groups and tables of any size, without one task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows that one window task may sort, and the most ranges a whole order is cut into: tables of ranges are broadcast, so
#: beyond their product the ranges grow, not the tables.
ROWS_PER_BUCKET = 200_000
MOST_RANGES = 20_000


def ranges(n: int, rows_per_range: int) -> int:
    """The number of ranges for n rows."""
    return max(1, min(MOST_RANGES, -(-n // rows_per_range)))


def random_key(*cols: Column | str, seed: int = 42) -> Column:
    """A uniform 64-bit key that depends on the columns and the seed only."""
    return F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in cols])


def rank_by_key(df: DataFrame, groups: list[str], key: str, tie: str, name: str = "rank", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Append the 0-based rank of each row in its group by (`key`, `tie`).

    `key` is a uniform long (random_key). A group larger than rows_per_bucket is cut into ranges of the key; counts
    of the ranges give each its first rank, so a group that holds a third of all rows is ranked by many tasks.
    `df` is read three times: materialise it first where it is dear. Rows equal in key and tie take ranks in any order.
    """
    largest = df.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
    bits = max(0, (largest // rows_per_bucket).bit_length())
    order = [F.col(key), F.col(tie)]
    if bits == 0:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*groups).orderBy(*order)) - 1)
    # An arithmetic shift keeps the signed order of the keys.
    ranged = df.withColumn("__range", F.shiftright(F.col(key), 64 - bits))
    starts = ranged.groupBy(*groups, "__range").count()
    first = F.sum("count").over(W.partitionBy(*groups).orderBy("__range").rowsBetween(W.unboundedPreceding, -1))
    starts = starts.select(*[F.col(g).alias(f"__{g}") for g in groups], F.col("__range").alias("__r"), F.coalesce(first, F.lit(0)).alias("__start"))
    local = ranged.withColumn("__rn", F.row_number().over(W.partitionBy(*groups, "__range").orderBy(*order)) - 1)
    on = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups] + [F.col("__range") == F.col("__r")]
    return local.join(starts, on).select(*df.columns, (F.col("__rn") + F.col("__start")).alias(name))


def global_rank(df: DataFrame, order: list[Column], materialize, rows_per_bucket: int = ROWS_PER_BUCKET, name: str = "rank") -> DataFrame:
    """Append the 1-based position of each row in the total order given.

    The order must end with a unique column, so that ties spread over ranges. Ranges of the order are ranked on their
    own and shifted by the rows before them; the table of ranges, of MOST_RANGES rows at most, is broadcast.
    """
    parts = ranges(df.count(), rows_per_bucket)
    ranged = materialize(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    starts = ranged.groupBy("__part").count()
    before = F.sum("count").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    starts = starts.select(F.col("__part").alias("__p"), F.coalesce(before, F.lit(0)).alias("__start"))
    local = ranged.withColumn("__rn", F.row_number().over(W.partitionBy("__part").orderBy(*order)))
    return local.join(F.broadcast(starts), F.col("__part") == F.col("__p")).select(*df.columns, (F.col("__rn") + F.col("__start")).alias(name))
