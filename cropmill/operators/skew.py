"""Joins on keys of which some may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hot keys number at most SHARE, as each holds more than 1/SHARE of the rows: small enough to broadcast at any scale.
SHARE = 100_000
LEAST_HOT = 20_000


def hot_keys(counts: DataFrame, n: str = "n", least: int = LEAST_HOT) -> DataFrame:
    """The keys of a table of counts that hold more than 1/SHARE of all rows, and at least `least`; at most SHARE rows."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.filter(F.col(n) > max(least, total // SHARE))


def lookup(rows: DataFrame, side: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """rows inner join side (one row a key) on `key`; the rows of hot keys are never shuffled by that key.

    hot: keys (column `key`), at most SHARE of them. Their part of `side` is broadcast; all other keys are joined by a shuffle.
    """
    hot = hot.select(F.col(key).alias("__hot")).distinct()
    small = side.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left_semi")
    cold = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left_anti")
    return rows.join(F.broadcast(small), key).unionByName(cold.join(side, key))


def salts(n: Column, most: int) -> Column:
    """Pieces into which a key of n rows is cut."""
    return F.greatest(F.lit(1), F.ceil(n / F.lit(float(most)))).cast("int")


def spread(rows: DataFrame, side: DataFrame, key: str, hot: DataFrame, by: list[str], n: str = "n", most: int = LEAST_HOT) -> DataFrame:
    """rows inner join side on `key`, where `side` may have any number of rows a key, and wide ones.

    hot: (key, n) of at most SHARE keys, which alone is broadcast. The rows of a hot key are cut into n / most pieces by
    a hash of the columns `by`, and what `side` has for it goes to every piece, so no task holds a whole hot key.
    """
    cut = F.broadcast(hot.select(F.col(key).alias("__hot"), salts(F.col(n), most).alias("__st")))
    at = lambda df: df.join(cut, F.col(key) == F.col("__hot"), "left").withColumn("__st", F.coalesce("__st", F.lit(1)))
    pieces = at(rows).withColumn("__salt", F.pmod(F.xxhash64(*by), F.col("__st")).cast("int")).drop("__hot", "__st")
    copies = at(side).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__st") - 1))).drop("__hot", "__st")
    return pieces.join(copies, [key, "__salt"]).drop("__salt")
