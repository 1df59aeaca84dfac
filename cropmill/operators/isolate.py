"""Keeping evaluation data out of training data, and first-wins removal of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmill.operators import skew
from cropmill.sources.tables import materialize

#: Columns that identify a record, by the namespace they share.
IDENTITY = {"document": ("document_id", "parent_document_id"), "hash": ("image_hash", "pixel_hash", "parent_image_hash")}
#: Columns by which two records are one, the first present one holds.
SAME = ("pixel_hash", "image_hash", "image")


def identity_keys(df: DataFrame) -> Column:
    """Array of (kind, value) of the identities a row has; null, empty and "0" of a number name nothing."""
    kinds = dict(df.dtypes)
    each = []
    for kind, names in IDENTITY.items():
        for c in names:
            if c in kinds:
                value = F.col(c).cast("string")
                empty = F.lit("0") if kinds[c] in ("int", "bigint", "smallint", "tinyint") else F.lit("")
                each.append(F.when(value.isNotNull() & (value != empty) & (value != ""), F.struct(F.lit(kind).alias("kind"), value.alias("value"))))
    return F.array_distinct(F.array_compact(F.array(*each))) if each else F.array().cast("array<struct<kind:string,value:string>>")


def identities(df: DataFrame) -> DataFrame:
    """The identity columns that a table has, as text, so that tables of different types can be put together; the number 0 names nothing."""
    kinds = dict(df.dtypes)
    names = [c for of in IDENTITY.values() for c in of if c in kinds]
    number = lambda c: kinds[c] in ("int", "bigint", "smallint", "tinyint")
    return df.select(*[(F.nullif(F.col(c), F.lit(0)) if number(c) else F.col(c)).cast("string").alias(c) for c in names])


def is_train(df: DataFrame) -> Column:
    return F.coalesce(F.col("split"), F.lit("train")) == "train" if "split" in df.columns else F.lit(True)


def forbidden_keys(rows: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Distinct (kind, value) of all held-out rows and of every excluded row.

    Computed arrays are exploded outer: else the optimizer filters on their size first, which computes them twice.
    """
    held = rows.filter(~is_train(rows))
    keys = held.select(F.explode_outer(identity_keys(held)).alias("k"))
    if excluded is not None:
        keys = keys.unionByName(excluded.select(F.explode_outer(identity_keys(excluded)).alias("k")))
    return keys.filter("k IS NOT NULL").select("k.*").distinct()


def isolate(rows: DataFrame, order: list[Column], excluded: DataFrame | None = None) -> DataFrame:
    """All rows with the columns `reason` and `duplicate_of`; reason is null for the rows kept.

    A train row that shares an identity with held-out or excluded data is rejected (evaluation_overlap). Of the other
    rows with one pixel hash (where there is no such column: image hash, image) the first by `order` is kept, unless a
    later one has another target or task: then none is. Later rows are duplicate_image, or duplicate_conflicting_gt
    where they differ from the first; the demoted first carries that reason and no duplicate_of. Rows whose key is null
    count as one key. `order` must be total. Columns that begin with two underscores are not to be used by callers.

    Only identities, keys and digests are worked on, each row once; the verdicts are then joined to the rows by a key that
    is unique. Groups are aggregated to their first row and the least and greatest digest of target and task, so a
    hash, or its absence, that a third of the rows share is no group of any task; what is joined back to its rows is
    cut into pieces.
    """
    same = next((c for c in SAME if c in rows.columns), None)
    if same is None:
        raise ValueError("rows need pixel_hash, image_hash or image")
    # Rows are known by 128 bits of their place.
    rows = rows.withColumn("__row", F.struct(F.xxhash64(*order).alias("a"), F.xxhash64(F.lit(1), *order).alias("b")))
    target = F.col("target").cast("string") if "target" in rows.columns else F.lit(None).cast("string")
    content = F.struct(F.xxhash64(target, F.col("task"), target.isNull()).alias("a"), F.xxhash64(F.lit(1), target, F.col("task"), target.isNull()).alias("b"))
    slim = rows.select("__row", F.struct(*order).alias("__order"), F.struct(F.col(same).cast("string").alias("same")).alias("__same"), F.col("id").alias("__id"), content.alias("__content"), is_train(rows).alias("__train"), identity_keys(rows).alias("__keys"))
    slim = materialize(slim)
    named = lambda df: df.select(F.concat("k.kind", F.lit(":"), "k.value").alias("__key"), *[c for c in df.columns if c != "k"])
    keys = named(slim.filter("__train").select("__row", F.explode("__keys").alias("k")))
    banned = named(slim.filter("NOT __train").select(F.explode("__keys").alias("k")))
    if excluded is not None:
        banned = banned.unionByName(named(excluded.select(F.explode_outer(identity_keys(excluded)).alias("k")).filter("k IS NOT NULL")))
    hot = skew.hot_keys(keys.groupBy("__key").agg(F.count("*").alias("n")))
    leaks = materialize(skew.lookup(keys, banned.distinct(), "__key", hot).select("__row").distinct())
    clean = slim.join(leaks, "__row", "left_anti").select("__row", "__order", "__same", "__id", "__content")
    first = F.min(F.struct("__order", F.col("__id").alias("id"), F.col("__content").alias("content"), F.col("__row").alias("row"))).alias("first")
    groups = clean.groupBy("__same").agg(first, (F.min("__content") != F.max("__content")).alias("split"), F.count("*").alias("n")).filter("n > 1")
    groups = materialize(groups)
    members = skew.spread(clean, groups.select("__same", "first", "split"), "__same", skew.hot_keys(groups), ["__row"])
    later, differs = F.col("__row") != F.col("first.row"), F.col("__content") != F.col("first.content")
    why = F.when(later & differs, "duplicate_conflicting_gt").when(later, "duplicate_image").when(F.col("split"), "duplicate_conflicting_gt")
    found = members.select("__row", why.alias("reason"), F.when(later, F.col("first.id")).alias("duplicate_of")).filter("reason IS NOT NULL")
    found = found.unionByName(leaks.select("__row", F.lit("evaluation_overlap").alias("reason"), F.lit(None).alias("duplicate_of")))
    return rows.drop("reason", "duplicate_of").join(found, "__row", "left").drop("__row")


def kept(isolated: DataFrame) -> DataFrame:
    return isolated.filter(F.col("reason").isNull()).drop("reason", "duplicate_of")


def rejected(isolated: DataFrame) -> DataFrame:
    return isolated.filter(F.col("reason").isNotNull())
