"""Weighted averaging of checkpoints as a table of tensors: (model, key, shape, dtype, values)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Element types that are averaged; all others must be equal. Bytes of an element on disk.
AVERAGED = ("F64", "F32", "F16", "BF16")
BYTES = {"F64": 8, "F32": 4, "F16": 2, "BF16": 2, "I64": 8, "I32": 4, "I16": 2, "I8": 1, "U8": 1, "BOOL": 1}


def finite(values: Column) -> Column:
    """Whether no element is null, NaN or infinite; an empty tensor is finite."""
    return F.forall(values, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))


def key_problems(tensors: DataFrame) -> DataFrame:
    """(key, problem): keys that not every model has once, or with differing shape or dtype."""
    models = tensors.select("model").distinct().count()
    per = tensors.groupBy("key").agg(F.countDistinct("model").alias("models"), F.count("*").alias("rows"), F.countDistinct("shape").alias("shapes"), F.countDistinct("dtype").alias("dtypes"))
    problem = F.when(F.col("models") < models, "missing in a model").when(F.col("rows") > models, "twice in a model").when(F.col("shapes") > 1, "shapes differ").when(F.col("dtypes") > 1, "dtypes differ")
    return per.select("key", problem.alias("problem")).filter("problem IS NOT NULL")


def weighted_mean(tensors: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(key, shape, dtype, values, problem): the mean in single precision, added up in the order of the models given.

    Weights are normalised to sum 1. Elements of other types are taken over when all models agree. A tensor that isn't
    finite, before or after, or differs where it must not, has null values and a problem. Each tensor is one group of
    as many rows as there are models.
    """
    total = sum(weights.values())
    if not weights or total <= 0 or any(w < 0 for w in weights.values()):
        raise ValueError("weights: nonnegative, not all 0")
    order = {m: i for i, m in enumerate(weights)}
    share, place = F.lit(None).cast("float"), F.lit(None).cast("int")
    for m, w in weights.items():
        share = F.when(F.col("model") == m, F.lit(w / total).cast("float")).otherwise(share)
        place = F.when(F.col("model") == m, F.lit(order[m])).otherwise(place)
    own = tensors.filter(F.col("model").isin(*weights))
    grouped = own.groupBy("key").agg(F.min("shape").alias("shape"), F.min("dtype").alias("dtype"), F.array_sort(F.collect_list(F.struct(place.alias("i"), share.alias("w"), F.col("values").cast("array<float>").alias("v")))).alias("each"), F.countDistinct("values").alias("kinds"), F.count("*").alias("n"))
    zero = F.transform(F.get("each", F.lit(0))["v"], lambda _: F.lit(0.0).cast("float"))
    mean = F.aggregate("each", zero, lambda acc, m: F.zip_with(acc, m["v"], lambda a, b: (a + b * m["w"]).cast("float")))
    floats = F.col("dtype").isin(*AVERAGED)
    grouped = grouped.withColumn("__mean", F.when(floats, mean).otherwise(F.get("each", F.lit(0))["v"]))
    problem = (
        F.when(F.col("n") != len(weights), "missing in a model")
        .when(~floats & (F.col("kinds") > 1), "models differ")
        .when(floats & ~F.forall("each", lambda m: finite(m["v"])), "not finite")
        .when(floats & ~finite(F.col("__mean")), "mean not finite")
    )
    return grouped.withColumn("problem", problem).select("key", "shape", "dtype", F.when(F.col("problem").isNull(), F.col("__mean")).alias("values"), "problem")


def shards(sizes: DataFrame, most: int) -> DataFrame:
    """(key, bytes, shard): keys in order, packed greedily; a shard that would exceed `most` bytes is closed.

    What a shard holds depends on all keys before it, so the keys of one checkpoint, thousands at most, are one group.
    """

    def fold(keys: pd.DataFrame) -> pd.DataFrame:
        keys = keys.sort_values("key", kind="stable")
        shard, used, out = 0, 0, []
        for n in keys["bytes"]:
            if used and used + n > most:
                shard, used = shard + 1, 0
            used += n
            out.append(shard)
        return keys.assign(shard=np.array(out, np.int32))

    return sizes.select("key", F.col("bytes").cast("bigint").alias("bytes")).groupBy().applyInPandas(fold, "key string, bytes bigint, shard int")


def map_problems(weight_map: DataFrame, actual: DataFrame) -> DataFrame:
    """(key, listed, found): where an index and the contents of the shards don't agree; both (key, shard)."""
    a, b = weight_map.select("key", F.col("shard").alias("listed")), actual.select("key", F.col("shard").alias("found"))
    return a.join(b, "key", "full").filter(~F.col("listed").eqNullSafe(F.col("found")))


#: Entries of a model's configuration that may differ between models that are averaged.
MAY_DIFFER = ("_name_or_path", "torch_dtype", "dtype", "transformers_version", "use_cache")
#: Files beside the weights that must be the same, by the end of their names, and marks of adapters.
SIDE_FILES = (".json", ".model", ".txt", ".jinja")
ADAPTERS = ("adapter_config.json", "adapter_model.safetensors", "adapter_model.bin")


def config_problems(models: dict[str, dict]) -> list[str]:
    """Why models can't be averaged, by their configuration {model: config}: any entry that differs beyond MAY_DIFFER, or a quantized model."""
    out = [f"{m}: quantized" for m, c in models.items() if c.get("quantization_config")]
    first, rest = next(iter(models.items())), list(models.items())[1:]
    core = lambda c: {k: v for k, v in c.items() if k not in MAY_DIFFER}
    for m, c in rest:
        a, b = core(first[1]), core(c)
        out += [f"{m}: {k} differs from {first[0]}" for k in sorted(set(a) | set(b)) if a.get(k) != b.get(k)]
    return out


def side_problems(models: dict[str, dict[str, str]]) -> list[str]:
    """Why models can't be averaged, by the files beside their weights {model: {name: digest}}: an adapter, or a file that another model lacks or has otherwise."""
    out = [f"{m}: {n} is an adapter" for m, own in models.items() for n in sorted(own) if n in ADAPTERS]
    watched = lambda own: {n: h for n, h in own.items() if n.endswith(SIDE_FILES) and not n.endswith((".safetensors.index.json", "config.json")) and n not in ADAPTERS}
    (first, own), *rest = models.items()
    for m, other in rest:
        a, b = watched(own), watched(other)
        out += [f"{m}: {n} differs from {first}" for n in sorted(set(a) | set(b)) if a.get(n) != b.get(n)]
    return out


def tied_problems(tensors: DataFrame, tied: list[tuple[str, str]]) -> DataFrame:
    """(model, problem): models that hold both of two tied keys with differing values; tied weights are one tensor."""
    a, b = (tensors.select("model", F.col("key").alias(k), F.xxhash64("values").alias(f"h_{k}")) for k in ("one", "other"))
    pairs = tensors.sparkSession.createDataFrame(tied or [("", "")], "one string, other string")
    found = a.join(F.broadcast(pairs), "one").join(b, ["model", "other"]).filter(F.col("h_one") != F.col("h_other"))
    return found.select("model", F.concat(F.col("one"), F.lit(" and "), F.col("other"), F.lit(" are tied but differ")).alias("problem"))
